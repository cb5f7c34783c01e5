"""URL filter: host-suffix and path-prefix expressions met with a rule table by hash prefixes."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.session import cut_lineage

# The letters that are lower-cased in a host.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"
# Hex digits of a digest that the join compares first.
PREFIX_DIGITS = 8


def lower_ascii(column):
    return F.translate(column, _UPPER, _LOWER)


def host_of(url):
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url):
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host, path):
    return F.sha2(F.concat(host, path), 256)


def _lengths(rules, column):
    """The distinct lengths that occur in a rule column: numbers of characters, so there are few."""
    rows = rules.select(F.length(column).alias("n")).distinct().collect()
    return F.array(*[F.lit(n) for n in sorted(r.n for r in rows)]).cast("array<int>")


def filter_urls(urls, rules, keys=("page_id",), url="url", default=ALLOW):
    """One row per input row: the ``keys``, host, path, rule (or null) and verdict.

    ``rules`` has host, path and verdict. A rule fits its host and every subdomain if the path of the
    url starts with the path of the rule. The longest rule wins (then the longer host, then block);
    a url that no rule fits gets ``default``. Rules with a null part are ignored. A null url, or one
    without ``://``, has empty host and path; repeated rows stay repeated; other columns are ignored.

    Each url is expanded only into suffixes and prefixes of lengths that some rule has, so a long url
    costs no more than a rule table can ask for. The join compares the first digits of the digests
    and the whole digest after them. Expressions of a row stay in its task until they are folded,
    so one host with very many urls is not a hot key: the rule side has one row per rule, and Spark
    splits or broadcasts by the sizes that it sees.
    """
    rules = rules.select(lower_ascii(F.col("host")).alias("host"), "path", "verdict").dropna()
    # Written first: Spark then plans the join with the true size of the rules.
    known = cut_lineage(rules.groupBy("host", "path").agg(
        F.max((F.col("verdict") == BLOCK).cast("int")).alias("is_block")).select(
        _digest(F.col("host"), F.col("path")).alias("rule_digest"),
        F.struct(F.length(F.concat("host", "path")).alias("length"),
                 F.length("host").alias("host_length"), "is_block",
                 F.concat("host", "path").alias("rule")).alias("rule")).withColumn(
        "prefix", F.substring("rule_digest", 1, PREFIX_DIGITS)), "rules")
    host, path = F.col("host"), F.col("path")
    hosts = F.transform(
        F.filter(_lengths(rules, "host"), lambda n: (n == F.length(host)) | (
            (n < F.length(host)) & (F.substr(host, F.length(host) - n, F.lit(1)) == "."))),
        lambda n: F.when(n == 0, F.lit("")).otherwise(F.right(host, n)))
    paths = F.transform(F.filter(_lengths(rules, "path"), lambda n: n <= F.length(path)),
                        lambda n: F.left(path, n))
    expressions = F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: _digest(h, p))))
    rows = urls.select(*keys, F.monotonically_increasing_id().alias("_row"),
                       host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    met = rows.select("*", F.explode_outer(expressions).alias("digest")).withColumn(
        "prefix", F.substring("digest", 1, PREFIX_DIGITS)).join(known, "prefix", "left")
    best = met.groupBy("_row", *keys, "host", "path").agg(
        F.max(F.when(F.col("digest") == F.col("rule_digest"), F.col("rule"))).alias("best"))
    return best.select(
        *keys, "host", "path", F.col("best.rule").alias("rule"),
        F.when(F.col("best").isNull(), default).when(F.col("best.is_block") == 1, BLOCK)
        .otherwise(ALLOW).alias("verdict"))

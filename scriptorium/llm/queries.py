"""The registered queries of this package, over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from scriptorium.llm import (
    decontaminate, filter_audit, hard_negatives, language, mixing, near_copies, neighbours, pii, quality, secrets,
    token_counts, urls, warc)

# The rules of the URL filter query.
URL_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block"))


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(column, n):
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def op1_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", F.coalesce(
        _remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"))
    dictionaries = language.learn_dictionaries(docs.where(~F.col("held_out")))
    return language.identify_languages(docs, dictionaries, keep=("doc_id", "held_out"))


def op2_source_mix(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return mixing.mix_sources(docs, mixing.word_count(F.col("text"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"),
        "source", "copies")


def op3_nearest_neighbours(spark, sf_dir):
    return neighbours.nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op4_url_filter(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.filter_urls(_table(spark, sf_dir, "pages"), rules)


def op5_warc(spark, sf_dir):
    folder = warc.archive_folder(spark)
    index = warc.write_archives(_table(spark, sf_dir, "pages"), folder)
    return warc.read_records(index, folder).drop("url")


def op6_decontamination(spark, sf_dir):
    found = decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op7_token_counts(spark, sf_dir):
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), token_counts.load_vocabulary())


def op8_pii(spark, sf_dir):
    return pii.find_pii(_table(spark, sf_dir, "documents"))


def op9_quality(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(
        _remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"))
    model = quality.fit_quality(docs.where(~F.col("held_out")), _table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model, keep=("doc_id", "held_out"))


def op10_ngram_jaccard_join(spark, sf_dir):
    return near_copies.near_copies(_table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "n_links", "n_copies")


def op11_hard_negatives(spark, sf_dir):
    # Fixed by the query: every seventh row has a wrong label.
    rows = _table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


def op12_filter_audit(spark, sf_dir):
    return filter_audit.audit_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_secret_scan(spark, sf_dir):
    return secrets.find_secrets(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_source_mix": op2_source_mix,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_url_filter": op4_url_filter,
    "op5_warc": op5_warc,
    "op6_decontamination": op6_decontamination,
    "op7_token_counts": op7_token_counts,
    "op8_pii": op8_pii,
    "op9_quality": op9_quality,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_filter_audit": op12_filter_audit,
    "op13_secret_scan": op13_secret_scan,
}

_WORDS = r"""coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"""

_RULE_ROWS = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)

_RULES = (*secrets.BASE_RULES, *secrets.MORE_RULES)


def _secret_matches():
    """Rows (n, place, s, e, base) of the matches of every rule, as SQL."""
    one = """
        select n, {place} as place, '{kind}' as kind, e - size as s, e, {base} as base from (
            select n, length(ms[i]) as size, length(gs[i]) as judged,
                   sum(length(ps[i]) + length(ms[i])) over (partition by n order by i) as e
            from (select *, unnest(range(1, len(ms) + 1)) as i from (
                select n, regexp_extract_all(t, '{pattern}') as ms, regexp_extract_all(t, '{pattern}', {group}) as gs,
                       string_split_regex(t, '{pattern}') as ps from docs)))
        where judged >= {least}"""
    return " union all ".join(one.format(place=i, kind=r.kind, pattern=r.pattern.replace("'", "''"), group=r.group,
                                         least=r.least, base=r in secrets.BASE_RULES) for i, r in enumerate(_RULES))


ORACLES = {
    "op11_hard_negatives": """
        with named as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                   list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
            from embeddings where label is not null and embedding is not null and vec_id is not null
                and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
        scored as (
            select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
                   cast(list_inner_product(a.v, b.v) as bigint) as score
            from named a join named b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0),
        positives as (
            select anchor_id, vec_id as positive_id, score as positive_score from scored where same
            qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
        select anchor_id, positive_id,
               cast(row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) as integer) as rank,
               vec_id as negative_id, positive_score, score as negative_score
        from positives join scored using (anchor_id)
        where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
        qualify rank <= 3""",
    "op12_filter_audit": """
        with texts as (
            select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t from documents),
        marks as (
            select doc_id, max(quality = 1) as good, max(toxic = 1) as toxic from labels group by doc_id),
        split as (
            select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w, min(doc_id) over (partition by t) as least from texts),
        judged as (
            select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
                   [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
                    100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t),
                    regexp_matches(t, '[#$%&*|]'), coalesce(doc_id > least, false)] as fails
            from split left join marks using (doc_id)),
        kinds as (select part, good, toxic, fails, count(*) as n from judged group by all),
        letters as (select unnest(range(1, 6)) as f),
        orders as (
            select [a.f, b.f, c.f, d.f, e.f] as o from letters a, letters b, letters c, letters d, letters e
            where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
        steps as (select o, unnest(range(1, 6)) as step from orders),
        outcome as (
            select *, fails[o[step]] as failing,
                   coalesce(list_bool_or(list_transform(o[1:step - 1], lambda i: fails[i])), false) as gone,
                   len(list_filter(fails, lambda x: x)) = 1 as alone
            from kinds, steps),
        counted as (
            select part, array_to_string(list_transform(o, lambda i: 'ABCDE'[i]), '') as filter_order, step, o[step] as f,
                   sum(n) filter (not gone and not failing) as kept, sum(n) filter (failing and not gone) as removed,
                   sum(n) filter (failing and gone) as redundant, sum(n) filter (failing and alone) as unique_fails,
                   sum(n) filter (failing and not gone and good) as good_lost,
                   sum(n) filter (failing and not gone and toxic) as toxic_lost
            from outcome group by all)
        select part, filter_order, cast(step as integer) as step, cast(coalesce(kept, 0) as bigint) as kept,
               cast(coalesce(removed, 0) as bigint) as removed, cast(coalesce(redundant, 0) as bigint) as redundant,
               cast(coalesce(unique_fails, 0) as bigint) as unique_fails, cast(coalesce(good_lost, 0) as bigint) as good_lost,
               cast(coalesce(toxic_lost, 0) as bigint) as toxic_lost,
               cast(sum(coalesce(removed, 0)) over (partition by part, f) as bigint) as shapley
        from counted""",
    "op13_secret_scan": f"""
        with docs as (select row_number() over () as n, doc_id, coalesce(text, '') as t from documents),
        spans as ({_secret_matches()}),
        listed as (
            select n, {', '.join(f"count(*) filter (kind = '{r.kind}') as n_{r.kind}" for r in secrets.BASE_RULES)},
                   count(*) filter (not base) as n_more,
                   string_agg(kind || ':' || s || ':' || e, ',' order by s, place) as spans,
                   string_agg(kind || ':' || s || ':' || e, ',' order by s, place) filter (base) as base_spans
            from spans group by n)
        select doc_id, {', '.join(f"cast(coalesce(n_{r.kind}, 0) as bigint) as n_{r.kind}" for r in secrets.BASE_RULES)},
               sha256(coalesce(base_spans, '')) as base_sha256, coalesce(spans, '') as spans,
               cast(coalesce(n_more, 0) as bigint) as n_more
        from docs left join listed using (n)""",
    "op4_url_filter": rf"""
        with parts as (
            select row_number() over () as n, page_id,
                   translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                   coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path
            from pages),
        rules(rule_host, rule_path, verdict) as (values {_RULE_ROWS}),
        fit as (
            select n, max_by(struct_pack(r := rule_host || rule_path, v := verdict),
                             length(rule_host || rule_path)) as best
            from parts join rules on starts_with(path, rule_path)
                and (host = rule_host or ends_with(host, '.' || rule_host))
            group by n)
        select page_id, host, path, best.r as rule, coalesce(best.v, 'allow') as verdict
        from parts left join fit using (n)""",
    "op6_decontamination": f"""
        with docs as (select row_number() over () as n, doc_id, {_WORDS} as words from documents),
        items as (select cast(item_id as varchar) as item, words, least(10, len(words)) as size
                  from (select item_id, {_WORDS} as words from benchmark) where len(words) > 0 and item_id is not null),
        windows as (select distinct item, size, array_to_string(words[i:i + size - 1], ' ') as w
                    from (select *, unnest(range(1, len(words) - size + 2)) as i from items)),
        own as (select n, i, size, array_to_string(words[i:i + size - 1], ' ') as w
                from (select n, words, size, unnest(range(1, len(words) - size + 2)) as i
                      from docs, (select distinct size from items))),
        met as (select n, i, size, item from own join windows using (size, w)),
        hit as (select n, count(distinct word) as n_hit
                from (select n, unnest(range(i, i + size)) as word from met) group by n),
        held as (select n, count(*) as n_items, string_agg(item, ',' order by item) as items
                 from (select distinct n, item from met) group by n)
        select doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
               cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(items, '')) as items_sha256,
               coalesce(n_hit, 0) > 0 as contaminated
        from docs left join hit using (n) left join held using (n)""",
}

"""Mixing, neighbours, URL rules, archives, near copies and the pipeline against plain Python."""

import base64
import gzip
import hashlib
import io
import itertools
import random
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from scriptorium.llm import mixing, near_copies, neighbours, queries, stages, urls, warc
from scriptorium.llm.components import components
from tests.llm.test_text_operators import EDGES, SCHEMA, brute_spans, brute_windows, documents, words


# Mixing ------------------------------------------------------------------------------------------

def test_targets_share_all_tokens_and_stop_at_three_times():
    goal = mixing.targets({"b": 100, "a": 10, None: 50, "c": 0, "d": 1000})
    # a weighs 5, b 2, c 1, d 5, null 2: a and c are full, and the rest share what is left.
    assert goal["a"] == 30 and goal["c"] == 0
    assert sum(goal.values()) == pytest.approx(1160)
    assert goal[None] == 150 and goal["b"] == pytest.approx(980 * 2 / 7)
    assert mixing.targets({"x": 0}) == {"x": 0.0} and mixing.targets({}) == {}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 400), st.floats(0.05, 0.95)), max_size=40), st.integers(0, 5))
def test_flight_keeps_both_totals(units, seed):
    sizes, p = np.array([float(s) for s, _ in units]), np.array([q for _, q in units])
    moved = mixing.fly(sizes, p, np.random.default_rng(seed))
    left = (moved > 0) & (moved < 1)
    assert left.sum() <= 2 and ((moved >= 0) & (moved <= 1)).all()
    assert moved @ sizes == pytest.approx(p @ sizes, abs=1e-5 * max(1, sizes.sum()))


def test_every_document_keeps_its_chance():
    sizes, p = np.array([5.0, 9, 2, 7, 4, 30]), np.array([0.2, 0.5, 0.7, 0.4, 0.6, 0.5])
    mean = np.mean([mixing.fly(sizes, p, np.random.default_rng(i)) for i in range(4000)], axis=0)
    assert np.abs(mean - p).max() < 0.04


@pytest.mark.parametrize("block_rows", [7, 2048])
def test_mix(spark, block_rows):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randrange(0, 90), None, rng.choice(["hot"] * 8 + ["a", "b", None, "tiny"]), 1, "", 1, "") for i in range(900)]
    rows += [(None, "w w", None, "a", 1, "", 1, ""), (7, None, None, "b", 1, "", 1, "")] + [(8, "w w w", None, "b", 1, "", 1, "")] * 3
    docs = spark.createDataFrame(rows, SCHEMA)
    mix = lambda: mixing.mix_sources(docs, mixing.word_count(F.col("text")), block_rows=block_rows).collect()
    got = mix()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], len((r[1] or "").split())) for r in rows)
    assert sorted(map(repr, got)) == sorted(map(repr, mix()))
    taken, total, goal = Counter(), Counter(), {}
    for r in got:
        assert 0 <= r.copies <= 3
        taken[r.source] += r.size * r.copies
        total[r.source] += r.size
        goal[r.source] = (r.target, r.source_size)
    assert {s: g for s, (g, _) in goal.items()} == pytest.approx(mixing.targets(dict(total)))
    assert all(goal[s][1] == total[s] for s in goal)
    assert all(abs(taken[s] - goal[s][0]) <= max(8, 0.02 * goal[s][0]) for s in goal)


def test_mix_of_nothing(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mixing.mix_sources(docs, mixing.word_count(F.col("text"))).count() == 0
    docs = spark.createDataFrame([(1, None, None, None, 0, "", 1, "")], SCHEMA)
    row = mixing.mix_sources(docs, mixing.word_count(F.col("text"))).first()
    assert (row.size, row.target, row.source_size) == (0, 0.0, 0)


# Nearest neighbours --------------------------------------------------------------------------------

def brute_neighbours(rows, queries_of, k):
    usable = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v
              and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
    usable = [(i, v) for i, v in usable if len(v) == len(usable[0][1])]
    out = {}
    for q, a in usable:
        if queries_of(q):
            scores = {i: float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b))) for i, b in usable if i != q}
            out[q] = sorted(((-round(s, 9), i) for i, s in scores.items()))[:k]
    return out


@pytest.mark.parametrize("block_rows", [40, 4096])
def test_neighbours_against_all_pairs(spark, block_rows):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((12, 24))
    rows = [(i, (centres[i % 12] + 0.35 * rng.standard_normal(24)).tolist()) for i in range(600)]
    rows += [(i, rows[3][1]) for i in range(600, 900)]  # a third of all rows are equal
    rows += [(1000, None), (1050, []), (1100, [0.0] * 24), (1150, [float("nan")] * 24), (1200, [None] * 24), (1250, [1.0, 2.0]),
             (None, rows[0][1]), (50, rows[50][1])]
    table = spark.createDataFrame([(i, v, i, 0.5) for i, v in rows], "vec_id bigint, embedding array<float>, rank int, score double")
    found = neighbours.nearest_neighbours(table, F.col("vec_id") % 50 == 0, k=5, block_rows=block_rows).collect()
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    truth = brute_neighbours(rows, lambda q: q % 50 == 0, 5)
    got = defaultdict(list)
    for r in found:
        got[r.query_id].append((r["rank"], -round(r.score, 9), r.vec_id))
    assert got.keys() == truth.keys()
    hits = total = 0
    for q, want in truth.items():
        own = sorted(got[q])
        assert [r for r, _, _ in own] == list(range(1, len(want) + 1))
        assert [o[1:] for o in own] == sorted(o[1:] for o in own)
        hits += len({i for _, _, i in own} & {i for _, i in want})
        total += len(want)
    assert hits >= 0.95 * total
    # Equal vectors: the smallest ids of the class, without the query's own.
    assert [i for _, _, i in sorted(got[650])] == [3, 600, 601, 602, 603]


def test_few_and_no_vectors(spark):
    kind = "vec_id bigint, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])], kind)
    got = neighbours.nearest_neighbours(few, F.col("vec_id") == 0).collect()
    assert sorted((r["rank"], r.vec_id, round(r.score, 6)) for r in got) == [(1, 1, round(0.5 ** 0.5, 6)), (2, 2, 0.0)]
    for rows in ([], [(0, [1.0])], [(0, None)]):
        assert neighbours.nearest_neighbours(spark.createDataFrame(rows, kind), F.col("vec_id") == 0).count() == 0


def test_chi_square_test():
    assert neighbours.chi_square_cdf(15.507, 8) == pytest.approx(0.95, abs=1e-4)
    assert neighbours.stop_ratio(0.95, 8) ** 2 == pytest.approx(15.507, abs=1e-3)


# URL rules -----------------------------------------------------------------------------------------

def brute_verdict(url, rules):
    head, mark, rest = (url or "").partition("://")
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest)) if mark else 0
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]) if mark else ""
    path = rest[cut:] if mark else ""
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules
            if path.startswith(p) and (host == h or host.endswith("." + h))]
    return (host, path, max(fits)[3], max(fits)[4]) if fits else (host, path, None, "allow")


URLS = [None, "", "no scheme", "http://", "http://org/", "http://ORG/x", "http://a.org", "http://example.org/es/1", "http://x.Example.org/en/12",
        "http://notexample.org/es/", "http://example.org.com/fr/", "x://y.com/de/?u=http://a.org/", "http://com/de", "http://u@a.com:80/de/",
        "http://a.com?x=/de/", "http://a.com#/de/", "http://é.org/é", "http://" + "a." * 20_000 + "org/" + "p" * 50_000, "a\n://b.org/\n/x", "http://.org/"]


def test_url_rules(spark):
    rules = [*queries.URL_RULES, ("Net", "", "block"), ("net", "", "allow"), ("a.com", "/fr/", "block")]
    rows = [(i, u, "", "host", "p") for i, u in enumerate(URLS)] + [(3, URLS[7], "", "", "")] * 2 + [(None, URLS[8], "", "", ""), (30, "http://x.net/a", "", "", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, host string, prefix string")
    table = spark.createDataFrame([*rules, (None, "/", "block"), ("org", None, "block")], "host string, path string, verdict string")
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.filter_urls(pages, table).collect())
    known = [(r[0].lower(), *r[1:]) for r in rules]
    assert got == Counter((r[0], *brute_verdict(r[1], known)) for r in rows)
    assert urls.filter_urls(pages.limit(0), table).count() == 0
    assert {r.verdict for r in urls.filter_urls(pages, table.limit(0), default="block").collect()} == {"block"}


# Archives ------------------------------------------------------------------------------------------

PAGES = [(1, "http://a/", "same"), (2, "http://b/\r\nWARC-Type: x", "same"), (3, None, ""), (4, "u é", None), (5, "u", "é" * 100_000),
         (6, "u", "x\r\n\r\ny\r\n\r\n"), (7, "u", "same"), (7, "u", "same"), (None, "u", "same"), (None, "u", "lone"), (8, "u", "WARC/1.1\r\n")]


def expected_records(pages, min_bytes):
    groups = defaultdict(list)
    for i, _, html in pages:
        groups[html or ""].append(i)
    out = Counter()
    for i, _, html in pages:
        data = (html or "").encode()
        latest = max((x for x in groups[html or ""] if x is not None), default=None)
        revisit = latest is not None and i != latest and len(data) >= min_bytes
        out[i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response",
            latest if revisit else None] += 1
    return out


@pytest.mark.parametrize("min_bytes, archive_bytes", [(0, 1 << 20), (1, 1), (5, 600)])
def test_archives_round_trip(spark, min_bytes, archive_bytes):
    pages = spark.createDataFrame([(*p, "", 1) for p in PAGES], "page_id bigint, url string, html string, sha1 string, n int")
    folder = warc.archive_folder(spark)
    index = warc.write_archives(pages, folder, min_bytes, archive_bytes=archive_bytes)
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_records(index, folder).collect())
    assert got == expected_records(PAGES, min_bytes)
    # A selection reads only what it names, and the archives are what other readers of the format expect.
    few = warc.read_records(index.where("page_id = 5"), folder).collect()
    assert [r.payload_bytes for r in few] == [200_000]
    files = {r.archive for r in index.collect()}
    for name in files:
        data = gzip.decompress(Path(folder.removeprefix("file:"), name).read_bytes())
        assert data.startswith(b"WARC/1.1\r\n") and b"\r\nWARC-Type: x" not in data


def test_no_pages(spark):
    folder = warc.archive_folder(spark)
    index = warc.write_archives(spark.createDataFrame([], "page_id bigint, url string, html string"), folder)
    assert index.count() == 0 and warc.read_records(index, folder).count() == 0


def test_damage_is_an_error(spark):
    pages = spark.createDataFrame([(1, "u", "text")], "page_id bigint, url string, html string")
    folder = warc.archive_folder(spark)
    index = warc.write_archives(pages, folder)
    with pytest.raises(Exception, match="damaged"):
        warc.read_records(index.withColumn("digest", F.lit("A")), folder).collect()


def test_neighbouring_records_are_read_together():
    rows = [("a", 0, 10), ("a", 10, 5), ("a", 100, 5), ("b", 105, 5), ("b", 110, 90), ("b", 200, 5)]
    assert [[r[1] for r in run] for run in warc.ranges(rows, gap_bytes=20, range_bytes=96)] == [[0, 10], [100], [105, 110], [200]]


# Components and near copies ------------------------------------------------------------------------

def brute_components(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        parent[root(a)] = root(b)
    groups = defaultdict(set)
    for x in list(parent):
        groups[root(x)].add(x)
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("edges", [
    [(0, i) for i in range(1, 400)], [(i, i + 1) for i in range(60)], [(5, 5)], [],
    [(i, j) for i, j in itertools.product(range(0, 300, 7), range(0, 300, 11)) if (i * j) % 13 == 1]])
def test_components(spark, edges):
    got = defaultdict(set)
    for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect():
        got[r.component].add(r.node)
    assert {frozenset(g) for g in got.values()} == brute_components([e for e in edges if e[0] != e[1]])


def shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_classes(rows):
    sets = [shingles(t) for _, t in rows]
    linked = lambda a, b: bool(a and b) and len(a & b) >= 0.8 * len(a | b) - 1e-9
    links = [[j for j in range(len(rows)) if j != i and linked(sets[i], sets[j])] for i in range(len(rows))]
    edges = [(i, j) for i in range(len(rows)) for j in [i, *links[i]]]
    out = []
    for group in brute_components(edges):
        ids = [rows[i][0] for i in group if rows[i][0] is not None]
        out += [(rows[i][0], min(ids, default=None), len(links[i])) for i in group]
    return Counter(out)


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(11)
    draw = lambda n: [rng.choice("the of and to in is was for on that with as".split()) + rng.choice("abcdefghij") for _ in range(n)]
    texts = []
    for _ in range(30):
        base = draw(rng.choice([3, 6, 40, 150]))
        texts += [base] * rng.choice([1, 1, 2])
        for _ in range(rng.choice([0, 1, 4])):
            near = list(base)
            for _ in range(rng.choice([1, 1, 2, 3])):
                near[rng.randrange(len(near))] = rng.choice(["x", "y"])
            texts.append(near)
    hot = draw(200)
    for i in range(40):  # a third of all rows: copies with one word of their own, far apart
        near = list(hot)
        near[(i * 37) % 200] = f"own{i}"
        texts += [near] * (1 + i % 2)
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    rng.shuffle(rows)
    return rows + [(900, "Same Words, here: it IS so"), (901, "same words here it is SO!")] + [e for e in EDGES if e[0] != 4]


@pytest.mark.parametrize("block_texts", [8, 2048])
def test_near_copies_are_those_of_all_pairs(spark, copies, block_texts):
    found = near_copies.near_copies(documents(spark, copies), block_texts=block_texts).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in found) == brute_classes(copies)
    # One identity of each class stays.
    classes = defaultdict(set)
    for r in found:
        if r.stays:
            classes[r.class_id].add((r.doc_id, r._h))
    odd = {i for i, _ in EDGES}  # ids that name several texts
    assert all(len(v) == 1 for c, v in classes.items() if c not in odd)
    assert set(classes) == {r.class_id for r in found}


def test_pairs_at_the_threshold_are_linked():
    for k in [*range(1, 400), 99_999]:  # 4k shared shingles of 5k: exactly 0.8
        short, long = np.arange(4 * k, dtype=np.uint64), np.arange(5 * k, dtype=np.uint64)
        assert near_copies.linked([short], [long]).all() and near_copies.linked([long], [short]).all(), k
        assert not near_copies.linked([short[:-1]], [long]).any(), k


def test_documents_at_the_threshold_are_linked(spark):
    text = [f"w{i}" for i in range(34)]
    rows = [(1, " ".join(text[:16])), (2, " ".join(text[:19])), (3, " ".join(text[5:33])), (4, " ".join(text[5:] + ["a", "b", "c", "d", "e"]))]
    found = near_copies.near_copies(documents(spark, rows)).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in found) == brute_classes(rows)
    assert {r.doc_id: r.n_links for r in found} == {1: 1, 2: 1, 3: 1, 4: 1}


def test_no_documents(spark):
    assert near_copies.near_copies(documents(spark, [])).count() == 0
    got = near_copies.near_copies(documents(spark, EDGES[:3])).collect()
    assert [(r.n_links, r.n_copies, r.stays) for r in got] == [(0, 1, True)] * 3


def test_prefixes_are_shortened_until_the_recall_is_met():
    assert near_copies.prefix_depth(0.8, 16, 6, 0.998) == 5
    assert near_copies.prefix_depth(0.8, 16, 6, 0.9) == 6
    assert near_copies.prefix_depth(0.5, 2, 6, 0.999) == 1


# The pipeline --------------------------------------------------------------------------------------

ODD = [(0, None), (1, ""), (2, "mail a@b.c now"), (2, "mail a@b.c now"), (None, "some words here to be kept"), (3, "x " * 30_000)]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_rows_and_keep_the_columns(spark, name, stage):
    sf_dir = "/root/testdata/sf0.001"
    docs = documents(spark, ODD)
    kept = stage(spark, docs, sf_dir)
    last = stage is stages.mixing_stage
    assert kept.columns[:len(docs.columns)] == docs.columns and (last or kept.columns == docs.columns)
    assert kept.count() <= len(ODD)
    assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_rows_without_words_all_stay(spark):
    rows = [(None, None, "a"), (None, None, "b"), (None, "", "a"), (None, "", "a"), (5, "!!", "a"), (5, "!!", "b"),
            (6, "these words are here twice", "a"), (6, "these words are here twice", "a"), (7, "These words are here twice", "a")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = Counter(tuple(r) for r in stages.near_copies_stage(spark, docs, None).collect())
    assert kept == Counter(rows[:7])


def test_pipeline_against_plain_python(spark, tmp_path):
    """Every stage on what the one before it has kept, each judged by a plain version of its rule."""
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    seen = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(str(tmp_path / str(number)))
        seen.append(({r.doc_id: r for r in docs.collect()}, {}))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        seen[-1][1].update({r.doc_id: r for r in docs.collect()})
    (first, good), (_, single), (_, clean), (_, masked), (_, mixed) = seen
    assert sum((i in good) == (labels[i] == 1) for i in labels) >= 0.97 * len(labels)
    texts = [(i, r.text) for i, r in good.items()]
    groups = defaultdict(set)
    for (i, c, _) in brute_classes(texts):
        groups[c].add(i)
    assert set(single) == set(groups)
    assert set(clean) == {i for i, _, hit, _ in brute_windows([(i, r.text) for i, r in single.items()], items) if not hit}
    assert set(masked) == set(clean)
    for i, row in masked.items():
        spans = brute_spans(clean[i].text)
        assert row.n_chars == len(row.text) and (row.text == clean[i].text) == (not spans)
        assert all(clean[i].text[a:b] not in row.text for _, a, b in spans)
    total = Counter()
    for r in masked.values():
        total[r.source] += len(mixing_words(r.text))
    goal = mixing.targets(dict(total))
    assert set(mixed) <= set(masked)
    for i, r in mixed.items():
        assert r.text == masked[i].text and r.size == len(mixing_words(r.text)) and r.taken in (r.size, 2 * r.size, 3 * r.size)
        assert r.target == pytest.approx(goal[r.source]) and r.source_size == total[r.source]
    rerun = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.taken) for r in rerun) == sorted((i, r.taken) for i, r in mixed.items())


def mixing_words(text):
    return (text or "").encode().split()


def test_archive_reader_reads_one_range(spark):
    record = warc.record(5, "u", b"abc", warc.payload_digest(b"abc"))
    fields, block = warc.parse(record)
    assert fields["warc-type"] == "response" and block.endswith(b"\r\n\r\nabc")
    with pytest.raises(ValueError):
        warc.parse(record[:-1])
    assert io.BytesIO(record).readline() == b"WARC/1.1\r\n"

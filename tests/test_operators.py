import functools
import itertools
import math
import random
import re
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scriptorium.functions import alignment
from scriptorium.functions.distance import text_distance
from scriptorium.functions.replies import CATEGORIES
from scriptorium.operators import (
    correct, decoding, entities, evaluate, gazetteer, layout, letters, numbering, status)
from scriptorium.sources import derived


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns or df.columns).collect())


# Layout

def test_flatten_layout(spark):
    schema = "doc_id string, pages array<struct<lines:array<struct<content:string,polygon:array<double>>>>>"
    data = [("a", [([("x", [1.0]), ("y", None)],), (None,), ([("z", [])],)]), ("b", None), ("c", [])]
    got = rows(layout.flatten_layout(spark.createDataFrame(data, schema)))
    assert got == [("a", 1, 0, "x", [1.0]), ("a", 1, 1, "y", []), ("a", 3, 2, "z", [])]


def test_assemble_text_keeps_order_blank_lines_and_empty_documents(spark):
    lines = spark.createDataFrame(
        [(1, 2, 0, "d"), (1, 1, 1, ""), (1, 1, 0, "a"), (1, 1, 10, "c"), (1, 1, 9, "b")],
        "doc_id int, page int, line_no int, text string")
    files = spark.createDataFrame([(1,), (2,)], "doc_id int")
    raw = layout.with_empty_documents(files, layout.assemble_text(lines))
    assert rows(raw) == [(1, "a\n\nb\nc\nd", 5), (2, "", 0)]
    assert rows(layout.empty_documents(files, lines)) == [(2,)]


def test_assemble_text_by_page(spark):
    lines = spark.createDataFrame([(1, 1, 0, "a"), (1, 2, 1, "c"), (1, 1, 1, "b")],
                                  "doc_id int, page int, line_no int, text string")
    pages = layout.assemble_text(lines, ["doc_id", "page"], ["line_no"])
    assert rows(pages) == [(1, 1, "a\nb", 2), (1, 2, "c", 1)]


def test_assemble_pages_reads_lines_only(spark):
    schema = "job_id string, page_ord int, Blocks array<struct<BlockType:string,Text:string>>"
    pages = spark.createDataFrame([
        ("j", 2, [("LINE", "c")]), ("j", 1, [("PAGE", None), ("LINE", "a"), ("WORD", "a"), ("LINE", "b")]),
        ("j", 3, None), ("k", 1, [("WORD", "w")])], schema)
    assert rows(layout.assemble_pages(pages)) == [("j", "a\nb\nc", 3), ("k", "", 0)]


def test_number_pages(spark):
    df = spark.createDataFrame([("a", ["p", None, "q"]), ("b", []), ("c", None)], "k string, xs array<string>")
    assert [tuple(r) for r in layout.number_pages(df, "xs").orderBy("page").collect()] == [
        ("a", 1, "p"), ("a", 2, None), ("a", 3, "q")]


# Numbering

@pytest.mark.parametrize("n,size,sizes", [(7, 3, [3, 3, 1]), (0, 3, []), (2, 5, [2]), (6, 3, [3, 3])])
def test_batch_sizes(spark, n, size, sizes):
    df = spark.createDataFrame([(f"f{i:02d}", i) for i in range(n)], "name string, id int")
    got = numbering.assign_batches(df, size, ["name", "id"]).groupBy("batch_id").count()
    assert [c for _, c in sorted(map(tuple, got.collect()))] == sizes


def test_row_numbers_with_a_hot_name(spark):
    rng = random.Random(3)
    data = [("same" if rng.random() < .4 else f"n{rng.randint(0, 500)}", i) for i in range(3000)]
    df = spark.createDataFrame(data, "name string, id int").repartition(5)
    got = numbering.global_row_number(df, ["name", "id"]).collect()
    assert [(r["name"], r["id"]) for r in sorted(got, key=lambda r: r.row_no)] == sorted(data)
    assert sorted(r.row_no for r in got) == list(range(3000))


# Status

def test_first_terminal_status(spark):
    waits = lambda job, n, start=0: [(job, start + i, i, "IN_PROGRESS") for i in range(n)]
    events = [("first", 0, 0, "SUCCEEDED"), *waits("last", 2), ("last", 5, 9, "FAILED"),
              *waits("late", 3), ("late", 5, 9, "SUCCEEDED"), *waits("open", 1),
              ("both", 1, 2, "FAILED"), ("both", 1, 1, "SUCCEEDED"), ("both", 0, 5, "IN_PROGRESS")]
    df = spark.createDataFrame(events, "job_id string, ts int, event_id int, status string")
    got = rows(status.first_terminal_status(df, max_retries=3))
    assert got == [("both", "SUCCEEDED", 2), ("first", "SUCCEEDED", 1), ("last", "FAILED", 3),
                   ("late", "TIMED_OUT", 3), ("open", "TIMED_OUT", 3)]
    failed = status.failed_documents(status.first_terminal_status(df, max_retries=3))
    assert rows(failed, "job_id", "reason") == [("last", "job_failed"), ("late", "timeout"), ("open", "timeout")]
    assert rows(status.first_terminal_status(df.where("false"))) == []


def test_last_wins_and_handoff(spark):
    df = spark.createDataFrame([("a", "a.jpg", 1), ("a", "a.png", 2), ("a", "a.png", 1), ("b", "b.pdf", 3)],
                               "base_name string, name string, id int")
    winners = status.last_wins(df, "base_name", ["name", "id"])
    assert rows(winners, "base_name", "name", "id") == [("a", "a.png", 2), ("b", "b.pdf", 3)]
    assert rows(status.superseded(df, "base_name", ["name", "id"]), "name", "id") == [("a.jpg", 1), ("a.png", 1)]
    jobs = spark.createDataFrame([("a", "j1"), ("z", "j9")], "base_name string, job_id string")
    assert rows(status.handoff(jobs, winners), "base_name", "job_id") == [("a", "j1")]
    assert rows(status.not_handed_over(winners, jobs), "base_name") == [("b",)]


def test_run_summary(spark):
    df = spark.createDataFrame([("SUCCEEDED", "2024-01-01 00:00:00", "2024-01-01 01:00:01"),
                                ("FAILED", "2024-01-01 00:00:30", "2024-01-01 02:01:40"),
                                ("TIMED_OUT", "2024-01-01 00:00:30", "2024-01-01 00:01:40")],
                               "status string, started string, finished string")
    assert rows(status.run_summary(df, 2)) == [(3, 2, 2, 1, 2, "2h 1m 40s")]


# Letters

def brute_letters(text):
    if text == "":
        return []
    segments, current, signed = [], [], False
    for line in text.split("\n"):
        current.append(line)
        if line.strip() == "":
            if signed:
                segments.append(current)
                current = []
            signed = False
        elif re.match(letters.SIGN_OFF, line):
            signed = True
    if current:
        segments.append(current)
    found, greeted = [], False
    for segment in segments:
        greets = any(re.match(letters.GREETING, line) for line in segment)
        if not found or (greets and greeted):
            found.append(segment)
        else:
            found[-1] = found[-1] + segment
        greeted = greeted or greets
    return ["\n".join(letter) for letter in found]


def test_letters_follow_the_rule(spark):
    rng = random.Random(7)
    parts = ["Dear Sir:", "Friend,", "Yours truly,", "Sincerely yours", "", "", " ", "body", "Yours", "12"]
    texts = ["\n".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    texts += ["", "\n", "Dear A\nx\nYours truly,\nN\n\nDear B\ny\nYours truly,\nM",
              "Dear A\nYours truly,\nDear B\nYours truly,", "Dear A\nYours truly,\n\ntrailing"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r.letters for r in letters.letter_arrays(df).collect()}
    for i, text in enumerate(texts):
        assert got[i] == brute_letters(text), text
        if text:
            assert "\n".join(got[i]) == text


def test_split_letters_rows(spark):
    df = spark.createDataFrame([(1, "7\nDear A\nYours truly,\nN\n\nDear B"), (2, ""), (3, "no marks")],
                               "doc_id int, text string")
    assert [tuple(r) for r in letters.split_letters(df).orderBy("doc_id", "letter_no").collect()] == [
        (1, 7, 1, "7\nDear A\nYours truly,\nN\n"), (1, 7, 2, "Dear B"), (3, None, 1, "no marks")]


# Correction

def test_correct_text(spark):
    lexicon = spark.createDataFrame([("tbe", "the"), ("Tbere", "There!"), ("aud", "and")],
                                    "wrong string, right string")
    texts = {1: "Tbe (tbe) cat,\n\n aud  tbe. Tbere tbex", 2: "nothing here", 3: "", 4: None, 5: "tBe\ntbe\n"}
    df = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    got = {r.doc_id: r.corrected_text for r in correct.correct_text(df, lexicon).collect()}
    assert got == {1: "The (the) cat,\n\n and  the. There! tbex", 2: "nothing here", 3: "", 4: None,
                   5: "the\nthe\n"}


def test_correct_long_text_over_pieces(spark):
    words = [f"w{i % 700}" for i in range(3 * correct.PIECE + 17)]
    lexicon = spark.createDataFrame([(f"w{i}", f"x{i}") for i in range(0, 700, 3)], "wrong string, right string")
    text = "".join(w + (" " if i % 11 else "\n") for i, w in enumerate(words))
    expected = re.sub(r"w(\d+)", lambda m: ("x" if int(m[1]) % 3 == 0 else "w") + m[1], text)
    df = spark.createDataFrame([(1, text)], "doc_id int, text string")
    assert correct.correct_text(df, lexicon).first().corrected_text == expected


def test_tokens_give_the_text_back(value):
    for raw in ["", " ", "\n", "a\n b", "a \n  \n\n b ", "\n \n", "x y\nz"]:
        assert value(lambda c: correct.untokenised(correct.tokens(c)), raw) == raw


def test_correct_text_in_the_row_and_by_a_join(spark):
    rng = random.Random(8)
    words = ["Tbe", "tbe", "TBE", "x_tbe,", "--", "é", "aud", "(aud", "a\tb", "", "9th_", "andtbe"]
    texts = [(i, rng.choice([" ", "\n"]).join(rng.choice(words) for _ in range(rng.randrange(2500)))) for i in range(25)] + [(99, None)]
    df = spark.createDataFrame(texts, "doc_id int, text string")
    lexicon = spark.createDataFrame([("tbe", "the"), ("x_tbe", "x the"), ("aud", "and"), ("andtbe", "and the")], "wrong string, right string")
    assert rows(correct.correct_text(df, lexicon)) == rows(correct.correct_text(df, lexicon, in_row=0))
    empty = lexicon.where("false")
    assert rows(correct.correct_text(df, empty)) == sorted((i, t, t) for i, t in texts)


def test_paired_lexicon(spark):
    df = spark.createDataFrame([("Tbe cat, aud", "The cat, and"), ("tbat aud", "that add"), ("aud so", "add so"), ("a b", "a")],
                               "raw string, corrected string")
    # Of two targets the more frequent one counts, and a word that mostly stays has none.
    assert rows(correct.paired_lexicon(df)) == [("Tbe", "The"), ("aud", "add"), ("tbat", "that")]
    stays = spark.createDataFrame([("tbe x", "the x"), ("tbe y", "tbe y"), ("tbe z", "tbe z")], "raw string, corrected string")
    assert rows(correct.paired_lexicon(stays)) == []


def test_paired_lexicon_aligns_inside_lines_and_over_lost_line_ends(spark):
    df = spark.createDataFrame([
        ("a cat andtbe dog saw tbat bird", "a cat and the dog saw that bird"),
        ("one tbing more\nand two\nwitb four words bere", "one thing\nmore and two with\nfour words here"),
        ("a th ing was lost here qqqq", "a thing was lost here"), ("tbis is it all", None)], "raw string, corrected string")
    aligned = correct.aligned_words(df)
    assert rows(correct.best_targets(aligned), "wrong", "right") == [
        ("andtbe", "and the"), ("bere", "here"), ("tbat", "that"), ("tbing", "thing"), ("witb", "with")]
    assert ("th ing", "thing", 1) in rows(aligned.where("wrong is not null"))
    assert tuple(correct.unaligned_words(aligned).first()) == (23, 1)
    assert tuple(correct.unaligned_words(correct.aligned_words(df.where("false"))).first()) == (0, 0)


def known_alignment(text, mark=""):
    marked = [t for t in text.replace(" and ", " and\x01").replace("\n", " ").split(" ") if t]
    raw = text.replace("th", "tb").replace(" and ", " and" + mark)
    return raw, [(t.replace("th", "tb").replace("\x01", mark), t.replace("\x01", " ")) for t in marked]


@pytest.mark.parametrize("mark", ["", "_"])
def test_words_are_aligned_as_they_were_misread(mark):
    rng = random.Random(11)
    parts = ["the", "th", "and", "on", "er", "ing", "st", "re", "an", "thth", "wh", "tion"]
    vocabulary = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(500)]
    total = missed = alone = 0
    for _ in range(60):
        text = "".join(rng.choice(["and", *rng.sample(vocabulary, 9)]) + (" " if rng.random() < 0.93 else "\n") for _ in range(400))
        raw, known = known_alignment(text, mark)
        got, left = alignment.word_pairs(raw, text)
        total, missed = total + len(known), missed + sum((Counter(known) - Counter(got)).values())
        alone += left
    assert missed <= total // 200 and alone <= total // 500


def test_spans_are_the_cheapest():
    rng = random.Random(12)

    def cheapest(a, b):
        if not a and not b:
            return 0
        costs = []
        for m, n in alignment._STEPS:
            if m <= len(a) and n <= len(b):
                step = alignment._span_cost(a[:m], b[:n]) if m and n else len((a[:m] + b[:n])[0]) + 1
                if step is not None:
                    costs.append(step + cheapest(a[m:], b[n:]))
        return min(costs)
    for _ in range(60):
        a, b = ([rng.choice(["a", "ab", "the", "tbe", "thethe", "an", "anthe", "b"]) for _ in range(rng.randrange(6))] for _ in range(2))
        spans = alignment.best_spans(a, b)
        cost = sum(alignment._span_cost(a[i:x], b[j:y]) if i < x and j < y else len((a[i:x] + b[j:y])[0]) + 1 for i, x, j, y in spans)
        assert cost == cheapest(a, b)
        assert [k for i, x, _, _ in spans for k in range(i, x)] == list(range(len(a)))
        assert [k for _, _, j, y in spans for k in range(j, y)] == list(range(len(b)))


@pytest.mark.parametrize("inserted", [3000, 20_000])
def test_words_after_many_inserted_ones_are_found(inserted):
    words = [f"w{i % 97}" for i in range(200)]
    noise = [f"n{i % 89}" for i in range(inserted)]
    pairs, left = alignment.word_pairs(" ".join(noise + words), " ".join(words[:1] + words[1:]))
    assert left == inserted and len(pairs) == 200


@pytest.mark.parametrize("few", [1, 2, 3])
def test_few_words_are_set_against_many(few):
    words, many = ["first", "second", "third"][:few], [f"n{i % 89}" for i in range(5000)]
    for a, b in ((many + words, words), (words, many + words)):
        spans = alignment._long_gap(a, b, 0, len(a), 0, len(b))
        assert [(" ".join(a[i:x]), " ".join(b[j:y])) for i, x, j, y in spans if i < x and j < y] == [(w, w) for w in words]
        assert sum(x - i + y - j for i, x, j, y in spans) == len(a) + len(b)


@pytest.mark.parametrize("mark", ["", "_"])
def test_words_in_step_need_no_subsequence(mark, monkeypatch):
    monkeypatch.setattr(alignment, "anchors", None)
    for text in ("an cat and the dog saw and a bird", "the of this and be of", "an and a a ednt the", "one and and two\nthat thing and with and"):
        raw, known = known_alignment(text, mark)
        pairs, left = alignment.word_pairs(raw, text)
        assert left == 0 and Counter(pairs) == Counter(known)


def test_equal_lines_with_other_words_are_paired_by_place():
    assert alignment.paired_words("a  tbe\nx ", "a q the\nx y") == (["a", "x"], [("", "q"), ("tbe", "the"), ("", "y")], 0, 3)
    # As many words, but in other lines.
    assert alignment.paired_words("a tbe\nx", "a\nthe x") == (["a", "x"], [("tbe", "the")], 0, 3)


def test_anchors_are_a_longest_common_subsequence():
    rng = random.Random(5)
    for _ in range(200):
        a, b = ([rng.choice("abcde") for _ in range(rng.randrange(12))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        found = alignment.common_words(a, b)
        assert len(found) == best[-1][-1] and all(a[i] == b[j] for i, j in found)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(found, found[1:]))


def test_long_texts_are_aligned_over_windows():
    rng = random.Random(6)
    words = [rng.choice("the of and to in is was for with that this thing".split()) for _ in range(9000)]
    raw, known = known_alignment(" ".join(words))
    pairs, left = alignment.word_pairs(raw, " ".join(words))
    # So few words repeat at once, and yet nearly all come to the word they were.
    assert left < 20 and sum((Counter(known) - Counter(pairs)).values()) < len(known) // 100


# Decoding

def brute_path(words, follows):
    best = None
    for path in itertools.product(*words):
        value = sum(s for _, s in path)
        for (a, _), (b, _) in zip(path, path[1:]):
            value += follows.get(f"{a.split(' ')[-1]}\n{b.split(' ')[0]}", 0.0) if a else 0.0
        if best is None or value > best + 1e-12:
            best = value
    return best


def test_the_path_is_the_best_of_all():
    rng = random.Random(3)
    for _ in range(200):
        names = ["a", "b", "c d", "e", "d"]
        words = [[(n, -rng.randrange(5)) for n in rng.sample(names, rng.randrange(1, 4))] for _ in range(rng.randrange(1, 6))]
        follows = {f"{a}\n{b}": rng.randrange(4) * 1.0 for a in "abcde" for b in "abcde" if rng.random() < 0.5}
        path = decoding.best_path(words, follows)
        value = sum(dict(w)[p] for w, p in zip(words, path)) + sum(
            follows.get(f"{a.split(' ')[-1]}\n{b.split(' ')[0]}", 0.0) for a, b in zip(path, path[1:]))
        assert value == pytest.approx(brute_path(words, follows))


def test_lattice_sums_over_all_readings():
    letters = decoding.Letters({("h", "b"): 3.0, ("h", "h"): 5.0, ("t", "t"): 9.0, ("e", ""): 1.0, ("e", "e"): 4.0, ("", "x"): 0.5})

    def sum_of(seen, true):
        if not seen and not true:
            return 1.0
        value = 0.0
        if seen:
            value += letters.added(seen[0]) * sum_of(seen[1:], true)
        if true:
            value += letters.read(true[0], "") * sum_of(seen, true[1:])
        if seen and true:
            value += letters.read(true[0], seen[0]) * sum_of(seen[1:], true[1:])
        return value
    for seen, true in (("tbe", "the"), ("", "he"), ("xt", "t"), ("tb", "the"), ("eh", "he")):
        ahead, back, *_ = decoding.lattice(seen, true, letters)
        assert ahead[-1][-1] == pytest.approx(sum_of(seen, true)) == pytest.approx(back[0][0])
        counts = decoding.expected(seen, true, letters)
        assert sum(n for (c, _), n in counts.items() if c) == pytest.approx(len(true))


def letter_model(spark, lines):
    texts = spark.createDataFrame(lines, "doc_id int, raw string, corrected string")
    return texts, decoding.learn_model(texts, correct.aligned_words(texts))


def test_letters_are_learned_and_new_words_decoded(spark):
    lines = [(i, f"tbe cat sat on tbe mat witb a batb number {i}", f"the cat sat on the mat with a bath number {i}") for i in range(30)]
    lines += [(100 + i, "three months", "three months") for i in range(5)]
    texts, model = letter_model(spark, lines)
    assert model.letters.read("h", "b") > 0.3 and model.letters.read("t", "b") < 0.01 and model.letters.read("b", "b") > 0.9
    # No pair has these words: a likely confusion leads to each from a word that the corrected texts have.
    fresh = spark.createDataFrame([(1, "Tbe montbs, witb tbree bats\nzzz  (tbe)"), (2, None), (3, "")], "doc_id int, text string")
    open_words = spark.createDataFrame([(w, 1) for w in ("Tbe", "montbs", "witb", "tbree", "bats", "zzz", "tbe", "the")], "word string, n int")
    model = decoding.learn_model(texts, correct.aligned_words(texts), open_words)
    expected = [(1, "The months, with three bats\nzzz  (the)"), (2, None), (3, "")]
    for bound in (10_000, 0):
        got = decoding.decode_texts(fresh, model, in_row=bound)
        assert sorted((r.doc_id, r.corrected_text) for r in got.collect()) == expected


def test_the_neighbour_decides_between_two_words(spark):
    lines = [(i, "read tbe stbe once", "read the sthe once") for i in range(20)] + [(50 + i, "old stbe here", "old stbe here") for i in range(20)]
    texts, model = letter_model(spark, lines)
    fresh = spark.createDataFrame([(1, "tbe stbe"), (2, "old stbe"), (3, "Old Stbe stbe")], "doc_id int, text string")
    got = {bound: {r.doc_id: r.corrected_text for r in decoding.decode_texts(fresh, model, in_row=bound).collect()} for bound in (1000, 0)}
    assert got[1000] == got[0] and got[0][1] == "the sthe" and got[0][2] == "old stbe"


def test_decoding_is_nearer_to_the_truth_than_the_lexicon(spark, sf_dir):
    """Half of the documents teach, with words read as one; the other half is corrected."""
    pairs = derived.v_pairs(spark, sf_dir).select(
        "doc_id", F.replace("raw", F.lit(" and "), F.lit(" and")).alias("raw"), F.col("target").alias("corrected"))
    teach, rest = pairs.where("doc_id % 2 = 0"), pairs.where("doc_id % 2 = 1").withColumnRenamed("raw", "text")
    aligned = correct.aligned_words(teach)
    words = rest.select(F.explode(F.array_distinct(F.transform(correct.tokens(F.col("text")), correct.bare))).alias("word")).distinct()
    model = decoding.learn_model(teach, aligned, words)
    distance = lambda df, column: sum(r.d for r in df.select(text_distance(F.col(column), F.col("corrected")).alias("d")).collect())
    before = distance(rest, "text")
    lexicon = distance(correct.correct_text(rest, correct.best_targets(aligned)), "corrected_text")
    decoded = distance(decoding.decode_texts(rest, model), "corrected_text")
    print(before, lexicon, decoded)
    assert decoded < 0.9 * lexicon < before


def test_corpus_lexicon_is_brute_force(spark):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    words = [w for w in vocabulary for _ in range(rng.choice([1, 1, 2, 3, 6, 9]))]
    df = spark.createDataFrame([(" ".join(words[i::7]),) for i in range(7)], "text string")
    counts = defaultdict(int)
    for w in words:
        counts[w] += 1

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        short, long = sorted((a, b), key=len)
        return any(long[:i] + long[i + 1:] == short for i in range(len(long))) and len(long) - len(short) == 1

    expected = []
    for w, n in counts.items():
        if n < 5 and len(w) >= 4:
            good = [(-m, g) for g, m in counts.items() if m >= 5 and g[0] == w[0] and near(w, g)]
            if good:
                expected.append((w, min(good)[1]))
    assert rows(correct.corpus_lexicon(df)) == sorted(expected)


def test_effective_text(value):
    both = correct.effective_text
    assert [value(both, "raw", c) for c in (None, "", "c")] == ["raw", "", "c"]


# Entities

GAZETTEER = [("People", "John Smith"), ("People", "John Smith Jr."), ("Theaters", "Smith"),
             ("Theaters", "The Globe"), ("Companies", "the globe"), ("People", "--")]


def test_extract_entities(spark):
    texts = {1: "Dear john smith, (John Smith Jr.) of The\nGlobe! Smith", 2: "none", 3: "",
             4: "On 1920-05-01 and May 3, 1921 or 4 June 1922; 1920-05-01 again, 1920-1-1"}
    df = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    gazetteer = spark.createDataFrame(GAZETTEER, "category string, name string")
    got = {r.doc_id: r for r in entities.extract_entities(df, gazetteer).collect()}
    assert got[1].People == ["John Smith", "John Smith Jr."]
    assert got[1].Theaters == ["Smith", "The Globe"] and got[1].Companies == ["the globe"]
    assert got[2].People == [] and got[3].Dates == []
    assert got[4].Dates == ["1920-05-01", "May 3, 1921", "4 June 1922"]
    none = entities.extract_entities(df, gazetteer.where("false")).where("doc_id = 4").first()
    assert none.People == [] and len(none.Dates) == 3


def brute_names(words, phrases):
    """{position: longest phrase that begins there}"""
    out = {}
    for at in range(len(words)):
        fits = [p for p in phrases if words[at:at + len(p.split(" "))] == p.split(" ")]
        if fits:
            out[at] = max(fits, key=lambda p: len(p.split(" ")))
    return out


def test_automaton_finds_the_longest_name_everywhere():
    rng = random.Random(4)
    for _ in range(300):
        phrases = sorted({" ".join(rng.choice("abc") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(1, 12))})
        words = [rng.choice("abcd") for _ in range(rng.randrange(40))]
        found = gazetteer.Automaton(phrases).longest(words)
        assert {at: phrases[n] for at, n in found.items()} == brute_names(words, phrases)
        assert list(found) == sorted(found)


@pytest.mark.parametrize("most_bits", [1 << 27, 1 << 10])
def test_names_in_the_row_and_by_a_join(spark, most_bits, monkeypatch):
    monkeypatch.setattr(gazetteer, "joined_names", functools.partial(gazetteer.joined_names, most_bits=most_bits))
    monkeypatch.setattr(entities, "joined_names", gazetteer.joined_names)
    rng = random.Random(9)
    word = lambda: rng.choice(["a", "B", "c,", "(d", "é", "The", "--", "globe\n"])
    texts = [(i, " ".join(word() for _ in range(rng.randrange(600)))) for i in range(40)] + [(98, None), (99, "")]
    df = spark.createDataFrame(texts, "doc_id int, text string")
    names = [(rng.choice(CATEGORIES[:4]), " ".join(word().strip("\n") for _ in range(rng.randrange(1, 5)))) for _ in range(60)]
    table = spark.createDataFrame(names + GAZETTEER, "category string, name string")
    got = [entities.extract_entities(df, table, in_row=bound).orderBy("doc_id").select("doc_id", *CATEGORIES).collect() for bound in (1000, 0)]
    assert got[0] == got[1] and sum(len(r.People) for r in got[0]) > 40


def test_extract_entities_in_a_long_text(spark):
    words = ["x"] * 200_000
    for at in (999, 1998, 150_000):
        words[at:at + 3] = ["John", "Smith", "Jr."]
    df = spark.createDataFrame([(1, " ".join(words))], "doc_id int, text string")
    table = spark.createDataFrame(GAZETTEER[:2], "category string, name string")
    for bound in (1000, 0):
        assert entities.extract_entities(df, table, in_row=bound).first().People == ["John Smith Jr."]
    hits = gazetteer.joined_names(df, entities.name_index(table), "doc_id", "text").where("n_words = 3")
    assert sorted(r.pos for r in hits.collect()) == [999, 1998, 150_000]


def test_records_and_long_form(spark):
    long = [(1, "People", 2, "b"), (1, "People", 1, "a"), (1, "Dates", 1, "1920"), (2, "Theaters", 1, "t")]
    df = spark.createDataFrame(long, "doc_id int, category string, ord bigint, entity string")
    records = entities.entity_record(df)
    assert {r.doc_id: r.People for r in records.collect()} == {1: ["a", "b"], 2: []}
    assert rows(entities.unpivot_entities(records)) == sorted(long)
    assert records.columns == ["doc_id", *CATEGORIES]
    assert rows(entities.distinct_requests(df.union(df))) == [("People", "a"), ("People", "b"), ("Theaters", "t")]


def test_explanations(spark):
    df = spark.createDataFrame([(1, "People", 1, "a"), (1, "People", 2, "a"), (1, "Dates", 1, "1920"),
                                (2, "People", 1, "z")],
                               "doc_id int, category string, ord bigint, entity string")
    knowledge = spark.createDataFrame([("People", "a", "A"), ("Dates", "1920", "D")],
                                      "category string, entity string, explanation string")
    explained = entities.explain_entities(df, knowledge)
    assert [(r.doc_id, r.entity, r.explanation) for r in explained.orderBy("doc_id", "ord").collect()] == [
        (1, "a", "A"), (1, "a", "A"), (2, "z", None)]
    repeated = explained.withColumn("explanation", F.concat("explanation", F.col("ord").cast("string")))
    maps = entities.explanation_maps(repeated).collect()
    assert [(m.doc_id, m.People, m.Companies) for m in maps] == [(1, {"a": "A2"}, {})]


# Evaluation

def test_distances_and_counts(spark):
    df = spark.createDataFrame([(1, "kitten\nx\ny", "sitting\nx"), (2, "", ""), (3, "same", "same")],
                               "doc_id int, a string, b string")
    got = {r.doc_id: (r.distance, round(r.similarity, 3)) for r in evaluate.edit_distance(df, "a", "b").collect()}
    assert got == {1: (5, 0.5), 2: (0, 1.0), 3: (0, 1.0)}
    assert rows(evaluate.line_distance(df, "a", "b")) == [(1, 4, 3, 2), (2, 0, 1, 0), (3, 0, 1, 0)]
    assert rows(evaluate.word_counts(df, "a", "b"), "doc_id", "word_delta") == [(1, -1), (2, 0), (3, 0)]


def test_run_consistency_is_brute_force(spark):
    rng = random.Random(2)
    runs = [(d, r, rng.choice(["abc", "abd", "xyz", "a"])) for d in range(6) for r in range(1 + d)]
    got = {r.doc_id: r for r in evaluate.run_consistency(
        spark.createDataFrame(runs, "doc_id int, run int, text string")).collect()}
    by_doc = defaultdict(list)
    for d, _, text in runs:
        by_doc[d].append(text)
    from tests.test_functions import brute_distance
    for d, texts in by_doc.items():
        pairs = [(a, b) for i, a in enumerate(texts) for b in texts[i + 1:]]
        distances = [brute_distance(texts[0], t) for t in texts]
        row = got[d]
        assert (row.n_runs, row.n_variants) == (len(texts), len(set(texts)))
        assert row.identical_share == pytest.approx(
            sum(a == b for a, b in pairs) / len(pairs) if pairs else 1.0)
        assert row.avg_distance == pytest.approx(sum(distances) / len(texts))
        assert row.max_distance == max(distances)


def test_long_runs_of_misread_words_are_aligned():
    for lead, n in (("", 400), ("Some words first ", 90), ("and and ", 300)):
        text = lead + " ".join(["thatword"] * n) + " and" * 151 + " ofthat" * n + " and" * 60 + " withthis" * n
        raw = text.replace("th", "tb").replace(" and ", " and_")
        pairs, left = alignment.word_pairs(raw, text)
        assert left <= 1
        assert dict(pairs)["tbatword"] == "thatword" and ("and_oftbat", "and ofthat") in pairs
        assert [y for x, y in pairs if x == "witbtbis"] == ["withthis"] * (n - (raw.count("_witb")))


def test_only_words_with_several_candidates_ask_for_gains():
    opened = decoding.Looked(decoding._opened({"tbe": [("the", 0.0)], "bere": [("here", -1.0), ("bere", -2.0)], "andof": [("and of", 0.0), ("andof", -1.0)]}))
    assert decoding.wanted_pairs("a tbe cat  \nis tbe bere, andof x tbe", opened) == sorted(
        f"{a}\n{b}" for a, b in [("the", "bere"), ("the", "here"), *itertools.product(("bere", "here"), ("and", "andof")), ("of", "x"), ("andof", "x")])
    assert decoding.decode("Tbe  cat\nis (tbe) bere, andof x", opened, {"the\nbere": 5.0}) == "The  cat\nis (the) bere, and of x"
    few = decoding.Looked(str.upper, most=2)
    assert [few[c] for c in "abcab"] == [*"ABCAB"] and len(few) <= 2


def test_letters_are_learned_from_what_differs(spark, monkeypatch):
    words = ["the", "that", "bath", "thth", "this", "cat"]
    pairs = [(w.replace("th", "tb"), w, k + 1) for k, w in enumerate(words)] + [("the", "the", 4)]
    rows_ = spark.createDataFrame(pairs, "wrong string, right string, n bigint")
    letters = decoding.Letters({})
    for _ in range(2):
        total = Counter()
        for seen, true, n in pairs:
            total[" ", " "] += n
            for op, value in decoding.expected(seen, true, letters).items():
                total[op] += n * value
        letters = decoding.Letters(dict(total))
    got = decoding.learn_letters(rows_, 2)
    assert set(got.counts) == set(total) and all(got.counts[op] == pytest.approx(total[op]) for op in total)


def test_gains_are_those_of_all_neighbours(spark):
    texts = ["the cat and a dog, and the cat - cat\nthe dog", "a cat and the end. The cat", None, ""]
    options = [("andx", "and x", 0.0), ("andx", "andx", -1.0), ("cat", "cat", 0.0), ("cat", "at", -3.0), ("tbe", "the", 0.0)]
    cores = [[decoding._core(t) for t in (x or "").replace("\n", " ").split(" ") if t] for x in texts]
    both = Counter((a, b) for c in cores for a, b in zip(c, c[1:]) if a and b)
    first, second = Counter(), Counter()
    for (a, b), n in both.items():
        first[a] += n
        second[b] += n
    known = {f"{a}\n{b}": math.log1p(0.5 * n / first[a] / (0.5 * second[b] / sum(both.values())))
             for (a, b), n in both.items() if b in ("and", "andx", "cat", "at") or a in ("x", "andx", "cat", "at")}
    got = decoding.gains(spark.createDataFrame([(t,) for t in texts], "corrected string"), spark.createDataFrame(options, "wrong string, right string, score double"))
    got = {r.pair: r.gain for r in got.collect()}
    assert set(got) == set(known) and all(got[p] == pytest.approx(known[p]) for p in known)


def test_runs_of_words_keep_few_tokens(monkeypatch):
    kept = []

    class Few(correct.Looked):
        def __init__(self, value):
            super().__init__(value, most=50)
            kept.append(self)
    monkeypatch.setattr(gazetteer, "Looked", Few)
    texts = [f"Dear W{i}, of the W{i} x" for i in range(1000)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1001)), pa.array(texts)], ["key", "text"])
    everything = SimpleNamespace(value=(np.full(1024 // 64, ~np.uint64(0)),) * 2)
    found = pa.Table.from_batches(gazetteer._runs(everything, 1024)(iter([batch]))).to_pydict()
    assert len(kept) == 2 and all(0 < len(k) <= 50 for k in kept)
    # All bits are set, so every run of words counts.
    assert len(found["phrase"]) == 1000 * 21 and {"w7", "dear w7 of the w7 x"} < {p for k, p in zip(found["_key"], found["phrase"]) if k == 7}

import random

import pytest
from pyspark.sql import functions as F

from scriptorium.functions import files, replies, text
from scriptorium.functions.distance import levenshtein, text_distance


@pytest.mark.parametrize("name,kept", [
    ("a.JPG", True), ("._a.jpg", False), ("_a.png", True), (".h.png", True), ("a.txt", False),
    ("jpg", False), ("a.pdf.txt", False), ("a.tiff", True), ("a.tif\n", False)])
def test_is_supported_file(value, name, kept):
    assert value(files.is_supported_file, name) is kept


@pytest.mark.parametrize("name,base,ext", [
    ("a.tar.gz", "a.tar", ".gz"), ("noext", "noext", ""), (".hidden", ".hidden", ""),
    ("a.", "a", "."), ("a.PDF", "a", ".pdf"), ("..a", "..a", ""), (".a.b", ".a", ".b"), ("", "", "")])
def test_base_name_and_extension(value, name, base, ext):
    assert value(files.base_name, name) == base
    assert value(files.file_ext, name) == ext


@pytest.mark.parametrize("provider,name,action,path", [
    ("aws", "x.pdf", "pass", "in/x.pdf"), ("aws", "x.png", "convert", "tmp/x.pdf"),
    ("azure", "x.png", "resize", "tmp/x_resized.png"), ("azure", "x.JPG", "resize", "tmp/x_resized.jpg"),
    ("azure", "x.pdf", "convert", "tmp/x.pdf")])
def test_route_preparation(spark, provider, name, action, path):
    paths = files.derive_paths(spark.createDataFrame([(name,)], "name string"), source="in", output="out")
    row = files.route_preparation(paths, provider).first()
    assert (row.action, row.prepared_path) == (action, path)
    assert (row.pdf_file, row.s3_pdf_key, row.doc_output_dir) == ("tmp/x.pdf", "x.pdf", "out/x")


def test_unknown_provider(spark):
    with pytest.raises(ValueError):
        files.route_preparation(spark.range(1), "other")


@pytest.mark.parametrize("path,kind", [
    ("tmp/a.pdf", "application/pdf"), ("tmp/a_resized.JPG", "image/jpeg"),
    ("t.x/a", "application/octet-stream"), ("a.bin", "application/octet-stream")])
def test_content_type(value, path, kind):
    assert value(files.content_type, path) == kind


@pytest.mark.parametrize("raw", [
    " \n a  b 　\x1c", "", " \t", "x", " x y ", "\x85a\x85", "​x​"])
def test_py_strip_is_python_strip(value, raw):
    assert value(text.py_strip, raw) == raw.strip()


@pytest.mark.parametrize("line", [
    "12", " 12 ", "+7", "-3", "1_000", "1.5", "1e3", "0x10", "page 3", "", "007", "1__0", "_1", "1_",
    " 5 ", "+ 7", "--1"])
def test_page_number_is_python_int(value, line):
    try:
        expected = int(line.strip())
    except ValueError:
        expected = None
    assert value(text.parse_page_number, line + "\nrest 9") == expected
    assert value(text.parse_page_number, line) == expected


def test_page_number_outside_bigint_is_null(value):
    assert value(text.parse_page_number, "9" * 20) is None


@pytest.mark.parametrize("raw,lines", [
    ("a\nb", ["a", "b"]), ("a\r\nb\rc", ["a", "b", "c"]), ("a\fb", ["a\fb"]), ("", [""]),
    ("a\n\n", ["a", "", ""])])
def test_split_lines(value, raw, lines):
    assert value(text.split_lines, raw) == lines


@pytest.mark.parametrize("raw", ["", " ", "a b", " a\tb\n\nc d ", "x y", "a​b", "one"])
def test_word_count_is_python_split(value, raw):
    assert value(text.word_count, raw) == len(raw.split())


def test_elapsed_and_suffix(spark, value):
    rows = spark.createDataFrame([(0,), (3725,), (360000,), (-1,)], "s bigint")
    assert [r.v for r in rows.select(text.format_elapsed(F.col("s")).alias("v")).collect()] == [
        "0h 0m 0s", "1h 2m 5s", "100h 0m 0s", None]
    assert value(lambda c: text.rewrite_suffix(c, ".a", ".b"), "x.a/y.a") == "x.b/y.b"
    assert value(lambda c: text.run_stamp(c.cast("timestamp")), "2024-03-09 07:05:01") == "03-09-2024_07-05-01"


@pytest.mark.parametrize("reply,valid", [
    ('["a"]', True), ('["a"] note', False), ('"a","b"', False), ('["a"]]', False), ('{"a":1}}', False),
    ("[1,]", False), ("['a']", False), ('```json\n["a"]\n```', False), ("", False), ("null", True),
    ("1", True), (' {"a": [1, {"b": null}]} ', True), ("1] , [2", False), ('1, "w": 2', False)])
def test_strict_json(value, reply, valid):
    assert value(lambda c: replies.strict_json(c).isNotNull(), reply) is valid


FULL = '"Productions":[],"Companies":["c"],"Theaters":[],"Dates":["1920"]'


@pytest.mark.parametrize("reply,status,people", [
    ('{"People":["a","b"],%s}' % FULL, "parsed", ["a", "b"]),
    (' {"People":[],%s,"Extra":{}} ' % FULL, "parsed", []),
    ('{%s}' % FULL, "invalid", None), ('{"People":null,%s}' % FULL, "invalid", None),
    ('{"People":["a",1],%s}' % FULL, "invalid", None), ('{"People":["a",null],%s}' % FULL, "invalid", None),
    ('{"People":"a",%s}' % FULL, "invalid", None), ('["a"]', "invalid", None), ("null", "invalid", None),
    ("sorry", "defaulted", []), ("", "defaulted", [])])
def test_validate_entities(value, reply, status, people):
    record = value(replies.validate_entities, reply)
    assert (record.status, record.People) == (status, people)


@pytest.mark.parametrize("reply,status,letters", [
    ('["a","b"]', "parsed", ["a", "b"]), ("[]", "parsed", []), (' ["é"]\n', "parsed", ["é"]),
    ('{"a":1}', "whole_text", ["T"]), ("null", "whole_text", ["T"]), ("oops", "whole_text", ["T"]),
    ("", "whole_text", ["T"]), ('["a",2]', "failed", None), ('["a",null]', "failed", None)])
def test_parse_letters(value, reply, status, letters):
    record = value(replies.parse_letters, reply, "T")
    assert (record.status, record.letters) == (status, letters)


def test_json_record_keeps_nulls_and_letters(spark):
    row = spark.createDataFrame([("é\n\"", None)], "a string, b string")
    assert row.select(replies.to_json_record("a", "b").alias("v")).first().v == '{"a":"é\\n\\"","b":null}'


def brute_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_distance_is_brute_force(spark):
    rng = random.Random(1)
    pick = lambda n: "".join(rng.choice("abcé \n") for _ in range(rng.randint(0, n)))
    pairs = [(pick(12), pick(12)) for _ in range(1500)] + [(pick(200), pick(200)) for _ in range(30)]
    assert all(levenshtein(a, b) == brute_distance(a, b) for a, b in pairs)
    rows = spark.createDataFrame([*pairs[:50], (None, "a")], "a string, b string")
    got = [r.d for r in rows.select(text_distance(F.col("a"), F.col("b")).alias("d")).collect()]
    assert got == [brute_distance(a, b) for a, b in pairs[:50]] + [None]


def test_distance_of_long_texts_that_are_near_costs_about_their_length():
    import time
    rng = random.Random(11)
    text = "".join(rng.choice("abcdefghijklmnop") for _ in range(300_000))
    places = sorted(rng.sample(range(len(text)), 600))
    more = "".join(text[x:y] + "+" for x, y in zip([0, *places], [*places, len(text)]))
    other = list(text)
    for place in places[:40]:
        other[place] = "-"
    start = time.process_time()
    assert levenshtein(text, more) == 601 and levenshtein("".join(other), text) == 40
    assert time.process_time() - start < 10


@pytest.mark.parametrize("size,edits", [(60, 3), (300, 20), (300, 150), (900, 30)])
def test_distance_of_near_texts_is_that_of_the_matrix(size, edits):
    rng = random.Random(size + edits)
    for _ in range(12):
        a = [rng.choice("abcde") for _ in range(size)]
        b = list(a)
        for _ in range(edits):
            place = rng.randrange(len(b))
            b[place:place + rng.choice([0, 1, 1])] = rng.choice(["", "x", "ab", "c"])
        a, b = "".join(a), "".join(b)
        assert levenshtein(a, b) == brute_distance(a, b) == levenshtein(b, a)

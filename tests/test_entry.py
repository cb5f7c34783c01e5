"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def engine(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def normal(rows, order):
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())
    # What is decoded by learned probabilities has no SQL; test_operators compares it with brute force.
    assert set(entry.queries()) - set(SQL) <= {*entry.LLM_QUERIES, "i1_decode_text"}


def test_entry(spark, sf_dir):
    df = entry.entry(spark)
    assert df.count() > 0 and "status" in df.columns


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, engine, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    result = engine.execute(SQL[name])
    other = [c[0] for c in result.description]
    assert sorted(other) == columns
    expected = normal(result.fetchall(), [other.index(c) for c in columns])
    assert normal(df.select(*columns).collect(), range(len(columns))) == expected
    assert expected


def test_document_distance_is_brute_force_on_short_texts(spark, sf_dir):
    from tests.test_functions import brute_distance
    short = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
             if len(r.text) < 700}
    got = {r.doc_id: r.distance for r in entry.queries()["k1_document_distance"](spark, sf_dir).collect()}
    assert short
    for doc_id, text in short.items():
        assert got[doc_id] == brute_distance(text.replace("th", "tth"), text)

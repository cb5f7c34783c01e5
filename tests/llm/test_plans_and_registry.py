"""What is registered, and what the plans must not hold."""

import re

import corpus_pipeline
import __spark_entry__ as entry
from scriptorium.llm import decontaminate, queries
from tests.llm.test_text_operators import documents


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_operator_is_registered_once():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(names) == set(queries.QUERIES) and entry.queries()["pipeline"] is corpus_pipeline.run
    assert set(queries.ORACLES) <= set(names)
    assert len(corpus_pipeline.STAGES) == 5


def test_url_filter_stays_in_the_engine(spark, sf_dir):
    text = plan(queries.op4_url_filter(spark, sf_dir))
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", text)
    assert "page_id" in text and "html" not in text


def test_no_plan_pairs_everything(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("op2_source_mix", "op3_nearest_neighbours", "op5_warc", "op6_decontamination", "op10_ngram_jaccard_join"):
            text = plan(queries.QUERIES[name](spark, sf_dir))
            assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", text), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_passage_of_all_items_is_listed_once(spark):
    passage = "one two three four five six seven eight nine ten eleven twelve"
    items = spark.createDataFrame([(i, f"{passage} own{i}") for i in range(300)], "item_id bigint, text string")
    docs = documents(spark, [(i, f"x{i} {passage} y{i}") for i in range(20)])
    found = decontaminate.decontaminate(docs, items).collect()
    assert all(r.n_hit == 12 and r.n_items == 300 and r["items"] == sorted(map(str, range(300))) for r in found)

"""Plans that have to hold at scale: what is pushed down, what is shuffled, what is split."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from scriptorium.operators import entities, layout, status
from scriptorium.operators.correct import correct_text
from scriptorium.operators.letters import split_letters
from scriptorium.plans.catalog import QUERIES


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def conf(spark):
    before = {}

    def change(**values):
        for key, value in values.items():
            key = "spark.sql." + key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)
    yield change
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture
def documents(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.range(20).select(F.col("id").alias("doc_id"), F.lit("Dear A\nx y\n\nYours truly,\n").alias("text"),
                           F.lit("unused").alias("other")).write.parquet(path)
    return spark.read.parquet(path)


def test_status_keeps_few_events_per_job_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "e")
    spark.range(100).select((F.col("id") % 3).alias("job_id"), F.col("id").alias("event_id"),
                            F.col("id").alias("ts"), F.lit("SUCCEEDED").alias("status")).write.parquet(path)
    text = plan(status.first_terminal_status(spark.read.parquet(path)))
    tree = text.split("\n\n")[0]
    assert len(re.findall("WindowGroupLimit", tree)) == 2
    assert tree.index("Exchange") < tree.rindex("WindowGroupLimit")
    assert tree.count("Exchange") == 1


def test_letters_need_no_shuffle(documents):
    text = plan(split_letters(documents))
    assert "Exchange" not in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text
    # The array of letters is computed once: no filter on its size next to the explode.
    assert "size(transform" not in text


def test_correction_shuffles_hits_by_document_once(spark, documents, conf):
    conf(autoBroadcastJoinThreshold="-1")
    lexicon = spark.createDataFrame([("x", "z")], "wrong string, right string")
    texts = documents.select("doc_id", "text")
    # A lexicon that fits is looked up inside the row.
    assert "Exchange" not in plan(correct_text(texts, lexicon))
    tree = plan(correct_text(texts, lexicon, in_row=0)).split("\n\n")[0]
    # Two sides of the lookup, the hits by document, and the documents.
    assert tree.count("Exchange") == 4


def test_raw_text_is_one_shuffle(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.range(10).select(F.lit(1).alias("doc_id"), F.lit(1).alias("page"), F.col("id").alias("line_no"),
                           F.lit("t").alias("text")).write.parquet(path)
    tree = plan(layout.assemble_text(spark.read.parquet(path))).split("\n\n")[0]
    assert tree.count("Exchange") == 1


def test_hot_entity_is_split_by_aqe(spark, conf):
    """A third of all mentions name one entity; the lookup of its explanation is split."""
    conf(autoBroadcastJoinThreshold="-1", shuffle__partitions="8",
         adaptive__skewJoin__skewedPartitionThresholdInBytes="20000",
         adaptive__skewJoin__skewedPartitionFactor="2", adaptive__advisoryPartitionSizeInBytes="20000",
         adaptive__coalescePartitions__enabled="false")
    mentions = spark.range(0, 60000, 1, 8).select(
        F.col("id").alias("doc_id"), F.lit("People").alias("category"), F.lit(1).cast("bigint").alias("ord"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), (F.col("id") % 500).cast("string")))
        .alias("entity"))
    knowledge = mentions.select("category", "entity").distinct().withColumn("explanation", F.upper("entity"))
    maps = entities.explanation_maps(entities.explain_entities(mentions, knowledge))
    got = maps.select(F.explode("People").alias("entity", "text")).groupBy("entity").count()
    assert {r.entity: r["count"] for r in got.collect()}["hot"] == 20000
    maps.collect()
    assert "(skew=true)" in maps._jdf.queryExecution().executedPlan().toString()


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_everything_with_everything(spark, sf_dir, conf, name):
    if name.startswith(("j1", "j2", "i5_run", "a1", "a4")):
        pytest.skip("the returned plan only reads what an inner job has written")
    conf(autoBroadcastJoinThreshold="-1")
    text = plan(QUERIES[name](spark, sf_dir))
    assert not [word for word in FORBIDDEN if word in text]


@pytest.mark.parametrize("query", ["a2_read_ocr_pages", "a2_assemble_pages", "a2_incomplete_jobs"])
def test_response_files_stay_near_the_size_of_the_text(spark, sf_dir, query):
    from pathlib import Path
    root = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = set(root.glob("responses-*"))
    QUERIES[query](spark, sf_dir).count()
    new, = set(root.glob("responses-*")) - before
    written = sum(f.stat().st_size for f in new.rglob("part-*"))
    text = spark.read.parquet(f"{sf_dir}/documents.parquet").agg(F.sum(F.octet_length("text"))).first()[0]
    assert written < 4 * text


def test_probes_of_words_are_not_collected_for_a_broadcast(spark):
    from scriptorium.operators.correct import corpus_lexicon
    df = spark.createDataFrame([("these " * 6 + "tbese",)], "text string")
    assert "Broadcast" not in plan(corpus_lexicon(df))
    assert [tuple(r) for r in corpus_lexicon(df).collect()] == [("tbese", "these")]


def test_boxes_are_not_shuffled(spark, sf_dir):
    shown = plan(QUERIES["e2_collect_boxes"](spark, sf_dir))
    assert len(re.findall(r"^\(\d+\) Exchange", shown, re.M)) == 1


def test_requests_stay_in_arrow_until_they_are_sent(spark):
    from scriptorium.operators.model import apply_model
    requests = spark.createDataFrame([("a", "correct_text", None, "x")], "request_id string, task string, system string, user string")
    shown = plan(apply_model(requests, "echo"))
    assert "MapInArrow" in shown and "MapInPandas" not in shown

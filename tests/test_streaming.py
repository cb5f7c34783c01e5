import random

import pytest
from pyspark.sql import functions as F

from scriptorium.operators.status import first_terminal_status
from scriptorium.streaming.incremental import current, incremental_run
from scriptorium.streaming.tracker import track_jobs


def batches(spark, out):
    df = spark.read.parquet(f"{out}/texts")
    return sorted((r.batch_id, r["count"]) for r in df.groupBy("batch_id").count().collect())


def test_incremental_run_takes_each_file_once(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for i in range(7):
        (source / f"f{i}.txt").write_text(f"text {i}")

    def process(batch):
        return {"texts": batch.select(F.col("content").cast("string").alias("text"))}

    def go():
        incremental_run(spark, str(source), out, str(tmp_path / "progress"), process, batch_size=3)

    go()
    assert batches(spark, out) == [(0, 3), (1, 3), (2, 1)]
    go()
    assert batches(spark, out) == [(0, 3), (1, 3), (2, 1)]
    (source / "f9.txt").write_text("text 9")
    go()
    assert batches(spark, out)[-1] == (3, 1)
    assert spark.read.parquet(f"{out}/texts").distinct().count() == 8


SCHEMA = "job_id string, event_id bigint, ts timestamp, status string"


def play(spark, tmp_path, steps, **options):
    """Feed lists of (job, event, second, status) as micro-batches; return outcomes."""
    source = tmp_path / "events"
    for i, step in enumerate(steps):
        rows = spark.createDataFrame(step, "job_id string, event_id bigint, second bigint, status string")
        (rows.select("job_id", "event_id", F.timestamp_seconds(F.col("second") + 1000000).alias("ts"), "status")
         .coalesce(1).write.mode("append").parquet(str(source)))
    stream = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
              .option("latestFirst", "false").parquet(str(source)))
    out = str(tmp_path / "out")
    query = (track_jobs(stream, **options).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", str(tmp_path / "check"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return sorted(map(tuple, spark.read.parquet(out).collect()))


def test_tracker_over_micro_batches(spark, tmp_path):
    wait = "IN_PROGRESS"
    got = play(spark, tmp_path, [
        [("a", 2, 20, "FAILED"), ("a", 1, 10, wait), ("b", 3, 10, wait), ("c", 4, 10, wait)],
        [("a", 5, 30, "SUCCEEDED"), ("b", 6, 30, "SUCCEEDED"), ("c", 7, 30, wait), ("c", 8, 40, wait),
         ("c", 9, 50, "SUCCEEDED")],
    ], max_retries=3, deadline_seconds=None)
    assert got == [("a", "FAILED", 2), ("b", "SUCCEEDED", 2), ("c", "TIMED_OUT", 3)]


def test_tracker_agrees_with_the_batch_operator(spark, tmp_path):
    events = (spark.range(4000).select(
        F.concat(F.lit("j"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.xxhash64("id") % 40)
                 .cast("string")).alias("job_id"),
        F.col("id").alias("event_id"), F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(500))).alias("ts"),
        F.when(F.pmod(F.xxhash64("id"), F.lit(9)) == 0, "SUCCEEDED")
        .when(F.pmod(F.xxhash64("id"), F.lit(9)) == 1, "FAILED").otherwise("IN_PROGRESS").alias("status")))
    source = str(tmp_path / "events")
    events.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    out = str(tmp_path / "out")
    (track_jobs(stream, 4, deadline_seconds=None).writeStream.format("parquet").option("path", out)
     .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
     .awaitTermination())
    batch = first_terminal_status(events, max_retries=4)
    enough = events.groupBy("job_id").count().where("count >= 4").select("job_id")
    expected = sorted(map(tuple, batch.join(enough, "job_id").collect()))
    assert sorted(map(tuple, spark.read.parquet(out).join(enough, "job_id")
                      .select("job_id", "outcome", "polls").collect())) == expected


def test_deadline_ends_silent_jobs(spark, tmp_path):
    wait = "IN_PROGRESS"
    got = play(spark, tmp_path, [
        [("quiet", 1, 0, wait), ("done", 2, 0, "SUCCEEDED")],
        [("other", 3, 1000, wait)],
        [("other", 4, 2000, wait), ("other", 5, 2001, "SUCCEEDED")],
        [("last", 6, 3000, "SUCCEEDED")],
    ], max_retries=5, deadline_seconds=600, watermark="10 seconds")
    assert ("quiet", "TIMED_OUT", 1) in got and ("done", "SUCCEEDED", 1) in got
    assert [g for g in got if g[0] == "done"] == [("done", "SUCCEEDED", 1)]
    # The watermark has not passed the last event: an earlier one might still come.
    assert not [g for g in got if g[0] == "last"]


@pytest.mark.parametrize("cuts", [[], [1], [2], [1, 2], [1, 2, 3]])
def test_outcome_does_not_depend_on_the_micro_batches(spark, tmp_path, cuts):
    wait = "IN_PROGRESS"
    events = [("slow", 1, 0, wait), ("good", 2, 10, wait), ("good", 3, 500, "SUCCEEDED"), ("slow", 4, 720, "SUCCEEDED")]
    steps = [events[a:b] for a, b in zip([0, *cuts], [*cuts, len(events)])]
    steps += [[(name, 9, 100_000, wait)] for name in ("end", "ended")]
    got = [g for g in play(spark, tmp_path, steps, max_retries=5, deadline_seconds=600, watermark="1 hour") if not g[0].startswith("end")]
    assert got == [("good", "SUCCEEDED", 2), ("slow", "TIMED_OUT", 1)]
    rows = spark.createDataFrame(events, "job_id string, event_id bigint, second bigint, status string").withColumn(
        "ts", F.timestamp_seconds("second"))
    batch = first_terminal_status(rows, max_retries=5, deadline_seconds=600)
    assert sorted(map(tuple, batch.collect())) == got


@pytest.mark.parametrize("seed", range(5))
def test_shuffled_events_in_any_micro_batches_give_the_batch_result(spark, tmp_path, seed):
    """The watermark waits for all events, and a last one lets all outcomes out."""
    rng = random.Random(seed)
    kinds = ["IN_PROGRESS"] * 6 + ["SUCCEEDED", "FAILED"]
    events = [(f"j{rng.randrange(12)}", i, rng.randrange(3000), rng.choice(kinds)) for i in range(150)]
    rows = spark.createDataFrame(events, "job_id string, event_id bigint, second bigint, status string").withColumn(
        "ts", F.timestamp_seconds(F.col("second") + 1000000))
    batch = first_terminal_status(rows, max_retries=4, deadline_seconds=900)
    rng.shuffle(events)
    cuts = sorted(rng.sample(range(1, 150), rng.randrange(4)))
    steps = [events[a:b] for a, b in zip([0, *cuts], [*cuts, 150])] + [
        [(name, 999, 100_000, "IN_PROGRESS")] for name in ("end", "ended")]
    got = play(spark, tmp_path, steps, max_retries=4, deadline_seconds=900, watermark="1 hour")
    assert [g for g in got if not g[0].startswith("end")] == sorted(map(tuple, batch.collect()))


def test_last_arrival_counts(spark, tmp_path):
    for batch, rows in enumerate([[("a", 1), ("a", 2), ("b", 1)], [("a", 9)]]):
        spark.createDataFrame(rows, "doc_id string, n int").write.parquet(str(tmp_path / f"t/batch_id={batch}"))
    got = current(spark, str(tmp_path / "t"), "doc_id").collect()
    assert sorted((r.doc_id, r.n) for r in got) == [("a", 9), ("b", 1)]


def test_events_after_the_deadline_are_ignored(spark, tmp_path):
    wait = "IN_PROGRESS"
    got = play(spark, tmp_path, [
        [("slow", 1, 0, wait)], [("other", 2, 700, wait)], [("other", 3, 710, wait)],
        [("slow", 4, 720, "SUCCEEDED")],
    ], max_retries=5, deadline_seconds=600, watermark="10 seconds")
    assert [g for g in got if g[0] == "slow"] == [("slow", "TIMED_OUT", 1)]


def test_jobs_that_share_a_state_end_by_themselves(spark, tmp_path):
    rng = random.Random(9)
    events = [(rng.choice([None, *range(2 ** 60, 2 ** 60 + 30)]), i, rng.randrange(4000), rng.choice(["IN_PROGRESS"] * 5 + ["SUCCEEDED", "FAILED"]))
              for i in range(200)]
    rows = spark.createDataFrame(events, "job_id bigint, event_id bigint, second bigint, status string").withColumn(
        "ts", F.timestamp_seconds(F.col("second") + 1000000)).drop("second")
    batch = first_terminal_status(rows, max_retries=3, deadline_seconds=900)
    source, out = str(tmp_path / "events"), str(tmp_path / "out")
    ends = spark.createDataFrame([(-1, 999)], "job_id bigint, event_id bigint").select(
        "job_id", "event_id", F.timestamp_seconds(F.lit(1100000)).alias("ts"), F.lit("IN_PROGRESS").alias("status"))
    for part in (rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1"), ends, ends):
        part.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    (track_jobs(stream, 3, deadline_seconds=900, watermark="2 hours", buckets=2).writeStream.format("parquet").option("path", out)
     .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination())
    got = spark.read.parquet(out)
    assert got.schema["job_id"].dataType == rows.schema["job_id"].dataType
    order = lambda found: sorted(map(tuple, found), key=str)
    assert order(got.where("job_id is null or job_id > 0").collect()) == order(batch.collect())

"""Job status, duplicates, failures, hand-over between steps and the run summary."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from scriptorium.functions.text import format_elapsed

# Terminal states of a job and the polling limits.
SUCCEEDED, FAILED, TIMED_OUT = "SUCCEEDED", "FAILED", "TIMED_OUT"
MAX_RETRIES, DELAY_SECONDS = 120, 5


def first_polls(events, job, order, max_retries):
    """The first ``max_retries`` events of every job, numbered from 1.

    Spark cuts each map task to that many rows per job before the shuffle (the row-number filter
    becomes a group limit), so a job with very many events stays small in its reducer.
    """
    window = Window.partitionBy(job).orderBy(*order)
    return (events.withColumn("poll_no", F.row_number().over(window))
            .where(F.col("poll_no") <= max_retries))


def first_terminal_status(events, job="job_id", order=("ts", "event_id"),
                          max_retries=MAX_RETRIES, ok=(SUCCEEDED,), bad=(FAILED,), status="status",
                          deadline_seconds=None):
    """Per job the outcome after at most ``max_retries`` polls, and the number of polls made.

    With ``deadline_seconds``, polls later than that after the first one (by the first ``order``
    column) do not count, and a job without an outcome timed out after the polls before them, whether
    more came or not.
    """
    terminal = F.col(status).isin(*ok, *bad)
    polls = first_polls(events.select(job, *order, status), job, order, max_retries)
    if deadline_seconds is not None:
        began = F.min(F.col(order[0])).over(Window.partitionBy(job))
        late = F.col(order[0]) > began + F.make_interval(secs=F.lit(deadline_seconds))
        polls = polls.withColumn("_late", late)
        polls_made = F.count_if(~F.col("_late"))
        terminal = terminal & ~F.col("_late")
    else:
        polls_made = F.lit(max_retries)
    first = F.min(F.when(terminal, F.col("poll_no")))
    outcome = F.min_by(F.when(F.col(status).isin(*ok), SUCCEEDED).otherwise(FAILED),
                       F.when(terminal, F.col("poll_no")))
    # min_by skips rows whose ordering value is NULL, so it is NULL without a terminal poll.
    return polls.groupBy(job).agg(
        F.coalesce(outcome, F.lit(TIMED_OUT)).alias("outcome"),
        F.coalesce(first, polls_made).cast("bigint").alias("polls"))


def failed_documents(statuses, ok=(SUCCEEDED,), status="outcome"):
    """Rows that must not go on to the next step, with the reason in words.

    A ``reason`` that the rows bring along stays. An outcome that is NULL is not a success.
    """
    reason = F.when(F.col(status) == TIMED_OUT, "timeout").otherwise("job_failed")
    if "reason" in statuses.columns:
        reason = F.coalesce("reason", reason)
    return statuses.where(~F.coalesce(F.col(status).isin(*ok), F.lit(False))).withColumn("reason", reason)


def last_wins(df, key, order):
    """Per key the row with the greatest ``order`` columns (partial aggregation, no window)."""
    others = [c for c in df.columns if c != key]
    rank = F.struct(*order)
    best = F.max_by(F.struct(*others), rank)
    return df.groupBy(key).agg(best.alias("_row")).select(key, "_row.*")


def superseded(df, key, order):
    """Rows that lost against another row with the same key.

    ``order`` has to identify a row. The winners are taken out by that identity, so a key that
    most rows share does not gather in one task.
    """
    return df.join(last_wins(df, key, order).select(*order), list(order), "left_anti")


def handoff(jobs, prepared, key="base_name"):
    """Submitted jobs together with their prepared rows; both sides have one row per key."""
    return prepared.join(jobs, key)


def not_handed_over(prepared, jobs, key="base_name"):
    return prepared.join(jobs.select(key), key, "left_anti")


def run_summary(doc_status, batch_size, started="started", finished="finished", status="status"):
    """One row: files, batches, outcome counts and elapsed time of a run."""
    seconds = F.max(F.unix_seconds(F.col(finished).cast("timestamp"))) - F.min(
        F.unix_seconds(F.col(started).cast("timestamp")))
    counted = doc_status.agg(
        F.count("*").alias("n_files"),
        F.count_if(F.col(status) == SUCCEEDED).alias("n_success"),
        F.count_if(F.col(status) != SUCCEEDED).alias("n_failed"),
        seconds.alias("elapsed_seconds"))
    return counted.select(
        "n_files",
        F.ceil(F.col("n_files") / F.lit(batch_size)).cast("bigint").alias("n_batches"),
        F.lit(batch_size).cast("bigint").alias("batch_size"),
        "n_success", "n_failed",
        format_elapsed(F.col("elapsed_seconds")).alias("elapsed"))

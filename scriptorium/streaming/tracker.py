"""First terminal status of jobs over a live stream of status events."""

from __future__ import annotations

import heapq
from itertools import islice

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from scriptorium.operators.status import (
    DELAY_SECONDS, FAILED, MAX_RETRIES, SUCCEEDED, TIMED_OUT)

_ORDER = ["at", "event_id"]
# Jobs are dealt out to so many states; a state costs about as much to call as some hundred jobs in it.
BUCKETS = 1 << 13


def outcome_of(polls, max_retries, deadline=None):
    """(outcome or None, polls made, time that decides it) of polls (time, event_id, status) in order.

    ``None`` as outcome means that these polls end nothing; the time is then that of the deadline, if there is one.
    """
    seen, ends = 0, polls[0][0] + deadline if polls and deadline is not None else None
    for at, _, status in polls:
        if ends is not None and at > ends:
            return TIMED_OUT, seen, ends
        seen += 1
        if status in (SUCCEEDED, FAILED):
            return status, seen, at
        if seen == max_retries:
            return TIMED_OUT, seen, at
    return None, seen, ends


def track_jobs(stream, max_retries=MAX_RETRIES, deadline_seconds=MAX_RETRIES * DELAY_SECONDS,
               watermark="10 minutes", buckets=BUCKETS):
    """Stream of (job_id, outcome, polls) from a stream of (job_id, event_id, ts, status).

    A job ends at its first terminal status, after ``max_retries`` polls, or ``deadline_seconds`` of event
    time after its first poll. Its first polls are kept in state in the order of (ts, event_id), and an outcome
    is given when the watermark has passed the event or the deadline that decides it: no earlier event can
    come any more. So it does not depend on how events fall into micro-batches, or on
    their order, as long as none comes later than ``watermark`` allows. At most ``max_retries`` polls of a job are kept, and
    an ended job is remembered for one more deadline. Jobs share ``buckets`` states, for a call of a state costs far more than a job;
    a micro-batch writes at most all that is kept anew.

    With ``deadline_seconds=None`` there is no event time to wait for: an outcome is given as soon as the polls that
    have come decide it, events count as they come, and ended jobs are remembered for good.
    """
    # As strings, for pandas would make numbers beside a null job floats.
    events = stream.select(F.col("job_id").cast("string").alias("job"), "event_id", F.col("ts").cast("timestamp").alias("ts"),
                           F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), "status")
    timed = deadline_seconds is not None
    deadline = deadline_seconds * 1_000_000 if timed else None

    def first_of_each_job(batches):
        # Whatever is not among the first polls of its own Arrow batch cannot be among the
        # first of its job: a job with very many events shrinks here, before the shuffle.
        for batch in batches:
            yield batch.sort_values(_ORDER).groupby("job", sort=False, dropna=False).head(max_retries)

    def polls_of(batch):
        return zip(batch["job"].tolist(), batch["at"].tolist(), batch["event_id"].tolist(), batch["status"].tolist())

    def follow(key, batches, state):
        polls, ended = {}, {}
        if state.exists:
            jobs, ends, sizes, *parts = state.get
            kept = zip(*parts)
            for job, end, size in zip(jobs, ends, sizes):
                if end is None:
                    polls[job] = list(islice(kept, size))
                else:
                    ended[job] = end
        for batch in () if state.hasTimedOut else batches:
            for job, *poll in polls_of(batch):
                if job not in ended:
                    polls.setdefault(job, []).append(tuple(poll))
        passed, out, next_call = state.getCurrentWatermarkMs() * 1000, [], []
        for job, own in list(polls.items()):
            own = polls[job] = heapq.nsmallest(max_retries, own, key=lambda p: p[:2])
            outcome, made, decides = outcome_of(own, max_retries, deadline)
            if passed > decides:
                out.append((job, outcome or TIMED_OUT, made))
                # It is remembered for one more deadline, then forgotten.
                ended[job] = max(own[0][0] + deadline, passed) + deadline
                del polls[job]
            else:
                next_call.append(decides)
        ended = {job: end for job, end in ended.items() if end >= passed}
        next_call += ended.values()
        if next_call:
            kept = [p for own in polls.values() for p in own]
            state.update(([*polls, *ended], [*(None for _ in polls), *ended.values()], [*map(len, polls.values()), *(0 for _ in ended)],
                          [p[0] for p in kept], [p[1] for p in kept], [p[2] for p in kept]))
            state.setTimeoutTimestamp(max(min(next_call), passed) // 1000 + 1)
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=["job", "outcome", "polls"])

    def follow_one(key, batches, state):
        seen, done = state.get if state.exists else (0, False)
        if done:
            for _ in batches:
                pass
            return
        polls = []
        for batch in batches:
            polls = heapq.nsmallest(max_retries - seen, [*polls, *(tuple(p) for _, *p in polls_of(batch))], key=lambda p: p[:2])
        outcome, made, _ = outcome_of(polls, max_retries - seen)
        state.update((seen + made, outcome is not None))
        if outcome is not None:
            yield pd.DataFrame({"job": [key[0]], "outcome": [outcome], "polls": [seen + made]})

    first, result = events.mapInPandas(first_of_each_job, events.schema), "job string, outcome string, polls bigint"
    if timed:
        first = first.withColumn("bucket", F.pmod(F.xxhash64("job"), F.lit(buckets))).withWatermark("ts", watermark)
        found = first.groupBy("bucket").applyInPandasWithState(
            follow, result, "jobs array<string>, ends array<bigint>, sizes array<int>, times array<bigint>, ids array<bigint>, "
            "statuses array<string>", "append", GroupStateTimeout.EventTimeTimeout)
    else:
        found = first.groupBy("job").applyInPandasWithState(
            follow_one, result, "seen int, done boolean", "append", GroupStateTimeout.NoTimeout)
    return found.select(F.col("job").cast(stream.schema["job_id"].dataType).alias("job_id"), "outcome", "polls")

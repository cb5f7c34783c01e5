"""Prompts, requests and replies of a text model, and its distributed application."""

from __future__ import annotations

import queue
import random
import threading
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import functions as F

from scriptorium.session import cut_lineage, read_or_empty
from scriptorium.sources.listing import opened, qualified

# Task names, request layouts and the texts around a document.
TASKS = ("correct_text", "extract_entities", "explain_entities", "split_letters")
LAYOUTS = ("system_and_user", "single_user")
ALWAYS_SINGLE = ("split_letters",)
TEXT_HEADER = "\nText:\n"
ENTITY_FORMAT = "Category: %s\nEntity: %s"

# Replies that are written to a store at a time.
STORE_ROWS = 64

RESPONSE_SCHEMA = "request_id string, response string, error string, attempt int"

_BACKENDS = {}


def register_backend(name, factory):
    """Make a back end known by name.

    ``factory()`` runs once per task and returns ``call(task, system, user) -> str``.
    """
    _BACKENDS[name] = factory


def echo_backend():
    """Reply with the user text, stripped as a model reply would be."""
    return lambda task, system, user: user.strip()


register_backend("echo", echo_backend)


def attach_prompt(df, prompts):
    """Add the prompt of every row's task.

    Of several prompts of a task the greatest one counts, so reruns agree; a task that rows name and
    that has no prompt is an error, not a missing row. The catalog is one row per task of the fixed
    set, which bounds the broadcast.
    """
    catalog = prompts.where(F.col("task").isin(*TASKS) & F.col("prompt").isNotNull()).groupBy(
        "task").agg(F.max("prompt").alias("prompt"))
    joined = df.join(F.broadcast(catalog), "task", "left")
    missing = F.raise_error(F.concat(F.lit("no prompt for task "), F.coalesce("task", F.lit("null")))).cast("string")
    return joined.withColumn("prompt", F.coalesce("prompt", missing))


def entity_text(category, entity):
    return F.format_string(ENTITY_FORMAT, category, entity)


def render_prompt(df, layout="system_and_user", model="echo"):
    """Rows (task, prompt, text) to requests with ``system``, ``user`` and ``request_id``.

    ``system_and_user`` sends the prompt as system message; ``single_user`` puts prompt and text
    into one message. Splitting always uses one message. The id is a digest of the request, so
    equal requests share one reply.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"unknown layout: {layout}")
    single = F.lit(layout == "single_user") | F.col("task").isin(*ALWAYS_SINGLE)
    header = F.when(F.col("task") == "explain_entities", "\n").otherwise(TEXT_HEADER)
    return df.withColumns({
        "model": F.lit(model),
        "system": F.when(~single, F.col("prompt")),
        "user": F.when(single, F.concat("prompt", header, "text")).otherwise(F.col("text")),
    }).withColumn(
        "request_id", F.sha2(F.concat_ws("\u0001", "model", "task", "system", "user"), 256))


def _once(requests):
    """Every request once. Only ids are counted over a shuffle; prompts and texts move for those
    that do occur several times, and for no other as long as the repeated ids are few."""
    repeated = cut_lineage(requests.groupBy("request_id").count().where("count > 1").select("request_id"), "repeated")
    single = requests.join(repeated, "request_id", "left_anti")
    return single.unionByName(
        requests.join(repeated, "request_id", "left_semi").dropDuplicates(["request_id"]))


def within(seconds, call, *arguments):
    """The result of a call, or ``TimeoutError`` when it takes longer; what still hangs is left behind."""
    if seconds is None:
        return call(*arguments)
    box = queue.SimpleQueue()

    def work():
        try:
            box.put((call(*arguments), None))
        except BaseException as failure:  # handed on to the caller
            box.put((None, failure))
    threading.Thread(target=work, daemon=True).start()
    try:
        result, failure = box.get(timeout=seconds)
    except queue.Empty:
        raise TimeoutError(f"no reply within {seconds} s") from None
    if failure is not None:
        raise failure
    return result


class Pace:
    """Lets calls begin at most ``rate`` times a second, for the threads of one task together."""

    def __init__(self, rate, clock=time.monotonic, sleep=time.sleep):
        self.step, self.next, self.lock = 1.0 / rate, 0.0, threading.Lock()
        self.clock, self.sleep = clock, sleep

    def wait(self):
        with self.lock:
            now = self.clock()
            at = max(now, self.next)
            self.next = at + self.step
        if at > now:
            self.sleep(at - now)


def send(call, request, attempts=1, timeout=None, backoff=0.0, pace=None, sleep=time.sleep):
    """(response, error, attempt) of a request (task, system, user).

    A call that raises or takes longer than ``timeout`` seconds is repeated up to ``attempts`` times, after a pause of
    ``backoff`` seconds that doubles each time (a minute at most), of which a random half is left out.
    """
    error = None
    for attempt in range(1, attempts + 1):
        if pace is not None:
            pace.wait()
        try:
            return within(timeout, call, *request), None, attempt
        except Exception as failure:  # one row must not fail the task
            error = f"{type(failure).__name__}: {failure}"
        if attempt < attempts and backoff:
            sleep(min(60.0, backoff * 2 ** (attempt - 1)) * random.uniform(0.5, 1.0))
    return None, error, attempts


def stored_replies(spark, store):
    """Replies that earlier runs have left in ``store``, one per request; errors are none."""
    replies = read_or_empty(spark, store, RESPONSE_SCHEMA).where(F.col("error").isNull() & F.col("request_id").isNotNull())
    return replies.groupBy("request_id").agg(F.max_by(F.struct("response", "error", "attempt"), "response").alias("_r")).select(
        "request_id", "_r.*")


def _keep(store, prefix, number, rows):
    """Write replies as a file of their own, at once, so that they outlast the run."""
    import pyarrow.parquet as pq
    files, root = opened(store)
    files.create_dir(root, recursive=True)
    table = pa.table({name: pa.array([r[i] for r in rows], pa.int32() if name == "attempt" else pa.string())
                      for i, name in enumerate(("request_id", "response", "error", "attempt"))})
    temporary = f"{root}/.{prefix}-{number}-{uuid.uuid4().hex}"
    with files.open_output_stream(temporary, compression=None) as stream:
        pq.write_table(table, stream)
    files.move(temporary, f"{root}/{prefix}-{number}-{uuid.uuid4().hex}.parquet")


def _kept(store, prefix):
    """Replies that an earlier attempt of this task has left."""
    import pyarrow.parquet as pq
    from pyarrow import fs
    files, root = opened(store)
    found = {}
    for info in files.get_file_info(fs.FileSelector(root, allow_not_found=True)):
        if info.base_name.startswith(prefix + "-"):
            for row in pq.read_table(info.path, filesystem=files).to_pylist():
                if row["error"] is None:
                    found[row["request_id"]] = (row["response"], None, row["attempt"])
    return found


def apply_model(requests, backend, parallelism=None, attempts=1, known=None, threads=1, timeout=None, backoff=0.0,
                rate=None, store=None):
    """Send every distinct request once: rows (request_id, response, error, attempt).

    ``backend`` is a registered name or a factory. A failed call is data: ``response`` is NULL and
    ``error`` says why, also for a call that gives no reply within ``timeout`` seconds (:func:`send` for it and for
    ``attempts`` and ``backoff``). ``parallelism`` fixes the number of tasks that call the model, and
    ``threads`` how many calls each of them waits for at a time; ``rate`` is how many calls a second may
    begin in all tasks together, of which each task that can run has an equal share. Requests whose reply is in
    ``known`` are not sent again. With a ``store``, a folder that all executors share, every ``STORE_ROWS`` replies are
    written there as they come: neither a later run nor a repeated task sends those again, even if this run fails.
    Rows stream through in Arrow batches.
    """
    spark = requests.sparkSession
    factory = _BACKENDS[backend] if isinstance(backend, str) else backend
    todo = _once(requests.select("request_id", "task", "system", "user"))
    if store is not None:
        store = qualified(spark, store)
        known = stored_replies(spark, store) if known is None else known.select("request_id", "response", "error").unionByName(
            stored_replies(spark, store).select("request_id", "response", "error"))
    if known is not None:
        todo = todo.join(known.where(F.col("error").isNull()).select("request_id"),
                         "request_id", "left_anti")
    if rate and not parallelism:
        parallelism = spark.sparkContext.defaultParallelism
    if parallelism:
        todo = todo.repartition(parallelism)
    share = rate / min(parallelism, spark.sparkContext.defaultParallelism) if rate else None
    run = uuid.uuid4().hex

    def answer(batches):
        from pyspark import TaskContext
        call, pace, number = factory(), Pace(share) if share else None, 0
        context = TaskContext.get()
        prefix = f"{run}-{context.partitionId()}"
        done = _kept(store, prefix) if store is not None and context.attemptNumber() > 0 else {}
        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                # Only so many texts at a time are Python's own; the rest of a batch stays in Arrow.
                for start in range(0, batch.num_rows, STORE_ROWS):
                    part = list(zip(*(column.to_pylist() for column in batch.slice(start, STORE_ROWS).columns)))
                    new = [r for r in part if r[0] not in done]
                    sent = dict(zip((r[0] for r in new), pool.map(
                        lambda r: send(call, r[1:], attempts, timeout, backoff, pace), new)))
                    if store is not None and sent:
                        _keep(store, prefix, number, [(k, *v) for k, v in sent.items()])
                        number += 1
                    replies = [(r[0], *(sent[r[0]] if r[0] in sent else done[r[0]])) for r in part]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[i] for r in replies], pa.int32() if i == 3 else pa.string()) for i in range(4)],
                        ["request_id", "response", "error", "attempt"])

    return todo.select("request_id", "task", "system", "user").mapInArrow(answer, RESPONSE_SCHEMA)


def attach_responses(requests, responses):
    """Requests with their reply; a request without one gets an error."""
    joined = requests.join(responses.select("request_id", "response", "error"),
                           "request_id", "left")
    missing = F.col("response").isNull() & F.col("error").isNull()
    return joined.withColumn("error", F.when(missing, "no response").otherwise(F.col("error")))

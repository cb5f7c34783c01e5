"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Settings that matter for the operators of this package at any scale: AQE merges small
# shuffle partitions, splits skewed join partitions, and turns sort-merge joins into
# broadcast joins only after it has seen the real size of a side.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name="scriptorium", master=None, conf=None):
    """Get or create a session with the package settings; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark, label):
    """A new, unused folder path below the checkpoint folder of the session.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local session without the
    setting gets a folder of its own; on a cluster a machine-local folder would be lost with
    its machine, so a missing setting is an error there.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if context.master != "local" and not context.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            configured = tempfile.mkdtemp(prefix="scriptorium-")
        context.setCheckpointDir(configured)
    return f"{context.getCheckpointDir()}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df, label="cut"):
    """Materialise ``df`` as a table in the work folder and return a scan of it.

    The copy survives the loss of executors, and every reader sees the same rows.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_or_empty(spark, path, schema):
    """A table that a run has written, or an empty one."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)

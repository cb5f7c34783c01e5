"""Consecutive numbers over a whole table, without a one-task window."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from scriptorium.session import cut_lineage

# monotonically_increasing_id: partition number above, row number in the partition below.
_ROW_BITS = 33


def global_row_number(df, order, alias="row_no"):
    """Number the rows 0, 1, 2, ... in the order of the given columns.

    Rows are range-partitioned and sorted, and the partition and position of each are written
    out once, so that a retried task cannot see other range bounds. The only table kept whole is
    the one of the partition sizes, one row per partition. ``order`` should be unique: then a
    name that holds a third of all rows still spreads over many ranges.
    """
    placed = cut_lineage(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()),
        "numbered",
    ).withColumn("_part", F.shiftright("_place", _ROW_BITS))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    within = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (placed.join(F.broadcast(offsets), "_part")
            .withColumn(alias, F.col("_offset") + within)
            .drop("_place", "_part", "_offset"))


def assign_batches(df, size, order):
    """Consecutive batches of ``size`` rows in the given order; the last one may be short."""
    return (global_row_number(df, order, "_row_no")
            .withColumn("batch_id", F.floor(F.col("_row_no") / F.lit(size)).cast("bigint"))
            .drop("_row_no"))

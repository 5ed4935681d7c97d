"""Running totals and row numbers over a whole table without a one-task window.

The rows are cut into slices that follow the ordering.  A partial aggregate gives
each slice's total (one small row per slice), a running sum over those rows gives
each slice's offset, and the fine-grained window runs inside a slice.  Large keys
are spread over as many tasks as they have slices, and slices are fixed by a written table
or by the key itself, so a recomputed task always yields the same numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.sources.tables import merged


def cut_by_range(df: DataFrame, *order_by: str) -> DataFrame:
    """Add ``_slice``: the number of the range the row's key falls into.

    Spark samples the bounds, so slices are even whatever the keys look like, and adaptive
    execution merges small neighbours.  Another run may choose other bounds: write the
    result once and build both the totals and the ranks on the written table.
    """
    return df.repartitionByRange(*order_by).withColumn("_slice", F.spark_partition_id().cast("bigint"))


def running_total_before(
    df: DataFrame,
    order_by: list[str],
    slice_col: Column,
    value: Column,
    out: str,
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows ordered strictly before this one.

    ``slice_col`` must not decrease along ``order_by`` and ``order_by`` must be unique.
    """
    sliced = df.withColumn("_slice", slice_col).withColumn("_value", value.cast("bigint"))
    totals = sliced.groupBy("_slice").agg(F.sum("_value").alias("_slice_total"))
    # One row per slice, so this ordered window is small whatever the table's size.
    offsets = totals.select(
        "_slice",
        (F.sum("_slice_total").over(W.orderBy("_slice").rowsBetween(W.unboundedPreceding, 0))
         - F.col("_slice_total")).alias("_offset"),
    )
    inside = W.partitionBy("_slice").orderBy(*order_by).rowsBetween(W.unboundedPreceding, 0)
    return (
        sliced.join(offsets, "_slice", "left")  # every slice has its row; left adds no null filter
        .withColumn(out, F.col("_offset") + F.sum("_value").over(inside) - F.col("_value"))
        .drop("_slice", "_value", "_offset")
    )


def global_row_number(df: DataFrame, order_by: str, out: str) -> DataFrame:
    """1-based position along a unique key; ``df`` was cut by range and written."""
    ranked = running_total_before(df, [order_by], F.col("_slice"), F.lit(1), "_before")
    return ranked.withColumn(out, F.col("_before") + 1).drop("_before")


def keyed_sequence(
    df: DataFrame, key: str, order_by: list[str], slice_col: Column, time_col: str
) -> DataFrame:
    """Per-key sequence number, group size and previous time, for keys of any size.

    A key is cut into slices along ``order_by`` (ranges written by ``cut_by_range``, say), so
    one key holding a large share of the rows is numbered by many tasks.  Adds ``seq``, ``seq_length`` and
    ``previous_time``.
    """
    sliced = df.withColumn("_slice", slice_col)
    slices = sliced.groupBy(key, "_slice").agg(
        F.count("*").alias("_n"), F.max(time_col).alias("_last_time")
    )
    along = W.partitionBy(key).orderBy("_slice")
    spans = slices.select(
        key,
        "_slice",
        (F.sum("_n").over(along.rowsBetween(W.unboundedPreceding, 0)) - F.col("_n")).alias("_before"),
        F.sum("_n").over(W.partitionBy(key)).alias("seq_length"),
        F.lag("_last_time").over(along).alias("_time_before"),
    )
    inside = W.partitionBy(key, "_slice").orderBy(*order_by)
    return (
        sliced.join(merged(spans), [key, "_slice"], "left")
        .withColumn("seq", F.col("_before") + F.row_number().over(inside))
        .withColumn(
            "previous_time", F.coalesce(F.lag(time_col).over(inside), F.col("_time_before"))
        )
        .drop("_slice", "_before", "_time_before")
    )

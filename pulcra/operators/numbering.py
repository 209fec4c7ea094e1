"""Consecutive numbers in a global order, without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulcra.operators.lookup import materialize


def number_rows(df: DataFrame, order_by: list[str], name: str, start: int = 1) -> DataFrame:
    """Add ``name`` = start, start+1, ... following ``order_by``, which must be unique.

    The range-partitioned sort is written once, so that a row's partition and its place in it
    never change between the two reads; the partitions' offsets are one row per partition.
    """
    place = F.monotonically_increasing_id()
    ordered = materialize(
        df.orderBy(*order_by).select(
            "*", F.shiftright(place, 33).alias("_part"), (place % (1 << 33)).alias("_place")
        )
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        ordered.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_place") + start)
        .drop("_part", "_place", "_offset")
    )

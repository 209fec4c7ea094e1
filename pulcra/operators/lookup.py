"""Written intermediate tables and joins from many rows to one row per key."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Collection, Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulcra.config import JoinLimits

# Room that one broadcast row takes beside its values.
_ROW_BYTES = 96
# Keys fall into so many buckets, each with one number of slots: that table is bounded by this and
# not by the data, whatever the number of hot keys.
BUCKETS = 1 << 16
_SPREAD = 1 << 20
_GRAIN = 4
_scope: ContextVar[str] = ContextVar("work_tables", default="kept")


def work_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables that every executor and a restarted stage can read.

    It lies below ``spark.checkpoint.dir``. A folder of this machine is made up only where driver and
    executors are one process, and no folder is named.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if base is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="pulcra-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/pulcra-{context.applicationId}/{_scope.get()}"


def materialize(df: DataFrame) -> DataFrame:
    """Write a table once and read it back.

    Cuts lineage, survives lost executors, and gives the optimizer the real size of the result.
    """
    path = f"{work_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_observed(
    df: DataFrame,
    measures: Mapping[str, Column],
    *,
    path: str | None = None,
    by: str | None = None,
    drop: Collection[str] = (),
) -> tuple[DataFrame, dict[str, Any]]:
    """Write a table as :func:`materialize` does, and take aggregates of its rows in the same pass.

    The aggregates belong to the writing stage, whose partitions count once however often a task is
    tried, so they hold for the rows that the table has. ``by`` partitions the files by a column;
    filters on it then skip the other folders. Columns to ``drop`` are there for the aggregates and
    not written.
    """
    seen = Observation()
    observed = df.observe(seen, *[value.alias(name) for name, value in measures.items()]).drop(*drop)
    df = df.drop(*drop)
    path = path or f"{work_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    writer = observed.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns), seen.get


@contextmanager
def work_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables made inside the block when it ends.

    Results must be written within the block; frames that still read those tables are unusable
    afterwards. Tables made elsewhere are not touched.
    """
    token = _scope.set(uuid.uuid4().hex)
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(work_folder(spark))
    try:
        yield
    finally:
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
        _scope.reset(token)


def _value_size(name: str, kind: T.DataType) -> Column:
    """Bytes of a value, about; texts and arrays by what they hold."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(name), F.lit(0))
    if isinstance(kind, (T.ArrayType, T.MapType)):
        fixed = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType)
        return F.greatest(F.size(name), F.lit(0)) * (8 if fixed else 32)
    return F.lit(16)


def _row_size(schema: T.StructType) -> Column:
    size = F.lit(_ROW_BYTES)
    for field in schema.fields:
        size += _value_size(field.name, field.dataType)
    return size.cast("long")


def size_measure(schema: T.StructType) -> Column:
    """Aggregate of the bytes that a table would take on every executor."""
    return F.coalesce(F.sum(_row_size(schema)), F.lit(0))


def broadcast_size(table: DataFrame) -> int:
    """Bytes that a written table would take on every executor."""
    return table.agg(size_measure(table.schema)).first()[0]


def write_sized(df: DataFrame) -> tuple[DataFrame, int]:
    """Write a table as :func:`materialize` does; with what it would take to broadcast it."""
    table, seen = write_observed(df, {"bytes": size_measure(df.schema)})
    return table, seen["bytes"]


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def hot_buckets(table: DataFrame, weight: str, limits: JoinLimits) -> DataFrame:
    """``_bucket, _slots`` of the buckets with a hot key: some slots for every ``limits.hot_rows``
    rows of its heaviest key, so that they even out over tasks. At most ``BUCKETS`` rows of two
    integers."""
    slots = F.ceil(F.max(weight) * _GRAIN / limits.hot_rows).cast("int")
    heavy = table.where(F.col(weight) > limits.hot_rows)
    return heavy.groupBy(_bucket(F.col("_key")).alias("_bucket")).agg(slots.alias("_slots"))


def slot_join(rows: DataFrame, table: DataFrame, weight: str, row_id: Column, limits: JoinLimits) -> DataFrame:
    """Left join of ``rows`` and ``table`` on ``_key`` through a shuffle in which no key is hot.

    Lookup rows of a bucket with a hot key are copied to several slots, and the rows of that bucket
    are dealt over those by their row id; every other bucket has one slot. A row meets exactly one
    copy. Rows without a key match nothing and are dealt over a wide range of slots.
    """
    hot = F.broadcast(materialize(hot_buckets(table, weight, limits)))
    slots = F.coalesce("_slots", F.lit(1))
    copies = F.explode(F.sequence(F.lit(0), slots - 1)).alias("_slot")
    payload = [c for c in table.columns if c not in ("_key", weight)]
    copied = table.withColumn("_bucket", _bucket(F.col("_key"))).join(hot, "_bucket", "left").select("_key", copies, *payload)
    wide = F.when(F.col("_key").isNull(), F.lit(_SPREAD)).otherwise(slots)
    dealt = rows.withColumn("_bucket", _bucket(F.col("_key"))).join(hot, "_bucket", "left")
    dealt = dealt.withColumn("_slot", F.pmod(F.xxhash64(row_id), wide).cast("int")).drop("_bucket", "_slots")
    # Named, so that the planner does not take a shuffle for a broadcast on its own estimate.
    return dealt.join(copied.hint("merge"), ["_key", "_slot"], "left").drop("_key", "_slot")


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    *,
    key: Column,
    lookup_key: str,
    weight: str,
    row_id: Column,
    limits: JoinLimits = JoinLimits(),
    size: int | None = None,
) -> DataFrame:
    """Left join of ``rows`` to ``lookup``, which has one row per key.

    ``weight`` names the lookup column that tells how many of ``rows`` carry the key; it and the
    key are dropped from the result. ``lookup`` is written first, so that its size is known; a
    written table comes with its ``size``, as :func:`write_sized` tells it. Up to ``limits.broadcast_bytes`` it is
    broadcast and ``rows`` are not shuffled at all. Beyond, both sides are shuffled by key and slot,
    see :func:`slot_join`; nothing is broadcast there that grows with the data.
    """
    table, size = write_sized(lookup) if size is None else (lookup, size)
    table = table.withColumnRenamed(lookup_key, "_key")
    keyed = rows.withColumn("_key", key.cast(table.schema["_key"].dataType))
    if size <= limits.broadcast_bytes:
        return keyed.join(F.broadcast(table.drop(weight)), "_key", "left").drop("_key")
    payload = [c for c in table.columns if c not in ("_key", weight)]
    return slot_join(keyed, table, weight, row_id, limits).select(*rows.columns, *payload)

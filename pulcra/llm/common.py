"""What several operators share: text units, held-out folds, set tests by id, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulcra.config import JoinLimits
from pulcra.operators.lookup import materialize

# A word as the result contracts define it, for Java's patterns and for Python's.
WORD = r"[^\x20\x09-\x0D]+"
ID_BYTES = 96  # of one id in a broadcast hash table
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_small_batches(docs: DataFrame) -> DataFrame:
    """The same rows; their session then hands whole texts to Python in batches of a few megabytes
    instead of ten thousand rows. A longer text is a batch of its own."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return docs


def n_words(text: Column) -> Column:
    """Words of a text; none of a null one."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether the unsigned crc32 of the id as text falls into a fold; a null id is in none."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def texts_of(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in batches:
        yield batch, batch.column(batch.schema.get_field_index(column)).to_pylist()


def without(rows: DataFrame, key: Column, keys: DataFrame, limits: JoinLimits = JoinLimits()) -> DataFrame:
    """Rows whose key is not in ``keys`` (one column); null keys count as equal.

    ``keys`` is written first: up to ``limits.broadcast_bytes`` it is broadcast and the rows stay
    where they are, beyond that both sides are shuffled.
    """
    own, gone = (f"{name}_{uuid.uuid4().hex}" for name in ("key", "gone"))  # no name of the rows'
    known = materialize(keys.toDF(gone).distinct())
    small = known.count() * ID_BYTES <= limits.broadcast_bytes
    known = F.broadcast(known) if small else known.hint("merge")
    return rows.withColumn(own, key).join(known, F.col(own).eqNullSafe(F.col(gone)), "left_anti").drop(own)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of long nodes: (node, root), root the smallest node; nodes without an
    edge are absent.

    Rounds of large stars and small stars. Every round leaves at most as many edges as there were
    and is written to the shared folder; minima are combined before they are shuffled, so a node
    with very many edges does not meet them all in one task.
    """
    u, v = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    state = materialize(edges.select(u, v).where("u != v").distinct())
    before = None
    while (now := _digest(state)) != before:
        before = now
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Both joins keep the rows apart that share a node: skewed partitions can be split.
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct())
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        state = materialize(small.toDF("u", "v").unionByName(moved).distinct())
    return state.toDF("node", "root")


def _digest(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(mixed), F.sum(mixed % 1_000_003)).first())

"""Exact sets of whole-number keys as words of 64 bits.

A set is a table ``word, bits, rows``: bit ``key % 64`` of word ``key / 64`` says whether the key is
in it. Keys that lie close together take a bit each instead of a row each, and words of different
tasks are united by ``or``; keys that lie far apart take a row each, as a list of keys would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulcra.config import JoinLimits
from pulcra.operators.lookup import write_sized

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def is_whole(df: DataFrame, key: str) -> bool:
    return isinstance(df.schema[key].dataType, _INTEGERS)


def _word(key: Column) -> Column:
    return F.shiftright(key.cast("bigint"), 6)


def _place(key: Column) -> Column:
    return key.cast("bigint").bitwiseAND(63).cast("int")


def key_words(df: DataFrame, key: str) -> DataFrame:
    """``word, bits, rows`` of a column of whole numbers; rows without a key have a null word."""
    one = F.expr(f"shiftleft(1L, CAST(CAST({key} AS BIGINT) & 63 AS INT))")
    words = df.select(_word(F.col(key)).alias("word"), one.alias("bits"))
    return words.groupBy("word").agg(F.bit_or("bits").alias("bits"), F.count(F.lit(1)).alias("rows"))


def set_totals(words: DataFrame) -> DataFrame:
    """One row: ``_keys`` distinct keys, ``_groups`` the same with null as a key, ``_rows`` rows."""
    keys = F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).cast("long")
    none = F.count(F.when(F.col("word").isNull(), 1))
    rows = F.coalesce(F.sum("rows"), F.lit(0))
    return words.agg(keys.alias("_keys"), (keys + none).alias("_groups"), rows.alias("_rows"))


def small_set(words: DataFrame, limits: JoinLimits = JoinLimits(), size: int | None = None) -> DataFrame | None:
    """The written words of a set whose size allows to broadcast them, else nothing. A written set
    comes with its ``size``."""
    known, size = write_sized(words) if size is None else (words, size)
    return known.where("word IS NOT NULL") if size <= limits.broadcast_bytes else None


def mark_members(df: DataFrame, key: str, known: DataFrame, name: str) -> DataFrame:
    """Add ``name``: whether the key of a row is in the set of :func:`small_set`. No row is shuffled."""
    few = F.broadcast(known.select(F.col("word").alias("_word"), F.col("bits").alias("_bits")))
    member = F.coalesce(F.getbit("_bits", _place(F.col(key))) == 1, F.lit(False))
    marked = df.withColumn("_word", _word(F.col(key))).join(few, "_word", "left")
    return marked.select(*df.columns, member.alias(name))

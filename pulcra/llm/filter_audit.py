"""Filter interaction audit: what each filter removes in every order of five filters.

One pass gives each document the mask of the filters it fails by itself. Whether its text repeats
is asked of a counting Bloom sketch first: every text adds one to a few cells, sketches of tasks
are added up, and a text with a cell that no other text has met is unique for sure. Only texts that
may repeat are shuffled, by their full text, for the smallest id that holds it. Masks then become
counts that add up: a document is counted with the mask it fails alone, and a repeated one is moved
to the mask with the bit of duplicates. All orders are read from the at most 32 counts of a part.

The sketch has segments of fixed size, as many as the documents need. Each text has all its cells
in one of them, so segments are merged apart from each other. Its bits are broadcast if they are
known to be few, else rows and segments meet in a shuffle that splits segments with many rows.

A null text is an empty one, a null source the part "". A null doc_id is neither smaller nor larger
than another, so its text is never late, and has no labels. Rows of one doc_id are documents of their own. Labels of
a doc_id count if any of its rows says 1. Further columns are not read. No document gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from pulcra.config import JoinLimits
from pulcra.llm.common import in_small_batches, table
from pulcra.operators.lookup import lookup_join, materialize

FILTERS = "ABCDE"
LATE = 1 << FILTERS.index("E")
CELLS = 1 << 16  # of a segment
HASHES = 4  # cells of a text, each in a quarter of its segment
QUARTER = CELLS // HASHES
SEGMENT_BYTES = CELLS // 8
UPPER = bytes(range(ord("A"), ord("Z") + 1))
SYMBOLS = re.compile(rb"[#$%&*|]")
BLANK = re.compile(rb"[\x20\x09-\x0D]")


@dataclass(frozen=True)
class Settings:
    min_words: int = 200
    min_distinct_pct: int = 50
    max_upper_pct: int = 2
    cells_per_text: int = 8
    held: int = 1 << 20  # hashes that a task adds up before it passes a sketch on
    part: int = 1 << 20  # bytes of a text that are split into words at once


def failures(raw: bytes, chars: int, s: Settings = Settings()) -> int:
    """Mask of the filters A to D that a text fails."""
    n, distinct, at = 0, set(), 0
    while at < len(raw):
        blank = BLANK.search(raw, at + s.part) if at + s.part < len(raw) else None
        end = blank.start() if blank else len(raw)
        words = raw[at:end].split()  # of bytes, split() knows the six ASCII blanks alone
        n += len(words)
        distinct.update(words)
        at = end
    upper = len(raw) - len(raw.translate(None, UPPER))
    failed = (
        n < s.min_words,
        100 * len(distinct) < s.min_distinct_pct * n,
        100 * upper > s.max_upper_pct * chars,
        SYMBOLS.search(raw) is not None,
    )
    return sum(bit << k for k, bit in enumerate(failed))


def _mask(text: Column, s: Settings) -> Column:
    @arrow_udf("int")
    def mask(texts: pa.Array) -> pa.Array:
        chars = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
        return pa.array([failures(t.as_py(), n, s) for t, n in zip(texts.cast(pa.binary()), chars)], pa.int32())

    return mask(F.coalesce(text, F.lit("")))


def _hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def repeated_cells(hashes: DataFrame, segments: int, s: Settings) -> DataFrame:
    """(segment, bits, rows): the cells that two rows of ``hashes`` (h, mixed) or more have met, as
    longs, and how many rows the segment has."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            cells, counts = np.unique(np.concatenate(held), return_counts=True)
            segment = cells // CELLS
            starts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
            offsets = pa.array(np.r_[starts, len(cells)], pa.int32())
            inside = pa.ListArray.from_arrays(offsets, pa.array(cells % CELLS, pa.int32()))
            met = pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32()))
            return pa.record_batch([pa.array(segment[starts]), inside, met], ["segment", "cells", "counts"])

        for batch in batches:
            h, mixed = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            base = np.mod(h, segments) * CELLS
            held += [base + k * QUARTER + ((mixed >> 14 * k) & (QUARTER - 1)) for k in range(HASHES)]
            if sum(map(len, held)) > s.held * HASHES:
                yield out()
                held.clear()
        if sum(map(len, held)):
            yield out()

    def merge(rows: pa.Table) -> pa.Table:
        met = np.zeros(CELLS, np.int64)
        for cells, counts in zip(rows["cells"].chunks, rows["counts"].chunks):
            np.add.at(met, cells.flatten().to_numpy(), counts.flatten().to_numpy())
        bits = np.packbits(met >= 2, bitorder="little").view("<i8")
        members = pa.array([int(met[:QUARTER].sum())])  # each row has one cell in the first quarter
        return pa.table({"segment": rows["segment"][:1], "bits": pa.array([bits], pa.list_(pa.int64())), "rows": members})

    partial = hashes.select("h", "mixed").mapInArrow(sketch, "segment long, cells array<int>, counts array<int>")
    return partial.groupBy("segment").applyInArrow(merge, "segment long, bits array<long>, rows long")


def _may_repeat(bits: Column, mixed: Column) -> Column:
    """Whether all cells of a text have been met twice."""
    met = F.lit(True)
    for k in range(HASHES):
        cell = F.shiftright(mixed, 14 * k).bitwiseAND(QUARTER - 1) + k * QUARTER
        word = F.element_at(bits, (F.floor(cell / 64) + 1).cast("int"))
        met &= F.getbit(word, F.pmod(cell, F.lit(64)).cast("int")) == 1
    return met


def late_rows(docs: DataFrame, hashes: DataFrame, s: Settings = Settings(), limits: JoinLimits = JoinLimits()) -> DataFrame:
    """(doc_id, part, text) rows whose very text a smaller doc_id has too. ``hashes`` has the rows' h, mixed."""
    segments = max(1, -(-hashes.count() * s.cells_per_text // CELLS))
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("h", _hash()).withColumn("at", F.monotonically_increasing_id())
    dealt = {"row_id": F.col("at"), "limits": limits}
    probed = lookup_join(rows, repeated_cells(hashes, segments, s), key=F.pmod("h", F.lit(segments)), lookup_key="segment", weight="rows", **dealt)
    possible = probed.where(_may_repeat(F.col("bits"), F.xxhash64("h"))).select("doc_id", "part", "text", "at")
    least = possible.groupBy("text").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    found = lookup_join(possible, least, key=F.col("text"), lookup_key="text", weight="rows", **dealt)
    return found.where("doc_id > first").select("doc_id", "part", "text")


def mask_counts(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), limits: JoinLimits = JoinLimits()) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the filters that they fail alone."""
    docs = in_small_batches(docs)
    part = F.coalesce("source", F.lit("")).alias("part")
    alone = materialize(docs.select("doc_id", part, _mask(F.col("text"), s).alias("mask"), _hash().alias("h")).withColumn("mixed", F.xxhash64("h")))
    late = late_rows(docs, alone.select("h", "mixed"), s, limits).select("doc_id", "part", _mask(F.col("text"), s).alias("mask"))
    moves = F.explode(F.array(F.struct(F.col("mask"), F.lit(-1).alias("n")), F.struct((F.col("mask") + LATE).alias("mask"), F.lit(1).alias("n"))))
    moved = late.select("doc_id", "part", moves.alias("m")).select("doc_id", "part", "m.mask", "m.n")
    # One row per id, part and mask: an id that most rows share is no larger than others below.
    counts = alone.select("doc_id", "part", "mask", F.lit(1).alias("n")).unionByName(moved).groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
    is_good, is_toxic = F.col("quality") == 1, F.col("toxic") == 1
    marked = labels.where(is_good | is_toxic).groupBy("doc_id").agg(F.max(F.coalesce(is_good, F.lit(False))).alias("good"), F.max(F.coalesce(is_toxic, F.lit(False))).alias("toxic"))
    known = counts.where("n != 0").join(marked, "doc_id", "left")
    of = lambda flag: F.coalesce(F.sum(F.when(F.col(flag), F.col("n"))), F.lit(0)).alias(flag)
    return known.groupBy("part", "mask").agg(F.sum("n").alias("n"), of("good"), of("toxic"))


def _letters(text: Column) -> Column:
    """Mask of the filters that a text of letters names."""
    return sum((F.when(F.contains(text, F.lit(c)), 1 << k).otherwise(0) for k, c in enumerate(FILTERS)), F.lit(0))


def audit(counts: DataFrame) -> DataFrame:
    """One row per part, order and step from :func:`mask_counts`."""
    orders = [F.lit("".join(p)) for p in permutations(FILTERS)]
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))  # 32 at most
    steps = parts.select("part", "masks", F.explode(F.array(*orders)).alias("filter_order"))
    steps = steps.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    before = F.col("filter_order").substr(F.lit(1), F.col("step") - 1)
    steps = steps.withColumn("before", _letters(before)).withColumn("own", _letters(F.col("filter_order").substr(F.col("step"), F.lit(1))))

    def total(condition, measure="n") -> Column:
        chosen = F.filter("masks", lambda m: condition(m["mask"]))
        return F.aggregate(chosen, F.lit(0).cast("long"), lambda sum_, m: sum_ + m[measure])

    fails = lambda m: m.bitwiseAND(F.col("own")) != 0
    gone = lambda m: m.bitwiseAND(F.col("before")) != 0
    removed = lambda m: fails(m) & ~gone(m)
    # Of the orders, a filter comes first of all that a document fails in one of as many as it fails.
    first = F.aggregate(F.filter("masks", lambda m: fails(m["mask"])), F.lit(0).cast("long"), lambda sum_, m: sum_ + m["n"] * F.floor(F.lit(len(orders)) / F.bit_count(m["mask"])))
    return steps.select(
        "part", "filter_order", "step",
        total(lambda m: ~fails(m) & ~gone(m)).alias("kept"),
        total(removed).alias("removed"),
        total(lambda m: fails(m) & gone(m)).alias("redundant"),
        total(lambda m: m == F.col("own")).alias("unique_fails"),
        total(removed, "good").alias("good_lost"),
        total(removed, "toxic").alias("toxic_lost"),
        first.alias("shapley"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(mask_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))

"""SimHash near-duplicates by distances to reference fingerprints.

By the triangle inequality two fingerprints within ``radius`` bits differ by at most ``radius`` in
their Hamming distance to any reference. References that differ from a first one in one block of bits
each say more: the difference of the two distances tells in how many bits of the block a fingerprint
differs from the first, and over all blocks these coordinates of near fingerprints differ by
``radius`` in sum. So at most ``radius`` of them differ at all, and of ``radius + 1`` groups of
coordinates one agrees. Fingerprints meet in one cell for each group, so there are as many rows a
fingerprint at any size. In a cell the distances to further references discard most pairs, and the
fingerprints themselves decide the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from pulcra.llm.common import components, in_small_batches, table
from pulcra.llm.tiles import self_tiles, smallest_reachable
from pulcra.operators.lookup import lookup_join, materialize


@dataclass(frozen=True)
class Settings:
    shingle: int = 3
    radius: int = 2
    pivots: int = 24  # that discard pairs of a cell
    bits: int = 2  # of a block, by which a reference of a coordinate differs from the first
    cell_rows: int = 1000  # fingerprints that a cell should hold, about
    block: int = 2048


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash over the shingles of words; 0 without a word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    runs = [words[k:] for k in range(shingle)] if len(words) > shingle else [[b" ".join(words)]]
    total, ones, digest = 0, np.zeros(64, np.int64), xxhash.xxh64_intdigest
    shingles = map(b" ".join, zip(*runs))
    while part := [digest(x, 42) for x in islice(shingles, 1 << 16)]:
        bits = np.unpackbits(np.array(part, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(part)
    return int(np.packbits(2 * ones > total).view(">i8")[0])


def fingerprints(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    size = s.shingle

    @arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t, size) for t in texts.to_pylist()], pa.int64())

    return in_small_batches(docs).select("doc_id", simhash("text").alias("fp"))


def references(count: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(f"reference {k}") for k in range(count)], np.uint64)


def distances(fps: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Hamming distance of each fingerprint to each reference."""
    return np.bitwise_count(fps.view(np.uint64)[:, None] ^ pivots[None, :]).astype(np.int8)


def coordinates(fps: np.ndarray, s: Settings = Settings()) -> np.ndarray:
    """For each fingerprint and block the number of bits in which it differs from the first reference
    there, taken from the distances to that and to the block's own reference."""
    first = references(1)
    masks = [((1 << s.bits) - 1) << at & 2**64 - 1 for at in range(0, 64, s.bits)]
    widths = np.array([m.bit_count() for m in masks], np.int64)
    table = distances(fps, np.concatenate([first, first ^ np.array(masks, np.uint64)])).astype(np.int64)
    return (table[:, :1] - table[:, 1:] + widths) // 2


def _tabled(classes: DataFrame, cells: int, s: Settings) -> DataFrame:
    """The cells of each fingerprint, one of so many for each group of coordinates."""
    groups = s.radius + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            own = coordinates(fps, s).astype(np.uint64)
            for group in range(groups):
                code = np.full(len(fps), group, np.uint64)
                for k in range(group, own.shape[1], groups):
                    code = code * np.uint64(s.bits + 1) + own[:, k]
                mixed = (code ^ code >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
                cell = np.uint64(group * cells) + (mixed >> np.uint64(20)) % np.uint64(cells)
                yield pa.record_batch([pa.array(cell.astype(np.int64)), pa.array(fps)], ["_cell", "node"])

    return classes.select("node").mapInArrow(run, "_cell long, node long")


def linked(classes: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Edges (u, v) that join all fingerprints within the radius: of every tile, each node and the
    smallest node that it reaches there."""
    cells = max(1, -(-classes.count() // s.cell_rows))

    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        nodes, own = rows["node"].to_numpy(), rows["_own"].to_numpy()
        a, b = (nodes[own == side.as_py()] for side in key[1:])
        pivots = references(s.pivots)
        da, db = distances(a, pivots), distances(b, pivots)
        near = np.ones((len(a), len(b)), bool)
        for k in range(3):
            near &= np.abs(da[:, None, k] - db[None, :, k]) <= s.radius
        i, j = np.nonzero(near)
        for k in range(3, s.pivots):
            left = np.abs(da[i, k] - db[j, k]) <= s.radius
            i, j = i[left], j[left]
        left = np.bitwise_count(a[i].view(np.uint64) ^ b[j].view(np.uint64)) <= s.radius
        low_a, low_b = smallest_reachable(a, b, (i[left], j[left]))
        u, v = np.concatenate([a, b]), np.concatenate([low_a, low_b])
        return pa.table({"u": u[u != v], "v": v[u != v]})

    rows = _tabled(classes, cells, s)
    return self_tiles(rows, rows.select("_cell"), s.block).applyInArrow(compare, "u long, v long")


def near_duplicates(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(doc_id, fp, component_id) of every row; component_id is the smallest doc_id reachable.

    Null, empty and blank texts have fingerprint 0 and are linked like others. Rows of one doc_id
    are one document with several texts. Null doc_ids do not count for a component's smallest one.
    """
    rows = materialize(fingerprints(docs, s))
    classes = materialize(rows.groupBy(F.col("fp").alias("node")).agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("rows")))
    roots = components(linked(classes, s))
    # Both sides have one row per fingerprint, so no key is hot.
    rooted = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    lookup = rooted.join(ids, "root").select("node", "rows", "component_id")
    return lookup_join(rows, lookup, key=F.col("fp"), lookup_key="node", weight="rows", row_id=F.coalesce("doc_id", "fp"))


def op5_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")

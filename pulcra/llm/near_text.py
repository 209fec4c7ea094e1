"""The near-duplicate stage of the pipeline: SimHash candidates, verified on five-word shingles.

Texts that share 0.8 of their shingles differ in up to about eighteen fingerprint bits. At that radius
distances to references no longer tell texts apart, as they differ by less between any two texts. So
besides the pivot cells of ``simhash_pivot``, which find the closest texts, texts meet in tables by
bands of their minimal shingle hashes: as many rows a text at any size, and pairs at the threshold
are missed by all tables 9 times in 1000. Every pair of a cell within the radius is looked at there by
signatures of minimal shingle hashes, unless both are already joined by way of others: clearly similar
texts are joined, clearly other ones are not, and pairs near the threshold are decided by their
shingles. Of those a tile first passes on a few a text; where more are left it is looked at again, with
a larger allowance and what has been joined meanwhile, until none is left. So no partner is left out.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from pulcra.llm.common import components, in_small_batches, without
from pulcra.llm.simhash_pivot import Settings as PivotSettings
from pulcra.llm.simhash_pivot import fingerprint, linked
from pulcra.llm.tiles import TILE, self_tiles
from pulcra.operators.keysets import key_words, mark_members
from pulcra.operators.lookup import lookup_join, materialize, work_folder, work_tables, write_observed


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    similarity: float = 0.8
    margin: float = 0.15  # five standard errors of an estimate; pairs nearer are decided by shingles
    radius: int = 18
    bands: int = 18  # tables; each takes its cells from so many
    hashes: int = 9  # minimal hashes of the signature; together 1 in 100 pairs at 0.8 is missed
    cell_rows: int = 1000  # texts that a cell of a table should hold, about
    block: int = 2048
    pairs: int = 2  # near the threshold that a tile passes on at first, for each text
    sets: int = 256  # shingle sets of either side of a tile where pairs are decided
    asked_bits: int = 1 << 24  # of the set that tells which texts those are, about


HASHES = 256  # in a signature, two bits of each
SIGNATURE = HASHES // 4  # bytes
_LOW_BITS = np.uint64(0x5555555555555555)


@cache
def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    draw = lambda name: np.array([xxhash.xxh64_intdigest(f"{name} {k}") for k in range(HASHES)], np.uint64)
    return draw("times") | np.uint64(1), draw("plus")


def _shingles(text: str | None, s: Settings) -> Iterator[np.ndarray]:
    """Hashes of the runs of words, part by part; a shorter text is one run."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    count = max(1, len(words) - s.shingle + 1)
    for at in range(0, count, 1024):
        part = [xxhash.xxh64_intdigest(b" ".join(words[i : i + s.shingle])) for i in range(at, min(at + 1024, count))]
        yield np.unique(np.array(part, np.uint64))


def shingle_set(text: str | None, s: Settings = Settings()) -> bytes:
    """All distinct shingle hashes in order, eight bytes each."""
    return np.unique(np.concatenate(list(_shingles(text, s)))).tobytes()


def exact_similarity(a: bytes, b: bytes) -> float:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def signature(text: str | None, s: Settings = Settings()) -> bytes:
    """Two bits of the smallest hash of any shingle, for each of ``HASHES`` hash functions."""
    times, plus = _multipliers()
    least = np.full(HASHES, 2**64 - 1, np.uint64)
    for hashed in _shingles(text, s):
        np.minimum(least, (hashed[:, None] * times + plus).min(axis=0), out=least)
    two = (least >> np.uint64(24)).astype(np.uint8) & 3
    return (two.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8).tobytes()


def signatures(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Signatures as rows of eight unsigned 64-bit integers."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, SIGNATURE // 8)


def similarity(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated share of common shingles, row by row; two bits in four agree by chance."""
    differ = a ^ b
    other = np.bitwise_count((differ | differ >> np.uint64(1)) & _LOW_BITS).sum(axis=1, dtype=np.int64)
    return 1 - other / HASHES / 0.75


def missed(similarity: float, s: Settings) -> float:
    """Chance that two texts of that similarity meet in no table. Two bits of a hash agree by chance
    in a quarter of the cases; the number of texts does not matter."""
    agree = similarity + (1 - similarity) / 4
    return (1 - agree**s.hashes) ** s.bands


def _tables(classes: DataFrame, cells: int, s: Settings) -> DataFrame:
    """The rows of ``classes`` (node, sig first) once for each table, with ``_cell``: a band of the
    signature, hashed into one of so many cells of the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, SIGNATURE)
            two = (held[:, :, None] >> np.array([0, 2, 4, 6], np.uint8) & 3).reshape(len(held), HASHES).astype(np.uint64)
            for band in range(s.bands):
                code = np.full(len(two), band, np.uint64)
                for k in range(band * s.hashes, (band + 1) * s.hashes):
                    code = code * np.uint64(4) + two[:, k]
                mixed = (code ^ code >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
                cell = np.uint64(band * cells) + (mixed >> np.uint64(20)) % np.uint64(cells)
                yield pa.record_batch([pa.array(cell.astype(np.int64)), *batch.columns], ["_cell", *batch.schema.names])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(run, f"_cell long, {fields}")


def _join(roots: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Roots after the items x and y were joined pairwise: the smallest index of each group."""
    up = roots.tolist()
    for a, b in zip(x.tolist(), y.tolist()):
        while up[a] != a:
            a = up[a]
        while up[b] != b:
            b = up[b]
        up[max(a, b)] = min(a, b)
    roots = np.array(up)
    while (roots != (further := roots[roots])).any():
        roots = further
    return roots


SURE, NEAR, LEFT = 0, 1, 2  # an edge; a pair to be decided by shingles; a cell (u) that has more of those


def groups_in_tile(nodes: np.ndarray, sigs: np.ndarray, home: np.ndarray, probe: np.ndarray, s: Settings, roots: np.ndarray, allowed: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Roots of all nodes (sorted, distinct) when home and probe (places in nodes) are compared, places
    of the pairs near the threshold (two rows), and whether there are more of them.

    ``roots`` are places of what is joined already. Each pair within the radius is looked at by its
    signatures or joined already when its turn comes. Rows look at their nearest partner first, then
    at ever more pairs at a time: in a large group few decisions join all of it.
    """
    near, more = [np.empty((2, 0), int)], False
    for at in range(0, len(probe) if len(home) else 0, 256):
        own = probe[at : at + 256]
        far = np.bitwise_count(nodes[own].view(np.uint64)[:, None] ^ nodes[home].view(np.uint64)[None, :])
        far[own[:, None] == home[None, :]] = 255
        far[roots[own][:, None] == roots[home][None, :]] = 255
        i, k, take, unsure = np.arange(len(own)), far.argmin(axis=1), 1024, []
        while True:
            i, k = (x[far[i, k] <= s.radius] for x in (i, k))
            alike = similarity(sigs[own[i]], sigs[home[k]])
            good = alike >= s.similarity + s.margin
            roots = _join(roots, own[i[good]], home[k[good]])
            open_ = ~good & (alike >= s.similarity - s.margin)
            unsure.append(np.stack([own[i[open_]], home[k[open_]]]))
            far[i, k] = 255
            i, k = np.nonzero((far <= s.radius) & (roots[own][:, None] != roots[home][None, :]))
            if not len(i):
                break
            spread = max(1, len(i) // take)
            i, k, take = i[::spread], k[::spread], 2 * take
        pairs = np.concatenate(unsure, axis=1)
        pairs = pairs[:, roots[pairs[0]] != roots[pairs[1]]]
        if pairs.shape[1] > allowed * len(own):
            # A choice by hash is the same in every tile, and mixes all groups.
            u, v = np.sort(nodes[pairs], axis=0).view(np.uint64)
            mixed = (u * np.uint64(0x9E3779B97F4A7C15) ^ v) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ mixed >> np.uint64(31)) * np.uint64(0x94D049BB133111EB)
            pairs, more = pairs[:, np.argsort(mixed)[: allowed * len(own)]], True
        near.append(pairs)
    pairs = np.concatenate(near, axis=1)
    return roots, pairs[:, roots[pairs[0]] != roots[pairs[1]]], more


def table_pairs(classes: DataFrame, s: Settings, allowed: int, cells: DataFrame | None = None) -> DataFrame:
    """(u, v, kind) of what meets in a table, in all cells or in ``cells``; ``classes``: node, sig, root."""
    count = max(1, -(-classes.count() // s.cell_rows))

    def compare(tile: pa.Table) -> pa.Table:
        tile = tile.sort_by("node")
        nodes, own = tile["node"].to_numpy(), tile["_own"].to_numpy()
        home, probe = (np.flatnonzero(own == tile[side][0].as_py()) for side in ("_home", "_probe"))
        _, first, group = np.unique(tile["root"].to_numpy(), return_index=True, return_inverse=True)
        roots, near, more = groups_in_tile(nodes, signatures(tile["sig"]), home, probe, s, first[group], allowed)
        moved = np.flatnonzero(roots != first[group])
        low, high = np.unique(np.sort(nodes[near], axis=0), axis=1)
        cell = tile["_cell"].to_numpy()[: int(more)]
        kinds = np.repeat(np.array([SURE, NEAR, LEFT], np.int32), [len(moved), len(low), len(cell)])
        return pa.table({"u": np.concatenate([nodes[moved], high, cell]), "v": np.concatenate([nodes[roots[moved]], low, cell]), "kind": kinds})

    rows = _tables(classes, count, s)
    sizes = rows.select("_cell")
    if cells is not None:
        rows, sizes = (x.join(cells, "_cell", "left_semi") for x in (rows, sizes))
    return self_tiles(rows, sizes, s.block).applyInArrow(compare, "u long, v long, kind int")


def table_edges(classes: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Edges (u, v) that join all clearly similar texts that meet in a table; ``classes``: node, sig."""
    return table_pairs(classes.withColumn("root", F.col("node")), s, s.pairs).where(F.col("kind") == SURE).select("u", "v")


def _row_key() -> Column:
    return F.xxhash64("doc_id", F.col("doc_id").isNull(), "text")


def tiled_pairs(pairs: DataFrame, s: Settings) -> DataFrame:
    """Written pairs (u, v) with the tile where they are decided: two blocks of the texts that hang
    together by pairs, so that a text goes to few tiles, whatever the number of its pairs."""
    others = components(pairs)  # without the roots themselves
    roots = others.unionByName(others.select("root", F.col("root").alias("node")).distinct())
    blocks = roots.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / s.sets).alias("_blocks")).where("_blocks > 1")
    own = F.pmod(F.xxhash64("node"), F.coalesce("_blocks", F.lit(1))).cast("int")
    placed = materialize(roots.join(blocks, "root", "left").select("node", F.col("root").alias("_cell"), own.alias("_own")))
    sides = {"u": ["_cell"], "v": []}
    for side, kept in sides.items():
        pairs = pairs.join(placed.select(F.col("node").alias(side), *kept, F.col("_own").alias(f"_{side}")), side)
    return pairs.select("u", "v", "_cell", F.least("_u", "_v").alias("_home"), F.greatest("_u", "_v").alias("_probe"))


def maybe_asked(rows: DataFrame, asked: DataFrame, s: Settings) -> DataFrame:
    """Rows whose ``_key`` is in ``asked``, and few others. Every task gets the keys as at most
    ``asked_bits`` bits, so texts that are not asked for stay where they are, at any size."""
    bit = F.pmod("_key", F.lit(s.asked_bits)).alias("_bit")
    known = materialize(key_words(asked.select(bit), "_bit"))
    return mark_members(rows.select("*", bit), "_bit", known, "_maybe").where("_maybe").drop("_bit", "_maybe")


def similar_pairs(pairs: DataFrame, docs: DataFrame, classes: DataFrame, s: Settings) -> DataFrame:
    """Of written pairs (u, v) of classes those whose texts share enough shingles.

    The shingles of each class in question, those of the row that stands for it, go once to each tile
    that has a pair of it.
    """
    tiled = materialize(tiled_pairs(pairs, s))
    ends = tiled.select(F.explode(F.array("u", "v")).alias("node"), F.struct(*TILE).alias("_tile"))
    needed = ends.groupBy("node").agg(F.collect_set("_tile").alias("_tiles"))
    asked = materialize(needed.join(classes.select("node", F.col("found.key").alias("_key")), "node"))

    @arrow_udf("binary")
    def sets(texts: pa.Array) -> pa.Array:
        return pa.array([shingle_set(t, s) for t in texts.to_pylist()], pa.binary())

    def decide(given: pa.Table, held: pa.Table) -> pa.Table:
        of = dict(zip(held["node"].to_pylist(), held["held"].to_pylist()))  # equal rows of one doc_id are the same text
        alike = [exact_similarity(of[a], of[b]) >= s.similarity for a, b in zip(given["u"].to_pylist(), given["v"].to_pylist())]
        return given.select(["u", "v"]).filter(pa.array(alike, pa.bool_()))

    own = maybe_asked(in_small_batches(docs).select("text", _row_key().alias("_key")), asked, s).join(asked, "_key")
    held = own.select("node", "_tiles", sets("text").alias("held")).select("node", "held", F.explode("_tiles").alias("_tile"))
    held = held.select("_tile.*", "node", "held")
    return tiled.groupBy(*TILE).cogroup(held.groupBy(*TILE)).applyInArrow(decide, "u long, v long")


def near_texts(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(doc_id, fp, component_id) of every row, as ``simhash_pivot.near_duplicates`` gives it, for
    texts whose shingles are similar. Null, empty and blank texts are one group."""

    @arrow_udf("fp long, sig binary")
    def read(texts: pa.Array) -> pa.Array:
        given = texts.to_pylist()
        fps = pa.array([fingerprint(t, s.shingle) for t in given], pa.int64())
        return pa.StructArray.from_arrays([fps, pa.array([signature(t, s) for t in given], pa.binary())], ["fp", "sig"])

    rows = materialize(in_small_batches(docs).select("doc_id", read("text").alias("r"), _row_key().alias("key")).select("doc_id", "key", "r.*"))
    # One row stands for all of a fingerprint, with its signature.
    one = F.min(F.struct("sig", "key")).alias("found")
    grouped = rows.groupBy(F.col("fp").alias("node")).agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("rows"), one)
    classes = materialize(grouped)
    signs = classes.select("node", F.col("found.sig").alias("sig"))
    signed = materialize(linked(classes, PivotSettings(shingle=s.shingle)).distinct())

    @arrow_udf("double")
    def compare(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(similarity(signatures(a), signatures(b)), pa.float64())

    for side in ("u", "v"):
        signed = signed.join(signs.select(F.col("node").alias(side), F.col("sig").alias(f"sig_{side}")), side)
    alike = compare("sig_u", "sig_v")
    kind = F.when(alike >= s.similarity + s.margin, SURE).when(alike >= s.similarity - s.margin, NEAR)
    signed = signed.select("u", "v", kind.alias("kind"))
    allowed = s.pairs
    found = materialize(table_pairs(signs.withColumn("root", F.col("node")), s, allowed).unionByName(signed))
    edges = found.where(F.col("kind") == SURE).select("u", "v")
    while True:
        roots = components(edges)
        near = found.where(F.col("kind") == NEAR).select("u", "v").distinct()
        for side in ("u", "v"):
            near = near.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}")), side, "left")
        apart = F.coalesce("root_u", "u") != F.coalesce("root_v", "v")
        near = materialize(near.where(apart).select("u", "v"))
        if not near.isEmpty():
            edges = materialize(edges.unionByName(similar_pairs(near, docs, classes, s)))
            roots = components(edges)
        cells = materialize(found.where(F.col("kind") == LEFT).select(F.col("u").alias("_cell")).distinct())
        if cells.isEmpty():
            break
        # Pairs that were refused come again, but each turn passes on eight times as many.
        allowed *= 8
        rooted = signs.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        found = materialize(table_pairs(rooted.select("node", "sig", "root"), s, allowed, cells))
        edges = materialize(edges.unionByName(found.where(F.col("kind") == SURE).select("u", "v")))
    rooted = classes.drop("found").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    lookup = rooted.join(ids, "root").select("node", "rows", "component_id")
    return lookup_join(rows.drop("sig", "key"), lookup, key=F.col("fp"), lookup_key="node", weight="rows", row_id=F.coalesce("doc_id", "fp"))


def keep_first(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Of each component the document with the smallest doc_id stays.

    Rows of one doc_id are one document. A null doc_id stays only if its component has no other.
    """
    spark = docs.sparkSession
    path = f"{work_folder(spark)}/{uuid.uuid4().hex}"
    with work_tables(spark):  # of all that was written only the ids to drop are kept
        found = near_texts(docs, s)
        gone = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
        gone, _ = write_observed(gone, {"rows": F.count(F.lit(1))}, path=path)
    return without(docs, F.col("doc_id"), gone)

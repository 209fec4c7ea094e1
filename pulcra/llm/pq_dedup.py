"""Near-duplicate vectors by product quantisation over coarse inverted lists.

A bounded sample fits the coarse centroids and, on the residuals, one small codebook for each
subspace. Every distinct vector is coded into the list of its nearest centroid and probes all lists
that can hold a partner. In a list the cosine to each code is looked up in a table of products; the
stored length of what the code leaves out bounds the error, so every vector that may reach the
threshold is compared exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulcra.llm.common import components, table
from pulcra.llm.tiles import smallest_reachable, tiles
from pulcra.operators.lookup import lookup_join, materialize


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.9
    list_rows: int = 1024  # vectors of a list, about
    most_lists: int = 4096
    sample_per_list: int = 16  # the sample has at most most_lists times as many vectors
    subspaces: int = 8
    codewords: int = 256
    rounds: int = 6
    probe_sigma: float = 2.5  # how far a partner may lean towards another centroid, see ``probed``
    block: int = 2048


@dataclass(frozen=True)
class Index:
    centroids: np.ndarray  # unit vectors
    codebooks: list[np.ndarray]
    parts: list[slice]


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (rows @ centres.T - 0.5 * (centres**2).sum(axis=1)).argmax(axis=1)


def _means(rows: np.ndarray, count: int, rounds: int) -> np.ndarray:
    centres = rows[np.linspace(0, len(rows) - 1, min(count, len(rows))).astype(int)].copy()
    for _ in range(rounds):
        own = _nearest(rows, centres)
        sums, sizes = np.zeros_like(centres), np.bincount(own, minlength=len(centres))
        np.add.at(sums, own, rows)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def fit(sample: np.ndarray, lists: int, s: Settings) -> Index:
    centroids = _means(sample, lists, s.rounds)
    centroids = centroids / np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-12)
    residuals = sample - centroids[(sample @ centroids.T).argmax(axis=1)]
    edges = np.linspace(0, sample.shape[1], min(s.subspaces, sample.shape[1]) + 1).astype(int)
    parts = [slice(a, b) for a, b in zip(edges, edges[1:])]
    return Index(centroids, [_means(residuals[:, p], s.codewords, s.rounds) for p in parts], parts)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; scaled first, so that no square over- or underflows."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def probed(rows: np.ndarray, index: Index, s: Settings) -> np.ndarray:
    """Lists that can hold a partner: (row, list) as booleans.

    A partner y of x is x turned by at most the threshold's angle t towards some direction u. It
    falls into list c instead of x's own list c* only if x(c* - c) <= tan(t) u(c - c*). In the worst
    case the last product is the length of c - c* across x; for a direction that does not know the
    lists it is below ``probe_sigma`` / sqrt(dimensions) of that length.
    """
    products = rows @ index.centroids.T
    best = products.argmax(axis=1)
    gap = products[np.arange(len(rows)), best][:, None] - products
    squares = 2 - 2 * (index.centroids @ index.centroids.T)[best]
    across = np.sqrt(np.maximum(squares - gap**2, 0))
    lean = min(1.0, s.probe_sigma / math.sqrt(rows.shape[1])) * math.tan(math.acos(s.threshold))
    return gap <= lean * across + 1e-9


def _matrix(table_: pa.Table, dims: int, kind: str) -> np.ndarray:
    return unit(np.frombuffer(b"".join(table_["vector"].to_pylist()), kind).reshape(-1, dims))


def _coded(classes: DataFrame, shared, dims: int, kind: str, s: Settings) -> tuple[DataFrame, DataFrame]:
    def rows_of(batch: pa.RecordBatch) -> np.ndarray:
        flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(-1, dims)

    def raw(rows: np.ndarray) -> pa.Array:
        return pa.array([r.tobytes() for r in rows], pa.binary())

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            given = rows_of(batch)
            rows = unit(given)
            own = (rows @ index.centroids.T).argmax(axis=1)
            left = rows - index.centroids[own]
            codes = np.stack([_nearest(left[:, p], book) for p, book in zip(index.parts, index.codebooks)], axis=1).astype(np.uint8)
            coded = np.concatenate([book[codes[:, m]] for m, book in enumerate(index.codebooks)], axis=1)
            error = np.linalg.norm(left - coded, axis=1)
            yield pa.record_batch([pa.array(own.astype(np.int64)), batch.column("node"), raw(codes), pa.array(error), raw(given.astype(kind)), batch.column("n")], ["_cell", "node", "code", "error", "vector", "n"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = rows_of(batch)
            rows, given = unit(given), given.astype(kind)
            for at in range(0, len(rows), 1024):
                i, lists = np.nonzero(probed(rows[at : at + 1024], shared.value, s))
                nodes = batch.column("node").slice(at, 1024).take(pa.array(i))
                yield pa.record_batch([pa.array(lists.astype(np.int64)), nodes, raw(given[at + i])], ["_cell", "node", "vector"])

    own = classes.select("node", "vector", "n")
    return (
        own.mapInArrow(home, "_cell long, node long, code binary, error double, vector binary, n long"),
        own.mapInArrow(probe, "_cell long, node long, vector binary"),
    )


def _links(classes: DataFrame, dims: int, kind: str, s: Settings) -> DataFrame:
    """(node, low, links): in each tile the smallest node reached and the vectors linked."""
    count = classes.count()
    lists = min(s.most_lists, max(1, count // s.list_rows))
    take = max(s.sample_per_list * lists, s.codewords)
    sample = classes.orderBy(F.xxhash64("node")).limit(take).select("vector").toArrow()
    rows = unit(sample["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dims))
    shared = classes.sparkSession.sparkContext.broadcast(fit(rows, lists, s))
    home, probe = _coded(classes, shared, dims, kind, s)

    def compare(key: tuple, home: pa.Table, probe: pa.Table) -> pa.Table:
        a, b = home["node"].to_numpy(), probe["node"].to_numpy()
        links, low_a, low_b = np.zeros(len(b), np.int64), a, b
        if len(a) and len(b):
            index = shared.value
            x, y = _matrix(home, dims, kind), _matrix(probe, dims, kind)
            codes = np.frombuffer(b"".join(home["code"].to_pylist()), np.uint8).reshape(len(a), -1)
            rough = np.repeat((y @ index.centroids[key[0].as_py()])[:, None], len(a), axis=1)
            for m, (part, book) in enumerate(zip(index.parts, index.codebooks)):
                rough += (y[:, part] @ book.T)[:, codes[:, m]]
            maybe = rough + home["error"].to_numpy() >= s.threshold - 1e-9
            some_b, some_a = np.flatnonzero(maybe.any(axis=1)), np.flatnonzero(maybe.any(axis=0))
            exact = (y[some_b] @ x[some_a].T >= s.threshold) & maybe[np.ix_(some_b, some_a)]
            exact &= b[some_b][:, None] != a[some_a][None, :]
            links[some_b] = exact @ home["n"].to_numpy()[some_a]
            j, i = np.nonzero(exact)
            i, j = some_a[i], some_b[j]
            order = np.lexsort((j, i))
            low_a, low_b = smallest_reachable(a, b, (i[order], j[order]))
        nodes, low = np.concatenate([a, b]), np.concatenate([low_a, low_b])
        found = np.concatenate([np.zeros(len(a), np.int64), links])
        kept = (nodes != low) | (found > 0)
        return pa.table({"node": nodes[kept], "low": low[kept], "links": found[kept]})

    return tiles(home, probe, s.block).applyInArrow(compare, "node long, low long, links long")


def near_vectors(vectors: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding).

    Vectors that are null, empty, zero or hold a null, NaN or infinite component link with nothing;
    vectors of different length do not either. Equal vectors are coded and compared once; each
    counts as linked to all its copies. Rows that repeat a vec_id are vectors of their own.
    """
    v = F.col("embedding")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select("vec_id", F.when(good, v).alias("vector"))
    # Without the sign of zeros, equal vectors are equal bit by bit.
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x.cast("double") + F.lit(0.0)))
    rows = rows.withColumn("node", F.when(F.col("vector").isNotNull(), F.xxhash64("vector")))
    grouped = rows.where("node IS NOT NULL").groupBy("node", "vector").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"))
    classes = materialize(grouped.withColumn("dims", F.size("vector")))
    # Vectors travel as they were given, half as wide if they are single precision.
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "<f8"
    found = None
    for (dims,) in classes.select("dims").distinct().orderBy("dims").collect():
        own = _links(classes.where(F.col("dims") == dims), dims, kind, s)
        found = own if found is None else found.unionByName(own)
    spark = vectors.sparkSession
    links = materialize(found) if found is not None else spark.createDataFrame([], "node long, low long, links long")
    roots = components(links.where("node != low").select(F.col("node").alias("u"), F.col("low").alias("v")))
    sums = links.groupBy("node").agg(F.sum("links").alias("links"))
    joined = classes.drop("vector").join(sums, "node", "left").join(roots, "node", "left")
    joined = joined.withColumn("root", F.coalesce("root", "node"))
    ids = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    n_links = F.coalesce("links", F.lit(0)) + F.col("n") - 1
    lookup = joined.join(ids, "root").select("node", F.col("n").alias("rows"), n_links.alias("n_links"), "component_id")
    out = lookup_join(rows.drop("vector"), lookup, key=F.col("node"), lookup_key="node", weight="rows", row_id=F.col("vec_id"))
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def op2_product_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))

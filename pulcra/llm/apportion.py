"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks of words.

Blocks are apportioned to sources by their targets, and each source's blocks to its shards by the
shards' words. A shard's documents stand end to end in a seeded order; blocks cut that row of words
into equal parts, and a seeded stride through the blocks selects exactly the shard's quota.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulcra.llm.common import n_words, table
from pulcra.operators.lookup import materialize


@dataclass(frozen=True)
class Settings:
    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5  # words of the mix, of all words
    most: float = 2.0  # of a source's words
    block: int = 64  # words
    shard: int = 1 << 20  # words of a shard, about
    seed: int = 17


def sainte_lague(weights: list[float], seats: int) -> list[int]:
    """Seats by highest quotients weight / (2 * seats so far + 1); of equal ones the first wins.

    Starts from the rounded shares and gives or takes the few seats that are left by quotients.
    """
    total = sum(weights)
    if not seats or total <= 0:
        return [0] * len(weights)
    got = [math.floor(w * seats / total + 0.5) for w in weights]
    missing = seats - sum(got)
    if missing > 0:
        heap = [(-w / (2 * g + 1), i) for i, (w, g) in enumerate(zip(weights, got))]
        heapq.heapify(heap)
        for _ in range(missing):
            i = heap[0][1]
            got[i] += 1
            heapq.heapreplace(heap, (-weights[i] / (2 * got[i] + 1), i))
    elif missing < 0:
        heap = [(w / (2 * g - 1), -i) for i, (w, g) in enumerate(zip(weights, got)) if g]
        heapq.heapify(heap)
        for _ in range(-missing):
            i = -heap[0][1]
            got[i] -= 1
            if got[i]:
                heapq.heapreplace(heap, (weights[i] / (2 * got[i] - 1), -i))
            else:
                heapq.heappop(heap)
    return got


def targets(sizes: list[int], s: Settings = Settings()) -> list[float]:
    """Targets of sources in their order: by weight, at most ``most`` times a source's size; what
    that cuts off is shared again by weight."""
    weights = [s.weights[i % len(s.weights)] for i in range(len(sizes))]
    caps = [s.most * n for n in sizes]
    left, free, found = s.share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while free:
        unit = left / sum(weights[i] for i in free)
        full = [i for i in free if weights[i] * unit > caps[i]]
        if not full:
            for i in free:
                found[i] = weights[i] * unit
            break
        for i in sorted(full):
            found[i] = caps[i]
            left -= caps[i]
            free.remove(i)
    return found


def _coprime(n: int, seed: int) -> int:
    """A stride near the golden section of n, without a common factor."""
    step = max(1, int(n * 0.6180339887) + seed % 7)
    while math.gcd(step, n) != 1:
        step += 1
    return step


def placed(rows: DataFrame, text: Column, s: Settings = Settings(), carry: bool = False) -> DataFrame:
    """Where the mix cuts each row (columns with ``_``), with ``size``, ``source_size``, ``target``.

    ``rows`` has doc_id, source and what ``text`` reads; its other columns stay with ``carry``. One
    number for each source reaches the driver; null is a source like any other, the last one. Rows
    of null, empty or blank texts have no words and are not taken. Equal rows have places of their
    own in an order that may swap them.
    """
    spark = rows.sparkSession
    small = materialize(rows.select("doc_id", "source", n_words(text).alias("_size")))
    sums = [(r["source"], r["n"]) for r in small.groupBy("source").agg(F.sum("_size").alias("n")).collect()]
    sums.sort(key=lambda x: (x[0] is None, x[0] or ""))
    sizes = [n for _, n in sums]
    wanted = targets(sizes, s)
    seats = sainte_lague(wanted, round(sum(wanted) / s.block))
    shards = [max(1, round(n / s.shard)) for n in sizes]
    plan = [(k, name, n, t, q, c) for k, ((name, n), t, q, c) in enumerate(zip(sums, wanted, seats, shards))]
    kinds = "_source int, _name string, source_size long, target double, _seats long, _shards int"
    known = spark.createDataFrame(plan, kinds)

    def dealt(frame: DataFrame) -> DataFrame:
        joined = frame.join(F.broadcast(known), F.col("source").eqNullSafe(F.col("_name")))
        mixed = joined.withColumn("_order", F.xxhash64(F.lit(s.seed), "doc_id"))
        return mixed.withColumn("_shard", F.pmod(F.xxhash64("_order"), F.col("_shards")))

    def quotas(group: pa.Table) -> pa.Table:
        group = group.sort_by("_shard")
        words = group["_words"].to_pylist()
        out = []
        for shard, n, q in zip(group["_shard"].to_pylist(), words, sainte_lague(words, group["_seats"][0].as_py())):
            count = max(1, -(-n // s.block))
            q = min(q, int(s.most) * count)
            first = (s.seed * 7919 + shard * 104729) % count
            out.append((group["_source"][0].as_py(), shard, count, q // count, q % count, _coprime(count, s.seed + shard), first))
        names = ["_source", "_shard", "_blocks", "_rounds", "_rest", "_stride", "_first"]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), [pa.int32(), *[pa.int64()] * 6])], names)

    shares = dealt(small).groupBy("_source", "_shard", "_seats").agg(F.sum("_size").alias("_words"))
    kinds = "_source int, _shard long, _blocks long, _rounds long, _rest long, _stride long, _first long"
    selected = materialize(shares.groupBy("_source").applyInArrow(quotas, kinds))
    ahead = Window.partitionBy("_source", "_shard").orderBy("_order", "doc_id", "_size").rowsBetween(Window.unboundedPreceding, 0)
    laid = dealt(rows.withColumn("_size", n_words(text)) if carry else small)
    laid = laid.withColumn("_start", F.sum("_size").over(ahead) - F.col("_size"))
    return laid.join(selected, ["_source", "_shard"]).withColumnRenamed("_size", "size")


def _times(block: Column) -> Column:
    """How often the mix takes a block."""
    turn = F.pmod(block * F.col("_stride") + F.col("_first"), F.col("_blocks"))
    return F.col("_rounds") + F.when(turn < F.col("_rest"), 1).otherwise(0)


def taken(s: Settings = Settings()) -> Column:
    """Words of a placed row that the mix takes, repeats counted."""
    start, stop, b = F.col("_start"), F.col("_start") + F.col("size"), s.block
    blocks = F.sequence(F.floor(start / b), F.floor((stop - 1) / b))
    words = F.transform(blocks, lambda j: (F.least(stop, (j + 1) * b) - F.greatest(start, j * b)) * _times(j))
    return F.when(F.col("size") > 0, F.aggregate(words, F.lit(0).cast("long"), lambda x, y: x + y)).otherwise(F.lit(0)).cast("long")


def mixed_documents(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The mix as documents: each row once for every round that takes words of it, cut to the words
    taken; ``n_chars``, if there is one, follows. Rows of which nothing is taken go."""
    text, copy = F.col("_row.text"), F.col("_copy")
    own = docs.select("doc_id", "source", F.struct([F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    laid = placed(own, text, s, carry=True)
    words = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    chosen = F.filter(words, lambda w, i: _times(F.floor((F.col("_start") + i) / s.block)) >= copy)
    copies = laid.where(taken(s) > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(int(s.most)))))
    cut = copies.withColumn("_chosen", F.when(F.col("_rounds") < copy, chosen))
    whole = F.col("_chosen").isNull() | (F.size("_chosen") == F.col("size"))
    cut = cut.withColumn("_text", F.when(whole, text).otherwise(F.array_join("_chosen", "")))
    new = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    out = cut.where(F.length("_text") > 0)
    return out.select([new.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns])


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    laid = placed(table(spark, sf_dir, "documents"), F.col("text"))
    return laid.select("doc_id", "size", "source_size", "target", taken().alias("taken"))

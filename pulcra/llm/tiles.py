"""Candidate cells cut into tiles of bounded size, and the links inside a tile.

``home`` has one row per item and cell, ``probe`` one row for each cell where an item looks for
partners. A cell with many rows is cut into blocks of both sides; every pair of blocks is a tile of
its own, so no task meets a whole large cell.
"""

from __future__ import annotations


import numpy as np
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from pulcra.operators.lookup import materialize

TILE = ["_cell", "_home", "_probe"]


def tiles(home: DataFrame, probe: DataFrame, block: int) -> PandasCogroupedOps:
    """Both sides, each with ``_cell`` and ``node``, cogrouped by tile."""
    count = lambda rows, name: rows.groupBy("_cell").agg(F.count(F.lit(1)).alias(name))
    sizes = count(home, "_nh").join(count(probe, "_np"), "_cell").where((F.col("_nh") > block) | (F.col("_np") > block))
    blocks = sizes.select("_cell", F.ceil(F.col("_nh") / block).alias("_hb"), F.ceil(F.col("_np") / block).alias("_pb"))

    def dealt(rows: DataFrame, own: str, other: str, own_n: str, other_n: str) -> DataFrame:
        known = rows.join(blocks, "_cell", "left")
        mine = F.pmod(F.xxhash64("node"), F.coalesce(own_n, F.lit(1)))
        theirs = F.sequence(F.lit(0), F.coalesce(other_n, F.lit(1)).cast("int") - 1)
        return known.withColumn(own, mine.cast("int")).withColumn(other, F.explode(theirs)).drop("_hb", "_pb")

    left = dealt(home, "_home", "_probe", "_hb", "_pb")
    right = dealt(probe, "_probe", "_home", "_pb", "_hb")
    return left.groupBy(*TILE).cogroup(right.groupBy(*TILE))


def self_tiles(rows: DataFrame, cells: DataFrame, block: int) -> GroupedData:
    """``rows`` grouped by tile, to be compared with each other; ``cells`` has their ``_cell`` alone.

    A tile holds the rows of two blocks of a cell, or of one; ``_own`` is the block of a row,
    ``_home`` and ``_probe`` are the tile's. Each pair of rows of a cell meets in one tile.
    """
    sizes = cells.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_blocks"))
    # Written first: the few large cells are then known to be few, and rows stay where they are.
    known = rows.join(materialize(sizes.where("_blocks > 1")), "_cell", "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    dealt = known.withColumn("_own", F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).drop("_blocks")
    placed = dealt.withColumn("_home", F.least("_own", "_other")).withColumn("_probe", F.greatest("_own", "_other"))
    return placed.drop("_other").groupBy(*TILE)


def smallest_reachable(home: np.ndarray, probe: np.ndarray, pairs: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For the nodes of both sides the smallest node they reach through the pairs (home, probe)."""
    i, j = pairs
    by_probe = np.argsort(j, kind="stable")
    sides = []
    for rows, partners in ((i, j), (j[by_probe], i[by_probe])):
        starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]]) if len(rows) else np.empty(0, int)
        sides.append((rows[starts], starts, partners))
    low_home, low_probe = home.copy(), probe.copy()
    while len(i):
        before = (low_home.copy(), low_probe.copy())
        for own, other, (rows, starts, partners) in ((low_home, low_probe, sides[0]), (low_probe, low_home, sides[1])):
            own[rows] = np.minimum(own[rows], np.minimum.reduceat(other[partners], starts))
        if (before[0] == low_home).all() and (before[1] == low_probe).all():
            break
    return low_home, low_probe



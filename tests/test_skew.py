"""Key resolution, orphans and lookups against brute force where one key holds a third of all rows."""

import io
from collections import defaultdict
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from pulcra.config import JoinLimits
from pulcra.operators.integrity import mark_orphans
from pulcra.operators.keys import resolve_pk_duplicates
from pulcra.operators.keysets import key_words, mark_members, set_totals, small_set
from pulcra.operators.lookup import BUCKETS, broadcast_size, hot_buckets, lookup_join
from pulcra.operators.numbering import number_rows

SHUFFLED = JoinLimits(broadcast_bytes=0, hot_rows=50)
LIMITS = pytest.mark.parametrize("limits", [JoinLimits(), SHUFFLED], ids=["broadcast", "hot and cold"])


def skewed_rows():
    rows = []
    for i in range(1200):
        if i % 3 == 0:
            key, value = "hot", "same"
        elif i % 3 == 1:
            key, value = (None if i % 2 else "  "), "x"
        else:
            key, value = f"k{i % 40}", "a" if i % 40 < 20 else str(i % 7)
        rows.append((i, key, value))
    return rows


def brute_force(rows):
    groups = defaultdict(list)
    for i, key, value in rows:
        if key and key.strip():
            groups[key].append((i, value))
    fate = {}
    for i, key, value in rows:
        if not key or not key.strip():
            fate[i] = "R_PK_MISSING"
        elif len({v for _, v in groups[key]}) > 1:
            fate[i] = "R_DUP_PK_CONFLICT"
        else:
            fate[i] = None if i == min(groups[key])[0] else "R_DUP_PK_EXACT"
    return fate


@LIMITS
def test_duplicates(spark, limits):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "source_row_id long, id string, v string").repartition(5)
    out = resolve_pk_duplicates(df, pk="id", compare=["v"], limits=limits)
    assert out.columns == ["source_row_id", "id", "v", "drop_rule"]
    found = {r["source_row_id"]: r["drop_rule"] for r in out.collect()}
    assert found == brute_force(rows) and out.count() == len(rows)


@LIMITS
def test_hot_conflict(spark, limits):
    rows = [(i, "hot" if i % 3 else f"k{i}", str(i)) for i in range(600)]
    df = spark.createDataFrame(rows, "source_row_id long, id string, v string")
    out = resolve_pk_duplicates(df, pk="id", compare=["v"], limits=limits)
    assert {r["source_row_id"]: r["drop_rule"] for r in out.collect()} == brute_force(rows)


@LIMITS
def test_orphans(spark, limits):
    children = [(i, None if i % 10 == 0 else 7 if i % 3 == 0 else i % 90) for i in range(1000)]
    parents = [(p,) for p in range(0, 90, 2)] * 2 + [(None,)]
    child = spark.createDataFrame(children, "source_row_id long, fk long")
    parent = spark.createDataFrame(parents, "pk long")
    out = mark_orphans(child, "fk", parent, "pk", limits=limits)
    known = {p for (p,) in parents if p is not None}
    assert {r["source_row_id"]: r["is_orphan"] for r in out.collect()} == {i: fk not in known for i, fk in children}


def test_key_sets(spark):
    """Sets of whole numbers against Python's, with far, near, negative, repeated and missing keys."""
    keys = [0, 1, 63, 64, 65, -1, -64, -65, 2**63 - 1, -(2**63), 7, 7, 7, None, None, *range(500, 900)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    words = key_words(df, "k")
    given = [k for k in keys if k is not None]
    assert tuple(set_totals(words).first()) == (len(set(given)), len(set(given)) + 1, len(keys))
    assert tuple(set_totals(key_words(df.limit(0), "k")).first()) == (0, 0, 0)
    probes = [*range(-200, 1000), 2**63 - 1, -(2**63), 2**62, None]
    rows = spark.createDataFrame([(k, 1) for k in probes], "k long, word int")
    found = mark_members(rows, "k", small_set(words), "known")
    assert found.columns == ["k", "word", "known"]
    assert {r["k"]: r["known"] for r in found.collect()} == {k: k in set(given) for k in probes}
    assert small_set(words, JoinLimits(broadcast_bytes=100)) is None
    dense = spark.range(64_000).withColumnRenamed("id", "k")
    assert key_words(dense, "k").count() == 1000


def test_known_children_are_not_shuffled(spark, tmp_path):
    spark.range(5000).selectExpr("id AS source_row_id", "id % 700 AS fk").write.parquet(str(tmp_path / "c"))
    child = spark.read.parquet(str(tmp_path / "c"))
    out = mark_orphans(child, "fk", spark.range(600).withColumnRenamed("id", "pk"), "pk")
    text = io.StringIO()
    with redirect_stdout(text):
        out.explain()
    assert "hashpartitioning" not in text.getvalue() and out.where("is_orphan").count() == sum(i % 700 >= 600 for i in range(5000))


def test_hot_keys_are_spread(spark):
    """In the shuffled join no task gets the hot key's rows alone."""
    rows = spark.range(4000).select(
        F.col("id").alias("source_row_id"), F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("key")
    )
    lookup = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.lit(1).alias("found"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lookup_join(
            rows, lookup, key=F.col("key"), lookup_key="key", weight="n", row_id=F.col("source_row_id"),
            limits=JoinLimits(broadcast_bytes=0, hot_rows=100),
        )
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert out.where("found = 1").count() == 4000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 4000 and max(sizes) < 1500


def test_many_hot_keys(spark):
    """The hot part is above the broadcast limit too; every row meets its key once and no plan
    broadcasts the lookup."""
    rows = spark.range(6000).select(
        F.col("id").alias("source_row_id"), F.when(F.col("id") % 11 > 0, F.concat(F.lit("key"), F.col("id") % 40)).alias("key")
    )
    lookup = rows.where("key IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.concat(F.lit("of "), "key").alias("found"))
    limits = JoinLimits(broadcast_bytes=0, hot_rows=10)
    out = lookup_join(rows, lookup, key=F.col("key"), lookup_key="key", weight="n", row_id=F.col("source_row_id"), limits=limits)
    assert out.columns == ["source_row_id", "key", "found"]
    got = out.collect()
    assert len(got) == 6000 and len({r["source_row_id"] for r in got}) == 6000
    assert all(r["found"] == (None if r["key"] is None else f"of {r['key']}") for r in got)
    text = io.StringIO()
    with redirect_stdout(text):
        out.explain()
    sides = [line for line in text.getvalue().splitlines() if "BroadcastExchange" in line or "SortMergeJoin" in line]
    # Both broadcasts are the table of slots, two integers a bucket.
    assert any("SortMergeJoin [_key" in s for s in sides)
    assert all("input[0, int" in s for s in sides if "BroadcastExchange" in s)


def test_slots_are_bounded(spark):
    """However many keys are hot, the table of slots has at most one row a bucket."""
    table = spark.range(100_000).select(F.col("id").alias("_key"), F.lit(50).alias("n"))
    found = hot_buckets(table, "n", JoinLimits(hot_rows=10))
    assert found.columns == ["_bucket", "_slots"] and found.count() <= BUCKETS
    assert found.select(F.max("_slots")).first()[0] == 20


def test_size_counts_texts_and_arrays(spark):
    table = spark.createDataFrame([("x" * 1000, [1] * 500, 1)], "k string, a array<long>, n long")
    assert broadcast_size(table) > 1000 + 500 * 8
    assert broadcast_size(table.limit(0)) == 0


def test_numbering(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    out = number_rows(df, ["v"], "n", start=0)
    assert all(r["v"] == r["n"] for r in out.collect())
    assert number_rows(df.limit(0), ["v"], "n").count() == 0

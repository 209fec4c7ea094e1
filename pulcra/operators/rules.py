"""Audit rules: each violated rule of a row becomes one issue record.

Rows carry an array of short records (rule id and the two values). Texts that a rule always
writes are added when the array is exploded, so they are neither shuffled nor stored per row.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulcra.catalogs import ISSUE_ORDER, ROW_ID, Rule
from pulcra.config import Settings
from pulcra.functions.literals import lookup_constant, sql_literal

ISSUE_COLUMNS = [
    "table", "row_id", "rule_id", "severity", "column", "original_value", "clean_value", "detail",
]
_RECORD = "struct<rule_id:string,original_value:string,clean_value:string>"
_NO_ROW = -(1 << 63)


@dataclass(frozen=True)
class Violation:
    """A rule, the SQL condition under which a row violates it, and the values to record."""

    rule: Rule
    when: str
    original: str = "NULL"
    clean: str = "NULL"

    def sql(self) -> str:
        return (
            f"CASE WHEN {self.when} THEN named_struct("
            f"'rule_id', {sql_literal(self.rule.rule_id)}, "
            f"'original_value', CAST({self.original} AS STRING), "
            f"'clean_value', CAST({self.clean} AS STRING)) END"
        )


def violated(violations: Iterable[Violation], only: Collection[str] | None = None) -> Column:
    """Array with one entry per rule: its record where the condition holds, else null.

    Rules outside ``only`` are not evaluated at all.
    """
    chosen = [v.sql() for v in violations if only is None or v.rule.rule_id in only]
    return F.expr(f"CAST(array({', '.join(chosen)}) AS array<{_RECORD}>)")


def without_empty(df: DataFrame, rules: int) -> DataFrame:
    """Rows whose ``_issues`` hold no record get an empty array, which takes no room when written; the
    places in the others stay."""
    ids = [F.get("_issues", F.lit(k))["rule_id"] for k in range(rules)]
    empty = F.expr(f"CAST(array() AS array<{_RECORD}>)")
    return df.withColumn("_issues", F.when(F.coalesce(*ids).isNotNull(), F.col("_issues")).otherwise(empty))


def with_rule_texts(
    records: DataFrame, table: str, key_column: str, settings: Settings, keep: Collection[str] = ()
) -> DataFrame:
    """Issue rows from ``row_id, rule_id, original_value, clean_value``."""
    rules = [rule for owner, rule in ISSUE_ORDER if owner == table]
    values = {
        "tolerance": settings.age_tolerance_years,
        "low": settings.phone_min_digits,
        "high": settings.phone_max_digits,
        "reference_date": settings.reference_date,
    }
    fixed = {
        "severity": {r.rule_id: r.severity for r in rules},
        "column": {r.rule_id: r.column or key_column for r in rules},
        "detail": {r.rule_id: r.detail.format(**values) for r in rules},
    }
    texts = {name: lookup_constant(by_rule, F.col("rule_id")) for name, by_rule in fixed.items()}
    return records.withColumns({"table": F.lit(table), **texts}).select(*ISSUE_COLUMNS, *keep)


def explode_issues(
    df: DataFrame,
    table: str,
    key_column: str,
    settings: Settings = Settings(),
    records: Column | str = "_issues",
) -> DataFrame:
    """One issue row per record of the rows' arrays.

    Nulls are dropped here and not where the array is built: for a bare array column Spark infers
    a size filter and pushes a second copy of all rules below the cleaning steps.
    """
    long = df.select(
        F.col(ROW_ID).cast("string").alias("row_id"), F.inline(F.array_compact(records))
    )
    return with_rule_texts(long, table, key_column, settings)


def issue_rows(
    df: DataFrame,
    rule: Rule,
    table: str,
    key_column: str,
    *,
    original: str = "NULL",
    row_id: str = ROW_ID,
    settings: Settings = Settings(),
) -> DataFrame:
    """One issue of the rule for every row given."""
    records = df.selectExpr(
        f"CAST({row_id} AS STRING) AS row_id",
        f"{sql_literal(rule.rule_id)} AS rule_id",
        f"CAST({original} AS STRING) AS original_value",
        "CAST(NULL AS STRING) AS clean_value",
    )
    return with_rule_texts(records, table, key_column, settings)


def trail_measures(records: list[Column], row_id: str = ROW_ID) -> dict[str, Column]:
    """Aggregates over rows: for each record column how many rows have one, and the least row of
    them; rows without a number come first.

    A record column belongs to one rule; so there are two values a rule, whatever the rows. Both are
    whole numbers; :func:`first_records` then looks at those few rows.
    """
    measures = {}
    row = F.coalesce(F.col(row_id).cast("bigint"), F.lit(_NO_ROW))
    for k, record in enumerate(records):
        measures[f"issues_{k}"] = F.count(record)
        measures[f"row_{k}"] = F.min(F.when(record.isNotNull(), row))
    return measures


def first_records(table: DataFrame, records: list[Column], seen: Mapping[str, Any], row_id: str = ROW_ID) -> dict[str, Any]:
    """``seen``, the values of :func:`trail_measures` of a written table, with the first ``(row,
    record)`` of each record column."""
    found = {k: seen[f"row_{k}"] for k in range(len(records)) if seen[f"issues_{k}"]}
    if not found:
        return dict(seen)
    row = F.col(row_id).cast("bigint")
    chosen = row.isin(sorted(set(found.values())))
    if _NO_ROW in found.values():
        chosen = chosen | row.isNull()
    firsts = []
    for k in found:
        first = F.struct(row.alias("row"), records[k].alias("record"))
        firsts.append(F.min(F.when(records[k].isNotNull(), first)).alias(f"first_{k}"))
    return {**seen, **table.where(chosen).agg(*firsts).first().asDict()}


def seen_totals(seen: Mapping[str, Any], table: str) -> list[tuple]:
    """``(table, rule_id, row, original_value, clean_value, count)`` of the values that
    :func:`first_records` gave, for rules with an issue."""
    found = []
    for name, count in seen.items():
        if name.startswith("issues_") and count:
            row, record = seen[name.replace("issues_", "first_")]
            found.append((table, record["rule_id"], row, record["original_value"], record["clean_value"], count))
    return found


TOTALS = "table string, rule_id string, row bigint, original_value string, clean_value string, count bigint"


def trail_totals(
    spark: SparkSession, found: list[tuple], key_columns: Mapping[str, str], settings: Settings = Settings()
) -> DataFrame:
    """The audit trail cut down to the first issue of each table and rule, with ``count``.

    The roll-ups take it in place of the trail. ``found`` is the few rows of :func:`seen_totals`;
    an issue of a whole table has no row.
    """
    parts = []
    for table, key_column in key_columns.items():
        few = spark.createDataFrame([f for f in found if f[0] == table], TOTALS)
        few = few.withColumn("row_id", F.coalesce(F.col("row").cast("string"), F.lit("TABLE")))
        parts.append(with_rule_texts(few, table, key_column, settings, keep=["count"]))
    return reduce(DataFrame.unionByName, parts)


def with_issue_order(issues: DataFrame) -> DataFrame:
    """Add ``issue_order``: table and rule stage, then input position within the stage."""
    stages = {f"{table}|{rule.rule_id}": n for n, (table, rule) in enumerate(ISSUE_ORDER, 1)}
    stage = lookup_constant(stages, F.concat_ws("|", "table", "rule_id"))
    return issues.withColumn(
        "issue_order",
        F.struct(stage.alias("stage"), F.col("row_id").try_cast("bigint").alias("row")),
    )

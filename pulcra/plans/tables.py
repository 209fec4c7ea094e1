"""What the two cleaners share."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulcra.catalogs import ROW_ID, Rule
from pulcra.functions.literals import lookup_constant
from pulcra.operators.numbering import number_rows
from pulcra.operators.rules import Violation, trail_measures, violated


class Cleaned(NamedTuple):
    clean: DataFrame
    rejected: DataFrame
    issues: DataFrame


def with_row_id(df: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """Make sure of ``source_row_id``; without it the caller names columns that order the rows.

    Rows in a distributed table have no position of their own, and which duplicate survives must
    not depend on the layout of files.
    """
    if ROW_ID in df.columns:
        return df
    if not order_by:
        raise ValueError(f"the table has no {ROW_ID}; name columns that order its rows uniquely")
    return number_rows(df, order_by, ROW_ID, start=0)


def resolved_records(rules: int, of_keys: list[Violation]) -> list[Column]:
    """The records of a resolved table whose ``_issues`` have so many entries, one column a rule."""
    keys = violated(of_keys)
    records = [F.get("_issues", F.lit(k)) for k in range(rules)]
    return records + [F.get(keys, F.lit(k)) for k in range(len(of_keys))]


def resolved_measures(records: list[Column], rejects: list[Rule]) -> dict[str, Column]:
    """Aggregates of a resolved table: its rows, those to keep, those to reject, and its issues by rule."""
    rejected = F.col("drop_rule").isin([rule.rule_id for rule in rejects])
    return {
        "rows": F.count(F.lit(1)),
        "kept": F.count(F.when(F.col("drop_rule").isNull(), 1)),
        "rejected": F.count(F.when(rejected, 1)),
        **trail_measures(records),
    }


def rejection_reason(rule_id: Column, rules: list[Rule]) -> Column:
    return lookup_constant({rule.rule_id: rule.reason for rule in rules}, rule_id)

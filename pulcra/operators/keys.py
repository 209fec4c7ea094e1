"""Primary-key resolution: missing keys, conflicting duplicates, exact duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulcra.catalogs import KEY_CONFLICT, KEY_EXACT, KEY_MISSING, ROW_ID, Rule
from pulcra.config import JoinLimits
from pulcra.functions import row_fingerprint, strip
from pulcra.operators.lookup import lookup_join
from pulcra.operators.rules import Violation


def key_missing(pk: str) -> Column:
    return F.col(pk).isNull() | (strip(F.col(pk).cast("string")) == "")


def duplicate_groups(
    rows: DataFrame,
    pk: str,
    compare: list[str],
    row_id: str = ROW_ID,
    counted: Column | None = None,
) -> DataFrame:
    """One row per key that occurs more than once: size, first row, whether its rows differ.

    Every aggregate is fixed-width and combines before the shuffle, so a key that holds a large
    part of the table leaves each task as one record. Rows outside ``counted`` are left out by
    the aggregates and not by a filter, which Spark would push below the cleaning steps and
    thereby compute these twice.
    """
    counted = F.col(pk).isNotNull() if counted is None else counted
    first, second = row_fingerprint(compare)
    kept = {"_row": F.col(row_id), "_first": first, "_second": second}
    marked = rows.select("*", counted.alias("_in"))
    return (
        marked.select(pk, *[F.when(F.col("_in"), value).alias(name) for name, value in kept.items()])
        .groupBy(pk)
        .agg(
            F.count("_row").alias("_copies"),
            F.min("_row").alias("_keeper"),
            (
                (F.min("_first") != F.max("_first")) | (F.min("_second") != F.max("_second"))
            ).alias("_differs"),
        )
        .where("_copies > 1")
    )


def resolve_pk_duplicates(
    rows: DataFrame,
    *,
    pk: str,
    compare: list[str],
    row_id: str = ROW_ID,
    allow_missing: bool = True,
    earlier: str | None = None,
    limits: JoinLimits = JoinLimits(),
) -> DataFrame:
    """Add ``drop_rule``: null for rows to keep, else the id of the rule that drops the row.

    A missing or blank key is a rule of its own when ``allow_missing``; otherwise keys are taken
    as given. Keys whose rows differ in ``compare`` lose all rows; of equal rows the one with the
    smallest ``row_id`` (a unique input position) stays. ``earlier`` names a column with a rule
    that has already dropped the row; such rows take no part in the comparison.

    Only duplicated keys are joined back. They are few in most tables, and then the table itself
    is never shuffled; see ``lookup_join`` for the rest.
    """
    if pk not in rows.columns:
        raise ValueError(f"key column {pk!r} is not in the table")
    eligible = F.lit(True) if earlier is None else F.col(earlier).isNull()
    missing = key_missing(pk) if allow_missing else F.lit(False)
    counted = eligible & ~missing & F.col(pk).isNotNull()
    marked = lookup_join(
        rows,
        duplicate_groups(rows, pk, compare, row_id, counted),
        key=F.when(counted, F.col(pk)),
        lookup_key=pk,
        weight="_copies",
        row_id=F.col(row_id),
        limits=limits,
    )
    rule = (
        F.when(eligible & missing, KEY_MISSING.rule_id)
        .when(F.col("_differs"), KEY_CONFLICT.rule_id)
        .when(F.col("_keeper") != F.col(row_id), KEY_EXACT.rule_id)
    )
    if earlier is not None:
        rule = F.coalesce(F.col(earlier), rule)
    return marked.withColumn("drop_rule", rule).drop("_keeper", "_differs", *([earlier] if earlier else []))


def key_violations(pk: str, rules: list[Rule]) -> list[Violation]:
    """Violations of the key rules, for rows that carry ``drop_rule``."""
    return [Violation(rule, f"drop_rule = '{rule.rule_id}'", original=pk) for rule in rules]

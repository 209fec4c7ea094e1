"""Foreign keys: counting, orphan splitting, checks after cleaning."""

from __future__ import annotations

from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulcra.catalogs import (
    CHILD_KEY,
    CHILD_TABLE,
    KEY_DUP_AFTER,
    ORPHAN,
    PARENT_KEY,
    ROW_ID,
    STATUS_CATALOG,
    STATUS_REMAINING,
)
from pulcra.config import JoinLimits
from pulcra.operators.keysets import is_whole, key_words, mark_members, small_set
from pulcra.operators.lookup import lookup_join, write_observed
from pulcra.operators.rules import Violation, first_records, issue_rows, trail_measures, violated


def foreign_key_counts(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """One row per non-null foreign key: ``fk, n, known``.

    Children are counted per key before the join, so both sides have one row per key and a key
    that most children share is no larger than any other.
    """
    counts = child.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("fk")).agg(
        F.count(F.lit(1)).alias("n")
    )
    keys = parent.where(F.col(pk).isNotNull()).select(F.col(pk).alias("fk")).distinct()
    return counts.join(keys.withColumn("known", F.lit(True)), "fk", "left").select(
        "fk", "n", F.coalesce("known", F.lit(False)).alias("known")
    )


def mark_by_set(
    child: DataFrame, fk: str, parent: DataFrame, pk: str, limits: JoinLimits = JoinLimits()
) -> DataFrame | None:
    """As :func:`mark_orphans`, in a pass over the children without a shuffle; nothing if the parents'
    keys are no set of bits that may be broadcast."""
    if not (is_whole(child, fk) and is_whole(parent, pk)):
        return None
    known = small_set(key_words(parent, pk), limits)
    if known is None:
        return None
    return mark_members(child, fk, known, "_member").withColumn("is_orphan", ~F.col("_member")).drop("_member")


def mark_orphans(
    child: DataFrame,
    fk: str,
    parent: DataFrame,
    pk: str,
    *,
    row_id: str = ROW_ID,
    limits: JoinLimits = JoinLimits(),
) -> DataFrame:
    """Add ``is_orphan``: the foreign key is null or no parent has it.

    Whole-number keys of the parents make a set of bits. As long as that may be broadcast, children
    are read once and not shuffled. For other keys, and larger sets, the children's keys are counted
    first and only the unknown ones are looked up.
    """
    marked = mark_by_set(child, fk, parent, pk, limits)
    if marked is not None:
        return marked
    unknown = (
        foreign_key_counts(child, fk, parent, pk)
        .where(~F.col("known"))
        .select("fk", "n", F.lit(True).alias("_unknown"))
    )
    marked = lookup_join(
        child,
        unknown,
        key=F.col(fk),
        lookup_key="fk",
        weight="n",
        row_id=F.col(row_id),
        limits=limits,
    )
    return marked.withColumn(
        "is_orphan", F.col(fk).isNull() | F.col("_unknown").isNotNull()
    ).drop("_unknown")


def foreign_key_totals(
    child: DataFrame, fk: str, parent: DataFrame, pk: str, limits: JoinLimits = JoinLimits()
) -> DataFrame:
    """One row: ``valid`` children, whose parent exists, of those ``given`` a foreign key."""
    if is_whole(child, fk) and is_whole(parent, pk):
        known = small_set(key_words(parent, pk), limits)
        if known is not None:
            marked = mark_members(child.select(fk), fk, known, "_member")
            return marked.agg(F.count(F.when(F.col("_member"), 1)).alias("valid"), F.count(fk).alias("given"))
    return foreign_key_counts(child, fk, parent, pk).agg(
        F.coalesce(F.sum(F.when(F.col("known"), F.col("n"))), F.lit(0)).alias("valid"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("given"),
    )


def foreign_key_integrity(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """One row: children with a foreign key, those whose parent exists, and their share."""
    return foreign_key_totals(child, fk, parent, pk).select(
        F.col("valid").alias("fk_valid_pair_count"),
        F.col("given").alias("fk_non_null_count"),
        F.try_divide("valid", "given").alias("fk_valid_pct_among_non_null"),
    )


class CrossCheck(NamedTuple):
    """Children by verdict. ``seen`` holds what writing them has counted: ``valid``, ``orphans`` and
    the values of :func:`first_records` for the issues."""

    valid: DataFrame
    rejected: DataFrame
    issues: DataFrame
    seen: dict[str, Any]


# Verdicts on a child.
VALID, ODD_STATUS, ORPHANED = "valid", "odd_status", "orphan"
VERDICT = "_verdict"


def _status_unknown() -> Column:
    return F.col("estado_cita").isNotNull() & ~F.col("estado_cita").isin(list(STATUS_CATALOG.values()))


def remaining_status_issues(valid: DataFrame) -> DataFrame:
    return issue_rows(
        valid.where(_status_unknown()), STATUS_REMAINING, CHILD_TABLE, CHILD_KEY, original="estado_cita"
    )


def repeated_key_issue(valid: DataFrame, pk: str = CHILD_KEY) -> DataFrame:
    """At most one issue for the whole table: some key still occurs twice."""
    repeated = valid.groupBy(pk).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1)
    return issue_rows(repeated, KEY_DUP_AFTER, CHILD_TABLE, pk, row_id="'TABLE'")


def _has_repeated_key(valid: DataFrame, pk: str = CHILD_KEY) -> bool:
    """Whether some rows may share a key: by a hash, which takes less room than the key."""
    prints = valid.groupBy(F.xxhash64(pk).alias("print")).agg(F.count(F.lit(1)).alias("n"))
    return bool(prints.where("n > 1").limit(1).collect())


def with_verdict(marked: DataFrame) -> DataFrame:
    """Children of :func:`mark_orphans` with their verdict instead."""
    odd = _status_unknown() if "estado_cita" in marked.columns else F.lit(False)
    verdict = F.when(F.col("is_orphan"), ORPHANED).when(odd, ODD_STATUS).otherwise(VALID)
    return marked.withColumn(VERDICT, verdict).drop("is_orphan")


def verdict_records(columns: list[str]) -> list[Column]:
    """The issue records of judged children, one column a rule."""
    of = [Violation(ORPHAN, f"{VERDICT} = '{ORPHANED}'", original=PARENT_KEY)]
    if "estado_cita" in columns:
        of.append(Violation(STATUS_REMAINING, f"{VERDICT} = '{ODD_STATUS}'", original="estado_cita"))
    return [F.get(violated(of), F.lit(k)) for k in range(len(of))]


def verdict_counts() -> dict[str, Column]:
    """Aggregates of judged children; rows without a verdict are none."""
    orphans = F.count(F.when(F.col(VERDICT) == ORPHANED, 1))
    return {"orphans": orphans, "valid": F.count(VERDICT) - orphans}


def validate_cross_references(
    parents: DataFrame, children: DataFrame, limits: JoinLimits = JoinLimits()
) -> CrossCheck:
    """Split children into valid ones and orphans, and check what cleaning has promised.

    The children are read once, or twice where the parents' keys are no small set. The judged rows
    are written once, in a folder per verdict; valid rows, rejects and issues read their folders alone.
    """
    marked = with_verdict(mark_orphans(children, PARENT_KEY, parents, PARENT_KEY, limits=limits))
    records = verdict_records(children.columns)
    checked, seen = write_observed(marked, {**verdict_counts(), **trail_measures(records)}, by=VERDICT)
    return judged_children(checked, first_records(checked, records, seen))


def judged_children(checked: DataFrame, seen: dict[str, Any]) -> CrossCheck:
    """The parts of a written table of children with verdicts."""
    children = checked.drop(VERDICT)

    def judged(*verdicts: str) -> DataFrame:
        return checked.where(F.col(VERDICT).isin(*verdicts)).drop(VERDICT)

    valid, orphaned = judged(VALID, ODD_STATUS), judged(ORPHANED)
    rejected = orphaned.withColumn("rejection_reason", F.lit(ORPHAN.reason)).withColumn(
        "rejection_rule_id", F.lit(ORPHAN.rule_id)
    )
    issues = issue_rows(orphaned, ORPHAN, CHILD_TABLE, CHILD_KEY, original=PARENT_KEY)
    if "estado_cita" in children.columns:
        odd_rows = issue_rows(
            judged(ODD_STATUS), STATUS_REMAINING, CHILD_TABLE, CHILD_KEY, original="estado_cita"
        )
        issues = issues.unionByName(odd_rows)
    if CHILD_KEY in children.columns:
        # At most one row, which is looked for once.
        found = repeated_key_issue(valid).collect() if _has_repeated_key(valid) else []
        issues = issues.unionByName(children.sparkSession.createDataFrame(found, issues.schema))
        seen = seen | {"repeated_key": len(found)}
    return CrossCheck(valid, rejected, issues, seen)

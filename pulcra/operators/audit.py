"""Roll-ups of the audit trail and of metrics for reports.

A trail has one row per issue. The totals that a run takes while it writes its tables, one row per
table and rule with a ``count``, give the same roll-ups without a look at the trail.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulcra.catalogs import (
    CHILD_TABLE,
    ISSUE_ORDER,
    PARENT_TABLE,
    REPORT_COMPLETENESS_COLUMNS,
    SEVERITY_RANK,
)
from pulcra.functions.literals import lookup_constant
from pulcra.operators.rules import ISSUE_COLUMNS, with_issue_order


_SEVERITY_NAMES = {rank: name for name, rank in SEVERITY_RANK.items()}


def _counted(issues: DataFrame) -> Column:
    """Issues of a trail, or of its totals, whose rows stand for ``count`` issues each."""
    n = F.sum("count") if "count" in issues.columns else F.count(F.lit(1))
    return n.alias("count")


def issues_by_severity(issues: DataFrame) -> DataFrame:
    return issues.groupBy("severity").agg(_counted(issues))


def issues_by_rule(issues: DataFrame) -> DataFrame:
    """``rule_id, count, severity``: the highest severity seen for the rule."""
    rank = lookup_constant(SEVERITY_RANK, F.col("severity"))
    name = lookup_constant(_SEVERITY_NAMES, F.col("_rank"))
    return (
        issues.groupBy("rule_id")
        .agg(_counted(issues), F.max(rank).alias("_rank"))
        .select("rule_id", "count", name.alias("severity"))
    )


def rejected_counts(parents: DataFrame, children: DataFrame) -> DataFrame:
    """``table, rejected_rows``."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("rejected_rows")).select(
            F.lit(table).alias("table"), "rejected_rows"
        )
        for table, df in ((PARENT_TABLE, parents), (CHILD_TABLE, children))
    ]
    return reduce(DataFrame.unionByName, counted)


def rule_totals(issues: DataFrame) -> DataFrame:
    """Per rule: count, place of its first issue in the audit trail, that issue, severity rank.

    Counts and the smallest place are of fixed width, so they are aggregated by hashing and combine
    before the shuffle; the texts of the few first issues, one per rule, are then looked up.
    """
    rank = lookup_constant(SEVERITY_RANK, F.col("severity"))
    order = F.col("issue_order")
    # Stage and row as one number: an issue without a row is the first of its stage.
    key = F.shiftleft(F.coalesce(order["stage"], F.lit(0)).cast("bigint"), 48) + F.coalesce(order["row"] + 1, F.lit(0))
    placed = with_issue_order(issues).withColumn("_place", key)
    totals = placed.groupBy("rule_id").agg(
        _counted(issues),
        F.max(rank).alias("severity_rank"),
        F.min("_place").alias("_first"),
    )
    # As many rows as there are rules, which are a fixed list.
    few = F.broadcast(totals.withColumnRenamed("rule_id", "_rule"))
    first = placed.drop("count").join(few, (F.col("rule_id") == F.col("_rule")) & (F.col("_place") == F.col("_first")))
    # Few rows are left: one per rule, or some that share a place.
    record = F.min(F.struct("issue_order", *ISSUE_COLUMNS)).alias("first_issue")
    return first.groupBy("rule_id", "count", "severity_rank").agg(record)


def top_rules(totals: DataFrame, k: int = 10) -> DataFrame:
    """The k rules with most issues, ties by first appearance, with ``rank``."""
    by_count = [F.desc("count"), F.asc("first_issue.issue_order")]
    # At most k rows leave the ordered limit.
    return _numbered(totals.orderBy(*by_count).limit(k), "rank", by_count)


def _numbered(few: DataFrame, name: str, order: list[Column]) -> DataFrame:
    """Number the rows of a result that holds one row per rule."""
    return few.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def evidence(totals: DataFrame, among: int = 8, k: int = 5) -> DataFrame:
    """First issue of each of the leading rules; the k earliest, in audit-trail order."""
    first = top_rules(totals, among).select("first_issue.*")
    early = first.orderBy("issue_order").limit(k)
    return _numbered(early, "place", [F.asc("issue_order")]).select("place", *ISSUE_COLUMNS)


def rule_impact(totals: DataFrame, k: int = 10) -> DataFrame:
    """Leading rules with table, column, action, severity and count.

    Table and column come from the rule's evidence; without one they show as ``?`` and ``-``.
    """
    actions = {rule.rule_id: rule.action for _, rule in ISSUE_ORDER}
    shown = evidence(totals).select("rule_id", "table", "column")
    return (
        top_rules(totals, k)
        .join(shown, "rule_id", "left")
        .select(
            "rank",
            "rule_id",
            F.coalesce("table", F.lit("?")).alias("table"),
            F.coalesce("column", F.lit("-")).alias("column"),
            F.coalesce(
                lookup_constant(actions, F.col("rule_id")), F.lit("Evento de auditoría")
            ).alias("action"),
            lookup_constant(_SEVERITY_NAMES, F.col("severity_rank")).alias("severity"),
            "count",
        )
    )


def completeness_delta(compared: DataFrame) -> DataFrame:
    """Change of completeness per key column in percentage points, in report order."""
    places = {f"{t}|{c}": i for i, (t, c) in enumerate(REPORT_COMPLETENESS_COLUMNS, 1)}
    place = lookup_constant(places, F.concat_ws("|", "table", "column"))
    return (
        compared.where("metric_name = 'completeness_pct' and before is not null and after is not null")
        .withColumn("place", place)
        .where("place is not null")
        .select(
            "place",
            "table",
            "column",
            (F.col("before") * 100).alias("before_pct"),
            (F.col("after") * 100).alias("after_pct"),
            ((F.col("after") - F.col("before")) * 100).alias("delta_pp"),
        )
    )

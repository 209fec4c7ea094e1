"""The whole run: profile, clean, validate, measure, export, load, summarise."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulcra.catalogs import (
    CHILD_EXPORT_COLUMNS,
    CHILD_KEY,
    CHILD_TABLE,
    KEY_DUP_AFTER,
    PARENT_EXPORT_COLUMNS,
    PARENT_KEY,
    PARENT_TABLE,
    ROW_ID,
    SEX_MISSING,
)
from pulcra.config import JoinLimits, Settings
from pulcra.operators import audit, metrics, profile
from pulcra.operators.integrity import (
    VERDICT,
    judged_children,
    mark_by_set,
    validate_cross_references,
    verdict_counts,
    verdict_records,
    with_verdict,
)
from pulcra.operators.lookup import materialize, work_tables, write_observed
from pulcra.operators.rules import first_records, seen_totals, trail_totals, without_empty
from pulcra.plans import appointments, patients
from pulcra.plans import star as star_schema
from pulcra.plans.appointments import (
    rejected_appointments,
    resolve_appointments,
    split_appointments,
)
from pulcra.plans.patients import resolve_patients, split_patients
from pulcra.plans.tables import resolved_measures, resolved_records
from pulcra.session import tune
from pulcra.sources import sinks
from pulcra.sources.readers import check_contract


class Outcome(NamedTuple):
    """Clean tables, rejects and the audit trail of both tables.

    ``totals`` has the first issue and the count of every table and rule, ``before``, ``after`` and
    ``rejected`` the rows per table; all were counted while the tables were written.
    """

    parents: DataFrame
    children: DataFrame
    parents_rejected: DataFrame
    children_rejected: DataFrame
    issues: DataFrame
    totals: DataFrame
    before: dict[str, int]
    after: dict[str, int]
    rejected: dict[str, int]


# What judging, counting and the audit trail read of a resolved table.
_JUDGED = (ROW_ID, PARENT_KEY, CHILD_KEY, "estado_cita", "_issues", "drop_rule")


def _with_values(resolved: DataFrame, values: Collection[str] | None) -> DataFrame:
    if values is None:
        return resolved
    return resolved.select([c for c in resolved.columns if c in _JUDGED or c in values])


def clean_tables(
    tables: Mapping[str, DataFrame],
    settings: Settings = Settings(),
    limits: JoinLimits = JoinLimits(),
    values: Collection[str] | None = None,
) -> Outcome:
    """Clean both tables and reject children without a clean parent.

    ``values`` names the clean values that the caller reads; all rows are cleaned, judged and counted,
    but other values (and raw ones, kept for rejects) are not written. Counts and totals need none.

    Each table is resolved once and written; clean rows, rejects and issues read that table, and
    what a run counts of them is counted in the same pass. Children are judged in it as well, as long
    as the parents' keys may be broadcast as bits; else their clean rows are judged and written again.
    """
    raw_parents, raw_children = tables[PARENT_TABLE], tables[CHILD_TABLE]
    spark = raw_parents.sparkSession
    rules = patients.issue_entries(raw_parents)
    records = resolved_records(rules, patients.KEY_VIOLATIONS)
    resolved_parents, seen_parents = write_observed(
        _with_values(without_empty(resolve_patients(raw_parents, settings, limits=limits), rules), values),
        resolved_measures(records, patients.REJECTS),
    )
    seen_parents = first_records(resolved_parents, records, seen_parents)
    sex_given = "sexo" in raw_parents.columns
    parents = split_patients(resolved_parents, settings, sex_given=sex_given)
    rules = appointments.issue_entries(raw_children)
    records = resolved_records(rules, appointments.KEY_VIOLATIONS)
    resolved = _with_values(without_empty(resolve_appointments(raw_children, settings, limits=limits), rules), values)
    marked = mark_by_set(resolved, PARENT_KEY, parents.clean, PARENT_KEY, limits)
    counts = {}
    if marked is not None:
        kept = F.col("drop_rule").isNull()
        resolved = with_verdict(marked).withColumn(VERDICT, F.when(kept, F.col(VERDICT)))
        records, counts = records + verdict_records(resolved.columns), verdict_counts()
    resolved, seen_children = write_observed(resolved, {**resolved_measures(records, appointments.REJECTS), **counts})
    seen_children = first_records(resolved, records, seen_children)
    children = split_appointments(resolved.drop(VERDICT) if marked is not None else resolved, settings)
    found = seen_totals(seen_parents, PARENT_TABLE) + seen_totals(seen_children, CHILD_TABLE)
    if marked is not None:
        judged = split_appointments(resolved, settings).clean
        checked = judged_children(judged, {name: seen_children[name] for name in counts})
    else:
        checked = validate_cross_references(parents.clean, children.clean, limits)
        found += seen_totals(checked.seen, CHILD_TABLE)

    if not sex_given:
        found.append((PARENT_TABLE, SEX_MISSING.rule_id, None, None, None, 1))
    if checked.seen.get("repeated_key"):
        found.append((CHILD_TABLE, KEY_DUP_AFTER.rule_id, None, None, None, 1))
    keys = {PARENT_TABLE: PARENT_KEY, CHILD_TABLE: CHILD_KEY}
    return Outcome(
        parents=parents.clean,
        children=checked.valid,
        parents_rejected=parents.rejected,
        children_rejected=rejected_appointments(children.rejected, checked.rejected),
        issues=parents.issues.unionByName(children.issues).unionByName(checked.issues),
        totals=trail_totals(spark, found, keys, settings),
        before={PARENT_TABLE: seen_parents["rows"], CHILD_TABLE: seen_children["rows"]},
        after={PARENT_TABLE: seen_parents["kept"], CHILD_TABLE: checked.seen["valid"]},
        rejected={
            PARENT_TABLE: seen_parents["rejected"],
            CHILD_TABLE: seen_children["rejected"] + checked.seen["orphans"],
        },
    )


def _section(df: DataFrame, section: str, name: str, value: str) -> DataFrame:
    return df.select(
        F.lit(section).alias("section"),
        F.col(name).alias("name"),
        F.col(value).cast("double").alias("value"),
    )


def quality_summary(compared: DataFrame, done: Outcome, star_rows: Mapping[str, int]) -> DataFrame:
    """``section, name, value`` of a run, from the compared metrics and what the run has counted."""
    overall = compared.where("scope = 'global'")
    deltas = overall.where(F.col("metric_name") != metrics.GLOBAL_ROWS)
    by_severity = audit.issues_by_severity(done.totals)
    total = by_severity.agg(F.sum("count").alias("value")).select(
        F.lit("total_issues").alias("name"), F.coalesce("value", F.lit(0)).alias("value")
    )
    counted = [("rejected_counts", table, n) for table, n in done.rejected.items()]
    counted += [("counts", f"before_{table}_rows", n) for table, n in done.before.items()]
    counted += [("counts", f"after_{table}_rows", n) for table, n in done.after.items()]
    counted += [("dwh", table, n) for table, n in star_rows.items()]
    few = compared.sparkSession.createDataFrame(counted, "section string, name string, value long")
    parts = [
        _section(overall, "global_before", "metric_name", "before"),
        _section(overall, "global_after", "metric_name", "after"),
        _section(deltas, "improvement", "metric_name", "delta"),
        _section(total, "issue_stats", "name", "value"),
        _section(by_severity, "issues_by_severity", "severity", "count"),
        _section(audit.issues_by_rule(done.totals), "issues_by_rule", "rule_id", "count"),
        few.withColumn("value", F.col("value").cast("double")),
    ]
    return reduce(DataFrame.unionByName, parts)


def summary_document(summary: DataFrame, by_rule: DataFrame) -> DataFrame:
    """One nested row: a map per section, and the severity of each rule."""
    sections = summary.groupBy("section").agg(
        F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("values")
    )
    rows = sections.unionByName(by_rule.select("rule_id", "severity"), allowMissingColumns=True)
    section, severity = F.struct("section", "values"), F.struct("rule_id", "severity")
    return rows.groupBy().agg(
        F.map_from_entries(F.collect_list(F.when(F.col("section").isNotNull(), section))).alias(
            "sections"
        ),
        F.map_from_entries(F.collect_list(F.when(F.col("rule_id").isNotNull(), severity))).alias(
            "severity_by_rule"
        ),
    )


def run(
    tables: Mapping[str, DataFrame],
    output: str,
    settings: Settings = Settings(),
    *,
    file_format: str = "csv",
    limits: JoinLimits = JoinLimits(),
) -> DataFrame:
    """Write every result of a run below ``output`` and return the summary.

    ``processed/`` holds clean and rejected rows and issues, ``reports/`` profile, metrics,
    roll-ups and summary, ``star/`` the star schema as Parquet, read by ``star.read_star``; a star
    with broken keys is refused and the last one stays.
    """
    check_contract(tables)
    spark = tune(tables[PARENT_TABLE].sparkSession)
    with work_tables(spark):
        _write_all(tables, output, settings, file_format, limits)
    return spark.read.parquet(f"{output}/reports/quality_summary")


def _write_all(
    tables: Mapping[str, DataFrame],
    output: str,
    settings: Settings,
    file_format: str,
    limits: JoinLimits,
) -> None:
    spark = tables[PARENT_TABLE].sparkSession
    processed, reports, warehouse = (f"{output}/{d}" for d in ("processed", "reports", "star"))

    profiled = materialize(profile.profile_dataset(tables))
    specs = (profile.PARENT_PROFILE, profile.CHILD_PROFILE)
    documents = [profile.profile_document(tables[spec.table], spec, profiled) for spec in specs]
    sinks.write_json(documents[0].unionByName(documents[1]), f"{reports}/profile_before")

    done = clean_tables(tables, settings, limits)

    def export(df: DataFrame, name: str) -> None:
        sinks.write_table(df, f"{processed}/{name}", file_format)

    export(sinks.export_columns(done.parents, PARENT_EXPORT_COLUMNS), "pacientes_clean")
    export(sinks.export_columns(done.children, CHILD_EXPORT_COLUMNS), "citas_medicas_clean")
    export(done.parents_rejected, "pacientes_rejected")
    export(done.children_rejected, "citas_medicas_rejected")
    export(done.issues, "data_quality_issues")

    after = {PARENT_TABLE: done.parents, CHILD_TABLE: done.children}
    states = metrics.measure_states({"before": tables, "after": after}, settings)
    compared = materialize(metrics.compare_states(states))
    for side in ("before", "after"):
        long = compared.select(*metrics.METRIC_KEY, F.col(side).alias("metric_value"))
        sinks.write_table(long.coalesce(1), f"{reports}/{side}_quality_metrics", file_format)
    sinks.write_table(metrics.completeness_counts(states, "side").coalesce(1), f"{reports}/completeness_counts", file_format)
    sinks.write_table(metrics.key_counts(states, "side").coalesce(1), f"{reports}/key_counts", file_format)

    star = star_schema.build_star(done.parents, done.children, limits)
    _, star_rows = star_schema.publish_star(spark, star, warehouse)

    totals = materialize(audit.rule_totals(done.totals))
    rollups = {
        "top_nulls": profile.top_missing(profiled, specs),
        "top_rules": audit.top_rules(totals).select("rank", "rule_id", "count"),
        "evidence": audit.evidence(totals),
        "rule_impact": audit.rule_impact(totals),
        "completeness_delta": audit.completeness_delta(compared),
    }
    for name, df in rollups.items():
        sinks.write_table(df.coalesce(1), f"{reports}/{name}", file_format)

    summary = quality_summary(compared, done, star_rows)
    sinks.write_table(summary.coalesce(1), f"{reports}/quality_summary", "parquet")
    summary = spark.read.parquet(f"{reports}/quality_summary")
    by_rule = audit.issues_by_rule(done.totals)
    sinks.write_json(summary_document(summary, by_rule), f"{reports}/quality_summary_json")

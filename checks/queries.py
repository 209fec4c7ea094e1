"""Registered queries: one per operator, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import dirty
from pulcra import catalogs as k
from pulcra import functions as fn
from pulcra.config import Settings
from pulcra.operators import audit, integrity, metrics, profile
from pulcra.functions.frames import as_text
from pulcra.operators.keys import resolve_pk_duplicates
from pulcra.operators.lookup import work_folder
from pulcra.operators.rules import explode_issues
from pulcra.plans import run as whole
from pulcra.plans import star as star_schema
from pulcra.plans.appointments import appointment_rows, clean_appointments
from pulcra.plans.patients import clean_contact, clean_patients, patient_rows
from pulcra.plans.tables import with_row_id
from pulcra.sources import readers, sinks

Query = Callable[[SparkSession, str], DataFrame]
SETTINGS = Settings()
ROW = k.ROW_ID
PROFILES = (profile.PARENT_PROFILE, profile.CHILD_PROFILE)
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return register


def dates_as_text(df: DataFrame) -> DataFrame:
    kinds = [c for c, kind in df.dtypes if kind == "date"]
    return df.withColumns({c: F.col(c).cast("string") for c in kinds}) if kinds else df


def outcome(spark: SparkSession, sf_dir: str, values: Collection[str] | None = None) -> whole.Outcome:
    return whole.clean_tables(dirty.tables(spark, sf_dir), SETTINGS, values=values)


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit trail's totals; no value of a row is read for them."""
    return outcome(spark, sf_dir, values=()).totals


def before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = outcome(spark, sf_dir, values={*k.PARENT_COLUMNS, *k.CHILD_COLUMNS})
    after = {k.PARENT_TABLE: done.parents, k.CHILD_TABLE: done.children}
    return metrics.compare_metrics(dirty.tables(spark, sf_dir), after, SETTINGS)


# --- sources and sinks ------------------------------------------------------------------------


@query("src_row_provenance")
def src_row_provenance(spark, sf_dir):
    rows = dirty.raw_children(spark, sf_dir).withColumnRenamed(ROW, "input_key")
    return with_row_id(rows.select("input_key", "id_cita"), ["input_key"])


@query("src_limit_first_n")
def src_limit_first_n(spark, sf_dir):
    return readers.first_rows(dirty.children(spark, sf_dir), 500)


@query("src_key_typing")
def src_key_typing(spark, sf_dir):
    parts = []
    for table, raw in (
        (k.PARENT_TABLE, dirty.raw_parents(spark, sf_dir).withColumn("id_cita", F.lit(None).cast("string"))),
        (k.CHILD_TABLE, dirty.raw_children(spark, sf_dir)),
    ):
        kept = raw.select(ROW, "id_paciente", "id_cita", F.col("id_cita").alias("raw_id_cita"))
        typed = readers.type_keys(kept, table)
        parts.append(typed.select(F.lit(table).alias("table"), "*"))
    return parts[0].unionByName(parts[1])


@query("src_key_typing_double")
def src_key_typing_double(spark, sf_dir):
    """Keys of a floating point column, most of them beyond ten million."""
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias(ROW), ((F.col("o_orderkey") * 1000.0) + F.col("o_orderkey") % 2 / 4).alias("id_paciente")
    )
    return readers.type_keys(rows, k.PARENT_TABLE)


@query("fn_phone_digits_double")
def fn_phone_digits_double(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderkey").alias(ROW), (F.col("o_orderkey") + 3.17e9).alias("telefono")
    )
    return rows.select(ROW, fn.phone_digits(as_text(rows, "telefono")).alias("value"))


@query("src_numbered_table")
def src_numbered_table(spark, sf_dir):
    """A given table read through the numbering source."""
    path = f"{sf_dir}/orders.parquet"
    return readers.number_parquet_rows(spark, path).select(ROW, "o_orderkey", "o_custkey")


@query("src_read_tables")
def src_read_tables(spark, sf_dir):
    """Children of tables written as Parquet and read through the table source."""
    folder = f"{work_folder(spark)}/tables-{uuid.uuid4().hex}"
    paths = {k.PARENT_TABLE: f"{folder}/p", k.CHILD_TABLE: f"{folder}/c"}
    dirty.raw_parents(spark, sf_dir).write.parquet(paths[k.PARENT_TABLE])
    dirty.raw_children(spark, sf_dir).write.parquet(paths[k.CHILD_TABLE])
    return readers.read_tables(spark, paths)[k.CHILD_TABLE]


@query("src_document")
def src_document(spark, sf_dir):
    """Children of one JSON document of a single line, read through the document source."""
    raw = (dirty.raw_parents(spark, sf_dir), dirty.raw_children(spark, sf_dir))
    lines = None
    for n, (table, df) in enumerate(zip((k.PARENT_TABLE, k.CHILD_TABLE), raw)):
        row = F.to_json(F.struct(*[c for c in df.columns if c != ROW]), {"ignoreNullFields": "false"})
        rows = df.select(F.lit(2 * n + 1).alias("part"), F.col(ROW).alias("at"), F.concat(F.lit(","), row).alias("value"))
        least = df.agg(F.min(ROW).alias("least"))
        first = rows.join(F.broadcast(least), rows["at"] == least["least"], "left")
        rows = first.select("part", "at", F.when(F.col("least").isNotNull(), F.substring("value", 2, 1 << 30)).otherwise(F.col("value")).alias("value"))
        opening = ("{" if n == 0 else "],") + f'"{table}":['
        head = spark.range(1).select(F.lit(2 * n).alias("part"), F.lit(0).cast("long").alias("at"), F.lit(opening).alias("value"))
        lines = head.unionByName(rows) if lines is None else lines.unionByName(head).unionByName(rows)
    end = spark.range(1).select(F.lit(9).alias("part"), F.lit(0).cast("long").alias("at"), F.lit("]}").alias("value"))
    path = f"{work_folder(spark)}/document-{uuid.uuid4().hex}"
    # A document is one file, so one task writes it; many read it.
    ordered = lines.unionByName(end).orderBy("part", "at").select("value").coalesce(1)
    ordered.write.option("lineSep", " ").text(path)
    return readers.read_document(spark, path)[k.CHILD_TABLE]


@query("sink_read_back")
def sink_read_back(spark, sf_dir):
    """Rows of an exported table after it was written as CSV and read again."""
    clean = clean_patients(dirty.parents(spark, sf_dir), SETTINGS).clean
    out = dates_as_text(sinks.export_columns(clean, k.PARENT_EXPORT_COLUMNS))
    path = f"{work_folder(spark)}/export-{uuid.uuid4().hex}"
    sinks.write_table(out, path)
    return spark.read.schema(out.schema).csv(path, header=True, escape='"', multiLine=True)


@query("contract_required_columns")
def contract_required_columns(spark, sf_dir):
    given = dirty.tables(spark, sf_dir)
    given[k.CHILD_TABLE] = given[k.CHILD_TABLE].drop("costo")
    return readers.contract_report(given)


@query("export_clean_parent")
def export_clean_parent(spark, sf_dir):
    clean = clean_patients(dirty.parents(spark, sf_dir), SETTINGS).clean
    return dates_as_text(sinks.export_columns(clean, k.PARENT_EXPORT_COLUMNS))


@query("export_clean_child")
def export_clean_child(spark, sf_dir):
    clean = clean_appointments(dirty.children(spark, sf_dir), SETTINGS).clean
    return dates_as_text(sinks.export_columns(clean, k.CHILD_EXPORT_COLUMNS))


@query("quality_summary")
def quality_summary(spark, sf_dir):
    given = dirty.tables(spark, sf_dir)
    done = outcome(spark, sf_dir)
    after = {k.PARENT_TABLE: done.parents, k.CHILD_TABLE: done.children}
    compared = metrics.compare_metrics(given, after, SETTINGS)
    rows = star_schema.row_counts(star_schema.build_star(done.parents, done.children))
    return whole.quality_summary(compared, done, {r["table"]: r["row_count"] for r in rows.collect()})


@query("star_row_counts")
def star_row_counts(spark, sf_dir):
    return star_schema.row_counts(star(spark, sf_dir))


# --- scalar functions ---------------------------------------------------------------------------


def _parents_with(name: str, source: str, value) -> None:
    def build(spark, sf_dir):
        rows = dirty.raw_parents(spark, sf_dir)
        return rows.select(ROW, source, value(F.col(source)).alias("value"))

    QUERIES[name] = build


def _children_with(name: str, source: str, value) -> None:
    def build(spark, sf_dir):
        rows = dirty.raw_children(spark, sf_dir)
        return rows.select(ROW, source, value(F.col(source)).alias("value"))

    QUERIES[name] = build


def _dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    births = dirty.raw_parents(spark, sf_dir).select(
        F.lit(k.PARENT_TABLE).alias("table"), ROW, F.col("fecha_nacimiento").alias("raw")
    )
    events = dirty.raw_children(spark, sf_dir).select(
        F.lit(k.CHILD_TABLE).alias("table"), ROW, F.col("fecha_cita").alias("raw")
    )
    return births.unionByName(events)


def _dates_with(name: str, value) -> None:
    def build(spark, sf_dir):
        return _dates(spark, sf_dir).select("table", ROW, "raw", value(F.col("raw")).alias("value"))

    QUERIES[name] = build


_parents_with("fn_catalog_normalize", "sexo", lambda c: fn.normalize_catalog(c, k.SEX_CATALOG))
_children_with("fn_catalog_status", "estado_cita", lambda c: fn.normalize_catalog(c, k.STATUS_CATALOG))
_parents_with("fn_email_valid", "email", fn.email_valid)
_parents_with("fn_phone_digits", "telefono", fn.phone_digits)
_parents_with("fn_phone_gate", "telefono", lambda c: fn.phone_gate(fn.phone_digits(c), 10, 15))
_dates_with("fn_parse_date", lambda c: fn.parse_date(c).cast("string"))
_dates_with("fn_strict_iso_date", fn.strict_iso_date)
_parents_with("fn_try_int", "edad", fn.try_int)
_children_with("fn_try_double", "costo", fn.try_double)
_children_with("fn_text_normalize", "especialidad", fn.text_normalize)


def _parsed_with(name: str, value) -> None:
    def build(spark, sf_dir):
        parsed = _dates(spark, sf_dir).withColumn("parsed", fn.parse_date(F.col("raw")))
        return parsed.select("table", ROW, "raw", value(F.col("parsed")).alias("value"))

    QUERIES[name] = build


_parsed_with("fn_age_at", lambda c: fn.age_at(c, SETTINGS.reference_date))
_parsed_with("fn_age_bounded", lambda c: fn.age_bounded(fn.age_at(c, SETTINGS.reference_date)))
_parsed_with("fn_date_key", fn.date_key)
_dates_with("fn_date_key_text", fn.date_key_of_text)


@query("fn_email_normalize")
def fn_email_normalize(spark, sf_dir):
    """All words of the documents and all raw addresses of the parents: count and clean form."""
    words = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.explode(F.split("text", " ")).alias("word")
    )
    raw = dirty.raw_parents(spark, sf_dir).select(F.col("email").alias("word"))
    counted = words.unionByName(raw).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("word", "n", fn.email_normalize(F.col("word")).alias("value"))


@query("fn_date_key_parts")
def fn_date_key_parts(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    key = fn.date_key(F.col("o_orderdate").cast("date")).alias("fecha_key")
    keys = orders.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    parts = fn.date_key_parts(F.col("fecha_key"))
    return keys.select("fecha_key", "n", *[c.alias(n) for n, c in parts.items()])


@query("fn_truncate_text")
def fn_truncate_text(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return documents.select("doc_id", fn.truncate_text(F.col("text")).alias("value"))


@query("fn_row_signature")
def fn_row_signature(spark, sf_dir):
    rows = dirty.children(spark, sf_dir)
    return rows.select(ROW, fn.row_signature([c for c in rows.columns if c != ROW]).alias("signature"))


# --- rules ----------------------------------------------------------------------------------------


def _parent_rule(name: str, rule: k.Rule) -> None:
    def build(spark, sf_dir):
        rows = patient_rows(dirty.parents(spark, sf_dir), SETTINGS, only={rule.rule_id})
        return explode_issues(rows, k.PARENT_TABLE, k.PARENT_KEY, SETTINGS)

    QUERIES[name] = build


def _child_rule(name: str, rule: k.Rule) -> None:
    def build(spark, sf_dir):
        rows = appointment_rows(dirty.children(spark, sf_dir), SETTINGS, only={rule.rule_id})
        return explode_issues(rows, k.CHILD_TABLE, k.CHILD_KEY, SETTINGS)

    QUERIES[name] = build


def _key_rule(name: str, rule: k.Rule) -> None:
    def build(spark, sf_dir):
        parents = clean_patients(dirty.parents(spark, sf_dir), SETTINGS, only={rule.rule_id})
        children = clean_appointments(dirty.children(spark, sf_dir), SETTINGS, only={rule.rule_id})
        both = parents.issues.unionByName(children.issues)
        return both.where(F.col("rule_id") == rule.rule_id)

    QUERIES[name] = build


_parent_rule("rule_catalog_unrecognized", k.SEX_UNRECOGNIZED)
_parent_rule("rule_date_invalid", k.BIRTH_INVALID)
_parent_rule("rule_derived_age_range", k.DERIVED_AGE_UNREASONABLE)
_parent_rule("rule_age_range", k.AGE_OUT_OF_RANGE)
_parent_rule("rule_age_filled", k.AGE_FILLED)
_parent_rule("rule_age_inconsistent", k.AGE_INCONSISTENT)
_parent_rule("rule_email_invalid", k.EMAIL_INVALID)
_parent_rule("rule_phone_length", k.PHONE_LENGTH)
_key_rule("rule_pk_missing", k.KEY_MISSING)
_key_rule("rule_pk_conflict", k.KEY_CONFLICT)
_key_rule("rule_pk_exact_dup", k.KEY_EXACT)
_child_rule("rule_event_date_invalid", k.EVENT_DATE_INVALID)
_child_rule("rule_event_date_future", k.EVENT_DATE_FUTURE)
_child_rule("rule_status_unrecognized", k.STATUS_UNRECOGNIZED)
_child_rule("rule_amount_non_numeric", k.AMOUNT_NON_NUMERIC)
_child_rule("rule_amount_negative", k.AMOUNT_NEGATIVE)


@query("rule_column_missing")
def rule_column_missing(spark, sf_dir):
    """Issues per rule of a parent table that lacks the sex column."""
    parents = dirty.parents(spark, sf_dir).drop("sexo")
    return audit.issues_by_rule(clean_patients(parents, SETTINGS).issues)


@query("rule_orphan_fk")
def rule_orphan_fk(spark, sf_dir):
    issues = outcome(spark, sf_dir).issues
    return issues.where(F.col("rule_id") == k.ORPHAN.rule_id)


@query("rule_status_remaining")
def rule_status_remaining(spark, sf_dir):
    """Clean children whose raw status was put back."""
    children = clean_appointments(dirty.children(spark, sf_dir), SETTINGS).clean
    restored = children.withColumn("estado_cita", F.col("estado_cita_original"))
    return integrity.remaining_status_issues(restored)


@query("rule_pk_dup_after")
def rule_pk_dup_after(spark, sf_dir):
    """Children whose duplicates were never resolved."""
    return integrity.repeated_key_issue(dirty.children(spark, sf_dir))


# --- cleaners and key resolution ------------------------------------------------------------------


@query("clean_parent")
def clean_parent(spark, sf_dir):
    return dates_as_text(clean_patients(dirty.parents(spark, sf_dir), SETTINGS).clean)


@query("clean_parent_rejects")
def clean_parent_rejects(spark, sf_dir):
    return dates_as_text(clean_patients(dirty.parents(spark, sf_dir), SETTINGS).rejected)


@query("clean_contact")
def clean_contact_columns(spark, sf_dir):
    rows = dirty.parents(spark, sf_dir).select(ROW, "email", "telefono")
    return clean_contact(rows, SETTINGS)


@query("clean_child")
def clean_child(spark, sf_dir):
    return dates_as_text(clean_appointments(dirty.children(spark, sf_dir), SETTINGS).clean)


@query("clean_child_rejects")
def clean_child_rejects(spark, sf_dir):
    return dates_as_text(clean_appointments(dirty.children(spark, sf_dir), SETTINGS).rejected)


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dirty.children(spark, sf_dir)
    compare = [c for c in rows.columns if c not in (ROW, k.CHILD_KEY)]
    return resolve_pk_duplicates(rows, pk=k.CHILD_KEY, compare=compare)


@query("dedup_keep_first")
def dedup_keep_first(spark, sf_dir):
    return _resolved(spark, sf_dir).where("drop_rule IS NULL").select(ROW, k.CHILD_KEY)


@query("dedup_conflicts")
def dedup_conflicts(spark, sf_dir):
    rows = _resolved(spark, sf_dir).where(F.col("drop_rule") == k.KEY_CONFLICT.rule_id)
    return rows.drop("drop_rule")


@query("dedup_exact_dropped")
def dedup_exact_dropped(spark, sf_dir):
    rows = _resolved(spark, sf_dir).where(F.col("drop_rule") == k.KEY_EXACT.rule_id)
    return rows.drop("drop_rule")


@query("validate_cross_refs")
def validate_cross_refs(spark, sf_dir):
    parents = clean_patients(dirty.parents(spark, sf_dir), SETTINGS).clean
    children = clean_appointments(dirty.children(spark, sf_dir), SETTINGS).clean
    checked = integrity.validate_cross_references(parents, children)
    columns = [ROW, k.CHILD_KEY, k.PARENT_KEY]
    valid = checked.valid.select(*columns, F.lit(None).cast("string").alias("rejection_rule_id"))
    return valid.unionByName(checked.rejected.select(*columns, "rejection_rule_id"))


# --- joins ------------------------------------------------------------------------------------------


def _orders_of_solvent_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").where("c_acctbal > 0")
    return integrity.mark_orphans(orders, "o_custkey", customers, "c_custkey", row_id="o_orderkey")


@query("join_fk_semi")
def join_fk_semi(spark, sf_dir):
    return _orders_of_solvent_customers(spark, sf_dir).where("not is_orphan").drop("is_orphan")


@query("join_fk_anti")
def join_fk_anti(spark, sf_dir):
    return _orders_of_solvent_customers(spark, sf_dir).where("is_orphan").drop("is_orphan")


@query("fk_integrity")
def fk_integrity(spark, sf_dir):
    return integrity.foreign_key_integrity(
        dirty.children(spark, sf_dir), k.PARENT_KEY, dirty.parents(spark, sf_dir), k.PARENT_KEY
    )


# --- profile ----------------------------------------------------------------------------------------


def _profile_part(name: str, pick) -> None:
    def build(spark, sf_dir):
        given = dirty.tables(spark, sf_dir)
        parts = [
            pick(given[spec.table], spec).select(F.lit(spec.table).alias("table"), "*")
            for spec in PROFILES
        ]
        return parts[0].unionByName(parts[1])

    QUERIES[name] = build


def _counted(section: str, *named: str):
    def pick(df, spec):
        found = profile.counts(df, spec, [section])
        if named:
            found = found.where(F.col("item").isin(*named))
        return found.select("item", "value")

    return pick


def _duplicates(count):
    return lambda df, spec: count(df, spec).select("item", "value")


_profile_part("profile_row_count", _counted("row_count"))
_profile_part("profile_missing", _counted("missing_counts"))
_profile_part("profile_exact_dups", _duplicates(profile.exact_duplicates))
_profile_part("profile_pk_dups", _duplicates(profile.key_duplicates))
_profile_part("profile_date_anomalies", _counted(
    "format_anomalies",
    *[f"{c}_{n}" for c in ("fecha_nacimiento", "fecha_cita")
      for n in ("invalid_raw", "recovered_by_swap", "final_null")],
))
_profile_part("profile_catalog_invalid", _counted("format_anomalies", "sexo_invalid", "estado_cita_invalid"))
_profile_part("profile_email_invalid", _counted("format_anomalies", "email_invalid"))
_profile_part("profile_phone_invalid", _counted("format_anomalies", "telefono_invalid"))
_profile_part("profile_amount_anomalies", _counted("format_anomalies", "costo_non_numeric", "costo_negative"))
_profile_part("profile_cardinality", lambda df, spec: profile.cardinality(df, spec.categorical))


@query("profile_top_values")
def profile_top_values(spark, sf_dir):
    parents, children = dirty.parents(spark, sf_dir), dirty.children(spark, sf_dir)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    parts = [
        profile.top_values(parents, ["sexo", "ciudad"]),
        profile.top_values(children, ["estado_cita", "especialidad", "medico"]),
        profile.top_values(orders, ["o_orderpriority", "o_custkey"]),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("profile_dataset")
def profile_dataset(spark, sf_dir):
    return profile.profile_dataset(dirty.tables(spark, sf_dir))


# --- metrics ----------------------------------------------------------------------------------------




@query("metric_completeness")
def metric_completeness(spark, sf_dir):
    given = dirty.tables(spark, sf_dir)
    parts = [
        metrics.column_measures(given[spec.table], spec, SETTINGS)
        for spec in (metrics.PARENT_METRICS, metrics.CHILD_METRICS)
    ]
    return metrics.add_up(parts[0].unionByName(parts[1])).where("scope = 'table_column'")


@query("metric_completeness_global")
def metric_completeness_global(spark, sf_dir):
    given = dirty.tables(spark, sf_dir)
    parts = [
        metrics.column_measures(given[spec.table], spec, SETTINGS)
        for spec in (metrics.PARENT_METRICS, metrics.CHILD_METRICS)
    ]
    return metrics.add_up(parts[0].unionByName(parts[1])).where("scope = 'global'")


@query("metric_pk_uniqueness")
def metric_pk_uniqueness(spark, sf_dir):
    given = dirty.tables(spark, sf_dir)
    parts = [
        metrics.key_measures(given[spec.table], spec)
        for spec in (metrics.PARENT_METRICS, metrics.CHILD_METRICS)
    ]
    return metrics.add_up(parts[0].unionByName(parts[1]))


@query("metric_completeness_counts")
def metric_completeness_counts(spark, sf_dir):
    """Filled cells beside their share, read from the measures of one pass per table."""
    given = dirty.tables(spark, sf_dir)
    parts = [
        metrics.column_measures(given[spec.table], spec, SETTINGS)
        for spec in (metrics.PARENT_METRICS, metrics.CHILD_METRICS)
    ]
    return metrics.completeness_counts(parts[0].unionByName(parts[1]))


@query("metric_pk_counts")
def metric_pk_counts(spark, sf_dir):
    """Distinct keys and rows beyond the first of a key, of both tables, from the key pass."""
    given = dirty.tables(spark, sf_dir)
    return metrics.key_counts(metrics.key_pass(given[k.PARENT_TABLE], given[k.CHILD_TABLE]))


@query("metric_validity_parent")
def metric_validity_parent(spark, sf_dir):
    parents = dirty.parents(spark, sf_dir)
    measured = metrics.column_measures(parents, metrics.PARENT_METRICS, SETTINGS)
    return metrics.add_up(measured).where("metric_name like '%validity_pct'")


@query("metric_validity_child")
def metric_validity_child(spark, sf_dir):
    children = dirty.children(spark, sf_dir)
    measured = metrics.column_measures(children, metrics.CHILD_METRICS, SETTINGS)
    return metrics.add_up(measured).where("metric_name like '%validity_pct'")


@query("metric_age_consistency")
def metric_age_consistency(spark, sf_dir):
    parents = dirty.parents(spark, sf_dir)
    measured = metrics.column_measures(parents, metrics.PARENT_METRICS, SETTINGS)
    return metrics.add_up(measured).where("metric_name like 'edad_consistency%'")


@query("metric_referential_integrity")
def metric_referential_integrity(spark, sf_dir):
    given = dirty.tables(spark, sf_dir)
    return metrics.add_up(
        metrics.foreign_key_measures(given[k.CHILD_TABLE], given[k.PARENT_TABLE])
    )


@query("metrics_long")
def metrics_long(spark, sf_dir):
    return metrics.quality_metrics(dirty.tables(spark, sf_dir), SETTINGS)


QUERIES["metric_before_after"] = before_after


# --- audit roll-ups ---------------------------------------------------------------------------------


@query("issues_all")
def issues_all(spark, sf_dir):
    return outcome(spark, sf_dir).issues


@query("issues_by_severity")
def issues_by_severity(spark, sf_dir):
    return audit.issues_by_severity(totals(spark, sf_dir))


@query("issues_by_rule")
def issues_by_rule(spark, sf_dir):
    return audit.issues_by_rule(totals(spark, sf_dir))


@query("rejected_counts")
def rejected_counts(spark, sf_dir):
    done = outcome(spark, sf_dir, values=())
    return audit.rejected_counts(done.parents_rejected, done.children_rejected)


@query("rejects_union")
def rejects_union(spark, sf_dir):
    return outcome(spark, sf_dir).children_rejected


@query("report_top_nulls")
def report_top_nulls(spark, sf_dir):
    return profile.top_missing(profile_dataset(spark, sf_dir), PROFILES)


@query("report_top_rules")
def report_top_rules(spark, sf_dir):
    return audit.top_rules(audit.rule_totals(totals(spark, sf_dir))).select("rank", "rule_id", "count")


@query("report_evidence")
def report_evidence(spark, sf_dir):
    return audit.evidence(audit.rule_totals(totals(spark, sf_dir)))


@query("report_rule_impact")
def report_rule_impact(spark, sf_dir):
    return audit.rule_impact(audit.rule_totals(totals(spark, sf_dir)))


@query("report_completeness_delta")
def report_completeness_delta(spark, sf_dir):
    return audit.completeness_delta(before_after(spark, sf_dir))


# --- star schema ------------------------------------------------------------------------------------


def star(spark: SparkSession, sf_dir: str) -> star_schema.Star:
    done = outcome(spark, sf_dir)
    return star_schema.build_star(done.parents, done.children)


@query("star_dim_parent")
def star_dim_parent(spark, sf_dir):
    return star_schema.patient_dim(clean_patients(dirty.parents(spark, sf_dir), SETTINGS).clean)


@query("star_dim_catalog")
def star_dim_catalog(spark, sf_dir):
    members = star_schema.catalog_members(outcome(spark, sf_dir).children, "medico", "especialidad")
    parts = [
        star_schema.catalog_dim(members.of(column), "key", "name").select(
            F.lit(f"dim_{column}").alias("dimension"), "key", "name"
        )
        for column in ("medico", "especialidad")
    ]
    return parts[0].unionByName(parts[1])


@query("star_dim_date")
def star_dim_date(spark, sf_dir):
    return star_schema.date_dim(outcome(spark, sf_dir).children)


@query("star_fact")
def star_fact(spark, sf_dir):
    return star(spark, sf_dir).fact_citas


@query("star_fk_check")
def star_fk_check(spark, sf_dir):
    return star_schema.unmatched_facts(star(spark, sf_dir))


@query("star_published_counts")
def star_published_counts(spark, sf_dir):
    """Rows of the star as a guarded load has written it: its keys held, else it were refused."""
    folder = f"{work_folder(spark)}/star-{uuid.uuid4().hex}"
    star_schema.publish_star(spark, star(spark, sf_dir), folder)
    return star_schema.row_counts(star_schema.read_star(spark, folder))


@query("star_pk_check")
def star_pk_check(spark, sf_dir):
    return star_schema.repeated_keys(star(spark, sf_dir))

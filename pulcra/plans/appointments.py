"""Cleaning of the child table."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulcra.catalogs import (
    AMOUNT_NEGATIVE,
    AMOUNT_NON_NUMERIC,
    CHILD_KEY,
    CHILD_TABLE,
    EVENT_DATE_FUTURE,
    EVENT_DATE_INVALID,
    KEY_CONFLICT,
    KEY_EXACT,
    KEY_MISSING,
    ROW_ID,
    STATUS_CATALOG,
    STATUS_UNRECOGNIZED,
)
from pulcra.config import JoinLimits, Settings
from pulcra.functions import normalize_catalog, text_normalize, try_double
from pulcra.functions.frames import as_date, text_or_null
from pulcra.operators.keys import key_missing, key_violations, resolve_pk_duplicates
from pulcra.operators.rules import Violation, explode_issues, violated
from pulcra.plans.tables import Cleaned, rejection_reason, with_row_id

REPLACED = ["fecha_cita", "estado_cita", "costo"]
TRIMMED = ["medico", "especialidad", "ciudad"]
REJECTS = [KEY_MISSING, AMOUNT_NON_NUMERIC, AMOUNT_NEGATIVE, KEY_CONFLICT]
KEY_VIOLATIONS = key_violations(CHILD_KEY, [KEY_CONFLICT, KEY_EXACT])


def appointment_rows(
    df: DataFrame, settings: Settings = Settings(), only: Collection[str] | None = None
) -> DataFrame:
    """Clean values of every row, ``_issues`` and ``reject_rule``, without a shuffle.

    ``reject_rule`` is the first reason to drop the row: no key, an amount that is no number, a
    negative amount. Rows without a key take part in no other rule. Works on batch and streaming
    tables alike.
    """
    given = set(df.columns)
    rows = df.select(
        "*",
        *[
            text_or_null(df, c).alias(f"{c}_original")
            for c in REPLACED
            if c in given or c == "fecha_cita"
        ],
    )
    rows = rows.withColumns(
        {
            "fecha_cita": as_date(df, "fecha_cita"),
            "estado_cita": normalize_catalog(text_or_null(df, "estado_cita"), STATUS_CATALOG),
            "costo": try_double(text_or_null(df, "costo")),
            **{f"_{c}": F.col(c).cast("string") for c in TRIMMED if c in given},
        }
    )
    rows = rows.withColumns({c: text_normalize(F.col(f"_{c}")) for c in TRIMMED if c in given})

    missing = key_missing(CHILD_KEY)
    if "costo" in given:
        non_numeric = F.col("costo_original").isNotNull() & F.col("costo").isNull()
    else:
        non_numeric = F.lit(False)
    rows = rows.withColumn(
        "reject_rule",
        F.when(missing, KEY_MISSING.rule_id)
        .when(non_numeric, AMOUNT_NON_NUMERIC.rule_id)
        .when(F.col("costo") < 0, AMOUNT_NEGATIVE.rule_id),
    )

    keyed = f"coalesce(reject_rule != '{KEY_MISSING.rule_id}', true)"
    violations = [
        Violation(KEY_MISSING, f"NOT {keyed}", original=CHILD_KEY),
        Violation(
            EVENT_DATE_INVALID,
            f"{keyed} AND fecha_cita_original IS NOT NULL AND fecha_cita IS NULL",
            original="fecha_cita_original",
        ),
        Violation(
            EVENT_DATE_FUTURE,
            f"{keyed} AND fecha_cita > DATE '{settings.reference_date}'",
            original="fecha_cita_original",
            clean="fecha_cita",
        ),
    ]
    if "estado_cita" in given:
        violations.append(
            Violation(
                STATUS_UNRECOGNIZED,
                f"{keyed} AND estado_cita_original IS NOT NULL AND estado_cita IS NULL",
                original="estado_cita_original",
            )
        )
    if "costo" in given:
        violations += [
            Violation(rule, f"reject_rule = '{rule.rule_id}'", original="costo_original")
            for rule in (AMOUNT_NON_NUMERIC, AMOUNT_NEGATIVE)
        ]
    return rows.withColumn("_issues", violated(violations, only))


def issue_entries(df: DataFrame) -> int:
    """Entries of ``_issues`` in the rows of :func:`appointment_rows`: one a rule that can apply."""
    return 3 + ("estado_cita" in df.columns) + 2 * ("costo" in df.columns)


def compared_columns(df: DataFrame) -> list[str]:
    """Columns that decide whether two rows of one key are equal; trimmed texts compare trimmed."""
    return [
        f"{c}_original" if c in REPLACED else c
        for c in df.columns
        if c not in (ROW_ID, CHILD_KEY)
    ]


def resolve_appointments(
    df: DataFrame,
    settings: Settings = Settings(),
    *,
    order_by: list[str] | None = None,
    only: Collection[str] | None = None,
    limits: JoinLimits = JoinLimits(),
) -> DataFrame:
    """All rows with clean values, ``_issues`` and ``drop_rule``.

    Rows that are rejected for themselves take no part in duplicate resolution.
    """
    if CHILD_KEY not in df.columns:
        raise ValueError(f"key column {CHILD_KEY!r} is not in the table")
    df = with_row_id(df, order_by)
    return resolve_pk_duplicates(
        appointment_rows(df, settings, only),
        pk=CHILD_KEY,
        compare=compared_columns(df),
        allow_missing=False,
        earlier="reject_rule",
        limits=limits,
    )


def split_appointments(resolved: DataFrame, settings: Settings = Settings()) -> Cleaned:
    """Clean rows, rejected rows and issues of a resolved table.

    Rejected rows show what the rule that dropped them saw: raw values where the key is missing,
    the raw amount, and texts before trimming where they were dropped earlier than that step.
    """
    trimmed = [c for c in TRIMMED if f"_{c}" in resolved.columns]
    scratch = ["_issues", "drop_rule", *[f"_{c}" for c in trimmed]]
    clean = resolved.where("drop_rule IS NULL").drop(*scratch)

    rule = F.col("drop_rule")
    no_key = rule == KEY_MISSING.rule_id
    shown = {c: F.coalesce(F.when(no_key, F.col(f"{c}_original")), F.col(c).cast("string"))
             for c in ("fecha_cita", "estado_cita") if f"{c}_original" in resolved.columns}
    if "costo_original" in resolved.columns:
        shown["costo"] = F.col("costo_original")
    shown |= {
        c: F.when(rule != KEY_CONFLICT.rule_id, F.col(f"_{c}")).otherwise(F.col(c))
        for c in trimmed
    }
    shown |= {
        c: F.when(~no_key, F.col(c))
        for c in resolved.columns
        if c.endswith("_original")
    }
    rejected = (
        resolved.where(rule.isin([r.rule_id for r in REJECTS]))
        .withColumns(
            {
                **shown,
                "rejection_reason": rejection_reason(rule, REJECTS),
                "rejection_rule_id": rule,
            }
        )
        .drop(*scratch)
    )
    issues = explode_issues(
        resolved, CHILD_TABLE, CHILD_KEY, settings, F.concat("_issues", violated(KEY_VIOLATIONS))
    )
    return Cleaned(clean, rejected, issues)


def clean_appointments(
    df: DataFrame,
    settings: Settings = Settings(),
    *,
    order_by: list[str] | None = None,
    only: Collection[str] | None = None,
    limits: JoinLimits = JoinLimits(),
) -> Cleaned:
    resolved = resolve_appointments(df, settings, order_by=order_by, only=only, limits=limits)
    return split_appointments(resolved, settings)


def rejected_appointments(initial: DataFrame, orphans: DataFrame) -> DataFrame:
    """All rejected children, those of cleaning and those without a parent, by column name."""
    as_text = {}
    if "fecha_cita" in orphans.columns:
        as_text["fecha_cita"] = F.col("fecha_cita").cast("string")
    if "costo_original" in orphans.columns:
        as_text["costo"] = F.col("costo_original")
    return initial.unionByName(orphans.withColumns(as_text), allowMissingColumns=True)

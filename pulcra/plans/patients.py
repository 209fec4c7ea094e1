"""Cleaning of the parent table."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulcra.catalogs import (
    AGE_FILLED,
    AGE_INCONSISTENT,
    AGE_OUT_OF_RANGE,
    BIRTH_INVALID,
    DERIVED_AGE_UNREASONABLE,
    EMAIL_INVALID,
    KEY_CONFLICT,
    KEY_EXACT,
    KEY_MISSING,
    PARENT_KEY,
    PARENT_TABLE,
    PHONE_LENGTH,
    ROW_ID,
    SEX_CATALOG,
    SEX_MISSING,
    SEX_UNRECOGNIZED,
)
from pulcra.config import JoinLimits, Settings
from pulcra.functions import (
    age_at,
    age_bounded,
    email_normalize,
    normalize_catalog,
    phone_digits,
    phone_gate,
    int_text,
    try_int,
)
from pulcra.functions.frames import as_date, text_or_null
from pulcra.operators.keys import key_violations, resolve_pk_duplicates
from pulcra.operators.rules import Violation, explode_issues, issue_rows, violated
from pulcra.plans.tables import Cleaned, rejection_reason, with_row_id

REPLACED = ["sexo", "fecha_nacimiento", "edad", "email", "telefono"]
REJECTS = [KEY_MISSING, KEY_CONFLICT]
KEY_VIOLATIONS = key_violations(PARENT_KEY, [KEY_MISSING, KEY_CONFLICT, KEY_EXACT])


def _with_originals(df: DataFrame) -> DataFrame:
    """Keep the raw value of every column that cleaning replaces."""
    always = {"fecha_nacimiento", "edad"}
    return df.select(
        "*",
        *[
            text_or_null(df, c).alias(f"{c}_original")
            for c in REPLACED
            if c in df.columns or c in always
        ],
    )


def contact_columns(df: DataFrame, settings: Settings) -> DataFrame:
    """Replace e-mail and phone by their clean values; ``*_original`` must be present."""
    if "email_original" in df.columns:
        email = email_normalize(F.col("email_original"))
    else:
        email = F.lit(None).cast("string")
    if "telefono_original" in df.columns:
        df = df.withColumn("_digits", phone_digits(F.col("telefono_original")))
    else:
        df = df.withColumn("_digits", F.lit(None).cast("string"))
    phone = phone_gate(F.col("_digits"), settings.phone_min_digits, settings.phone_max_digits)
    return df.withColumns({"email": email, "telefono": phone})


def clean_contact(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Clean only the contact columns, keeping their raw values beside them."""
    kept = df.select(
        "*", *[F.col(c).cast("string").alias(f"{c}_original") for c in ("email", "telefono") if c in df.columns]
    )
    return contact_columns(kept, settings).drop("_digits")


def patient_rows(
    df: DataFrame, settings: Settings = Settings(), only: Collection[str] | None = None
) -> DataFrame:
    """Clean values of every row plus ``_issues``, row by row and without a shuffle.

    Ages are settled in sequence within the row: out of range becomes null, null is filled from
    the birth date, what is still too far from it is replaced. ``only`` restricts the rules that
    write issues. Works on batch and streaming tables alike.
    """
    tolerance = settings.age_tolerance_years
    rows = _with_originals(df)
    rows = rows.withColumns(
        {
            "sexo": normalize_catalog(text_or_null(df, "sexo"), SEX_CATALOG),
            "fecha_nacimiento": as_date(df, "fecha_nacimiento"),
            "edad_limpia": try_int(F.col("edad_original")),
            # Ages beyond bigint are whole numbers too, and out of range.
            "_whole_age": int_text(F.col("edad_original")),
        }
    )
    rows = contact_columns(rows, settings)
    rows = rows.withColumn("_derived", age_at(F.col("fecha_nacimiento"), settings.reference_date))
    rows = rows.withColumns(
        {
            "edad_derivada": age_bounded(F.col("_derived"), settings.age_min, settings.age_max),
            "_ranged": age_bounded(
                F.col("edad_limpia"), settings.age_min, settings.age_max
            ).cast("int"),
        }
    )
    rows = rows.withColumn(
        "edad_inconsistente",
        F.coalesce(F.abs(F.col("_ranged") - F.col("edad_derivada")) > tolerance, F.lit(False)),
    )
    rows = rows.withColumn(
        "edad",
        F.when(F.col("edad_inconsistente"), F.col("edad_derivada")).otherwise(
            F.coalesce("_ranged", "edad_derivada")
        ),
    )

    with_birth = (
        "concat(coalesce(edad_original, 'NULL'), ' (nació: ',"
        " coalesce(CAST(fecha_nacimiento AS STRING), 'NULL'), ')')"
    )
    violations = [
        Violation(
            BIRTH_INVALID,
            "fecha_nacimiento_original IS NOT NULL AND fecha_nacimiento IS NULL",
            original="fecha_nacimiento_original",
        ),
        Violation(
            DERIVED_AGE_UNREASONABLE,
            "_derived IS NOT NULL AND edad_derivada IS NULL",
            original="_derived",
        ),
        Violation(
            AGE_OUT_OF_RANGE, "_whole_age AND _ranged IS NULL", original="coalesce(CAST(edad_limpia AS STRING), edad_original)"
        ),
        Violation(
            AGE_FILLED,
            "_ranged IS NULL AND edad_derivada IS NOT NULL",
            original=with_birth,
            clean="edad",
        ),
        Violation(AGE_INCONSISTENT, "edad_inconsistente", original=with_birth, clean="edad"),
    ]
    given = {
        "sexo": Violation(
            SEX_UNRECOGNIZED, "sexo_original IS NOT NULL AND sexo IS NULL", original="sexo_original"
        ),
        "email": Violation(
            EMAIL_INVALID, "email_original IS NOT NULL AND email IS NULL", original="email_original"
        ),
        "telefono": Violation(
            PHONE_LENGTH, "_digits IS NOT NULL AND telefono IS NULL", original="telefono_original"
        ),
    }
    violations += [violation for column, violation in given.items() if column in df.columns]
    return rows.withColumn("_issues", violated(violations, only)).drop(
        "_derived", "_ranged", "_whole_age", "_digits"
    )


def issue_entries(df: DataFrame) -> int:
    """Entries of ``_issues`` in the rows of :func:`patient_rows`: one a rule that can apply."""
    return 5 + sum(c in df.columns for c in ("sexo", "email", "telefono"))


def compared_columns(df: DataFrame) -> list[str]:
    """Columns that decide whether two rows of one key are equal: all raw values but the key."""
    return [
        f"{c}_original" if c in REPLACED else c
        for c in df.columns
        if c not in (ROW_ID, PARENT_KEY)
    ]


def resolve_patients(
    df: DataFrame,
    settings: Settings = Settings(),
    *,
    order_by: list[str] | None = None,
    only: Collection[str] | None = None,
    limits: JoinLimits = JoinLimits(),
) -> DataFrame:
    """All rows with clean values, ``_issues`` and ``drop_rule``."""
    df = with_row_id(df, order_by)
    return resolve_pk_duplicates(
        patient_rows(df, settings, only),
        pk=PARENT_KEY,
        compare=compared_columns(df),
        limits=limits,
    )


def split_patients(
    resolved: DataFrame, settings: Settings = Settings(), *, sex_given: bool = True
) -> Cleaned:
    """Clean rows, rejected rows and issues of a resolved table."""
    clean = resolved.where("drop_rule IS NULL").drop("drop_rule", "_issues")
    rejected = (
        resolved.where(F.col("drop_rule").isin([rule.rule_id for rule in REJECTS]))
        .withColumn("rejection_reason", rejection_reason(F.col("drop_rule"), REJECTS))
        .withColumnRenamed("drop_rule", "rejection_rule_id")
        .drop("_issues")
    )
    issues = explode_issues(
        resolved, PARENT_TABLE, PARENT_KEY, settings, F.concat("_issues", violated(KEY_VIOLATIONS))
    )
    if not sex_given:
        one = resolved.sparkSession.range(1)
        absent = issue_rows(one, SEX_MISSING, PARENT_TABLE, PARENT_KEY, row_id="'TABLE'")
        issues = absent.unionByName(issues)
    return Cleaned(clean, rejected, issues)


def clean_patients(
    df: DataFrame,
    settings: Settings = Settings(),
    *,
    order_by: list[str] | None = None,
    only: Collection[str] | None = None,
    limits: JoinLimits = JoinLimits(),
) -> Cleaned:
    resolved = resolve_patients(df, settings, order_by=order_by, only=only, limits=limits)
    return split_patients(resolved, settings, sex_given="sexo" in df.columns)

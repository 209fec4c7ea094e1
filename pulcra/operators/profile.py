"""Profile of raw tables: counts in long form, most frequent values, nested documents."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulcra.catalogs import (
    CHILD_COLUMNS,
    CHILD_KEY,
    CHILD_TABLE,
    PARENT_COLUMNS,
    PARENT_KEY,
    PARENT_TABLE,
    ROW_ID,
    SEX_CATALOG,
    STATUS_CATALOG,
)
from pulcra.config import JoinLimits
from pulcra.functions import (
    email_valid,
    normalize_catalog,
    parse_date,
    phone_digits,
    strict_iso_date,
    try_double,
    value_fingerprint,
)
from pulcra.functions.frames import text_or_null
from pulcra.functions.literals import (
    inline_structs,
    lookup_constant,
    sql_literal,
    sql_struct,
)
from pulcra.operators.keysets import is_whole, key_words, set_totals
from pulcra.operators.lookup import lookup_join, size_measure, write_observed

Check = Callable[[Column], Column]
COUNTED = ("row_count", "missing_counts", "format_anomalies")


@dataclass(frozen=True)
class ProfileSpec:
    """What to look at in one table.

    ``anomalies`` maps an item name to a column and a condition; rows are counted where the
    column is not null and the condition holds.
    """

    table: str
    pk: str
    columns: list[str]
    date_column: str
    categorical: list[str]
    anomalies: Mapping[str, tuple[str, Check]] = field(default_factory=dict)


def catalog_invalid(catalog: Mapping[str, str]) -> Check:
    return lambda value: normalize_catalog(value, catalog).isNull()


def phone_too_short(min_digits: int = 10) -> Check:
    """No digits or too few; a profile sets no upper bound."""
    return lambda value: F.coalesce(
        F.char_length(phone_digits(value)) < min_digits, F.lit(True)
    )


PARENT_PROFILE = ProfileSpec(
    table=PARENT_TABLE,
    pk=PARENT_KEY,
    columns=PARENT_COLUMNS,
    date_column="fecha_nacimiento",
    categorical=["sexo", "ciudad"],
    anomalies={
        "sexo_invalid": ("sexo", catalog_invalid(SEX_CATALOG)),
        "email_invalid": ("email", lambda value: ~email_valid(value)),
        "telefono_invalid": ("telefono", phone_too_short()),
    },
)
CHILD_PROFILE = ProfileSpec(
    table=CHILD_TABLE,
    pk=CHILD_KEY,
    columns=CHILD_COLUMNS,
    date_column="fecha_cita",
    categorical=["estado_cita", "especialidad", "medico"],
    anomalies={
        "estado_cita_invalid": ("estado_cita", catalog_invalid(STATUS_CATALOG)),
        "costo_non_numeric": ("costo", lambda value: try_double(value).isNull()),
        "costo_negative": ("costo", lambda value: try_double(value) < 0),
    },
)


def _count_where(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def _items(df: DataFrame, records: list[tuple[str, str, str]]) -> DataFrame:
    """One row of counts to one row per ``(section, item, column)``."""
    return df.select(
        inline_structs(
            [
                sql_struct(section=sql_literal(section), item=sql_literal(item), value=column)
                for section, item, column in records
            ]
        )
    )


def date_anomalies(prefix: str) -> dict[str, Column]:
    """Aggregates over ``_not_iso`` and ``_parsed``: texts that are not ISO, those of them
    recovered otherwise, those lost."""
    not_iso, parsed = F.col("_not_iso"), F.col("_parsed")
    return {
        f"{prefix}_invalid_raw": _count_where(not_iso),
        f"{prefix}_recovered_by_swap": _count_where(not_iso & parsed.isNotNull()),
        f"{prefix}_final_null": _count_where(not_iso & parsed.isNull()),
    }


def repeated_rows(df: DataFrame, by: list[str], name: str) -> DataFrame:
    """Rows beyond the first of each group of equal ``by`` values, nulls being equal."""
    groups = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias(name))


def repeated_wide_rows(
    df: DataFrame,
    columns: list[str],
    name: str,
    *,
    fingerprint: Callable[[list[str]], tuple[Column, Column]] = value_fingerprint,
    limits: JoinLimits = JoinLimits(),
) -> DataFrame:
    """What :func:`repeated_rows` gives over many columns, without shuffling them.

    Rows are grouped by a 128-bit fingerprint. A fingerprint that occurs once is a row of its own;
    only the others are looked at again: per group the least and the greatest value and the number
    of nulls of each column, which combine before the shuffle, tell whether all its rows are equal.
    Should a group hold different rows, these are grouped by their values.
    """
    if not columns:
        return df.agg(F.greatest(F.count(F.lit(1)) - 1, F.lit(0)).alias(name))
    first, second = fingerprint(columns)
    marked = df.select(*columns, F.struct(first.alias("a"), second.alias("b")).alias("_print"))
    # A group's rows are counted in the table that its rows are looked up in.
    prints = marked.groupBy("_print").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    prints = prints.withColumn("_again", F.lit(True))
    measures = {"rows": F.count(F.lit(1)), "beyond": F.sum(F.col("n") - 1), "size": size_measure(prints.schema)}
    prints, seen = write_observed(prints, measures)
    if not seen["rows"]:
        return df.sparkSession.range(1).select(F.lit(0).cast("long").alias(name))

    def members(of: DataFrame, size: int) -> DataFrame:
        known = of.withColumnRenamed("_print", "_known")
        joined = lookup_join(
            marked, known, key=F.col("_print"), lookup_key="_known", weight="n",
            row_id=F.monotonically_increasing_id(), limits=limits, size=size,
        )
        return joined.where("_again").drop("_again")

    differs = F.lit(False)
    for c in columns:
        given = F.count(c)
        differs |= (given > 0) & (given < F.count(F.lit(1))) | F.coalesce(F.min(c) != F.max(c), F.lit(False))
    looked = members(prints, seen["size"]).groupBy("_print").agg(F.count(F.lit(1)).alias("n"), differs.alias("_differs"))
    odd, found = write_observed(looked.where("_differs").select("_print", "n", F.lit(True).alias("_again")), measures)
    equal = seen["beyond"] - (found["beyond"] or 0)
    if not found["rows"]:
        return df.sparkSession.range(1).select(F.lit(equal).cast("long").alias(name))
    exact = repeated_rows(members(odd, found["size"]), columns, "_exact")
    return exact.select((F.col("_exact") + F.lit(equal)).cast("long").alias(name))


def counts(df: DataFrame, spec: ProfileSpec, sections: Collection[str] = COUNTED) -> DataFrame:
    """``section, item, value`` of everything one pass without a shuffle can count.

    What belongs to other sections than the chosen ones is not computed.
    """
    missing = [c for c in spec.columns if c in df.columns] if "missing_counts" in sections else []
    if "format_anomalies" not in sections:
        wide = df.agg(F.count(F.lit(1)).alias("rows"), *[_count_where(F.col(c).isNull()).alias(f"_{c}") for c in missing])
        records = [("row_count", "rows", "rows")] if "row_count" in sections else []
        return _items(wide, records + [("missing_counts", c, f"_{c}") for c in missing])
    date_text = text_or_null(df, spec.date_column)
    df = df.withColumns(
        {
            "_not_iso": date_text.isNotNull() & ~strict_iso_date(date_text),
            "_parsed": parse_date(date_text),
        }
    )
    anomalies = date_anomalies(spec.date_column)
    for name, (column, condition) in spec.anomalies.items():
        if column in df.columns:
            value = F.col(column).cast("string")
            anomalies[name] = _count_where(value.isNotNull() & condition(value))
        else:
            anomalies[name] = F.count(F.when(F.lit(False), 1))
    wide = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[_count_where(F.col(c).isNull()).alias(f"_{c}") for c in missing],
        *[column.alias(name) for name, column in anomalies.items()],
    )
    records = [("row_count", "rows", "rows")] if "row_count" in sections else []
    records += [("missing_counts", c, f"_{c}") for c in missing]
    records += [("format_anomalies", name, name) for name in anomalies]
    return _items(wide, records)


def exact_duplicates(df: DataFrame, spec: ProfileSpec) -> DataFrame:
    """``section, item, value``: rows beyond the first of equal ones."""
    columns = [c for c in df.columns if c != ROW_ID]
    name = "exact_duplicate_rows"
    return _items(repeated_wide_rows(df, columns, name), [("duplicate_counts", name, name)])


def key_duplicates(df: DataFrame, spec: ProfileSpec) -> DataFrame:
    """``section, item, value``: rows beyond the first of each key (null is one key)."""
    name = "pk_duplicate_rows"
    if spec.pk in df.columns and is_whole(df, spec.pk):
        totals = set_totals(key_words(df, spec.pk))
        keys = totals.select((F.col("_rows") - F.col("_groups")).alias(name))
    elif spec.pk in df.columns:
        keys = repeated_rows(df, [spec.pk], name)
    else:
        keys = df.agg(F.count(F.when(F.lit(False), 1)).alias(name))
    return _items(keys, [("duplicate_counts", name, name)])


def duplicate_counts(df: DataFrame, spec: ProfileSpec) -> DataFrame:
    """``section, item, value``: exact duplicate rows and repeated keys."""
    return exact_duplicates(df, spec).unionByName(key_duplicates(df, spec))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, value, count`` of the non-null values of each column, in one shuffle."""
    present = [c for c in columns if c in df.columns]
    records = [
        sql_struct(column=sql_literal(c), value=f"CAST(`{c}` AS STRING)") for c in present
    ] or [sql_struct(column=sql_literal(None), value=sql_literal(None))]
    long = df.select(inline_structs(records))
    return (
        long.where("value is not null")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def cardinality(df: DataFrame, columns: list[str]) -> DataFrame:
    """``column, unique_count``; columns without any value count 0."""
    counted = value_counts(df, columns).groupBy("column").agg(F.count(F.lit(1)).alias("n"))
    names = df.sparkSession.createDataFrame(
        [(c,) for c in columns if c in df.columns], "column string"
    )
    return names.join(counted, "column", "left").select(
        "column", F.coalesce("n", F.lit(0)).alias("unique_count")
    )


def top_values(df: DataFrame, columns: list[str], k: int = 5) -> DataFrame:
    """``column, rank, value, count`` of the k most frequent values, ties by value.

    Ranked after counting; Spark keeps only k rows per column and task before the last shuffle.
    """
    ranking = Window.partitionBy("column").orderBy(F.desc("count"), F.asc("value"))
    return (
        value_counts(df, columns)
        .withColumn("rank", F.row_number().over(ranking))
        .where(F.col("rank") <= k)
    )


def profile_table(df: DataFrame, spec: ProfileSpec) -> DataFrame:
    """``table, section, item, value``: every count of a table's profile."""
    unique = cardinality(df, spec.categorical).select(
        F.lit("categorical_cardinality").alias("section"),
        F.col("column").alias("item"),
        F.col("unique_count").alias("value"),
    )
    parts = counts(df, spec).unionByName(duplicate_counts(df, spec)).unionByName(unique)
    return parts.select(F.lit(spec.table).alias("table"), "section", "item", "value")


def profile_dataset(tables: Mapping[str, DataFrame]) -> DataFrame:
    parents = profile_table(tables[PARENT_TABLE], PARENT_PROFILE)
    return parents.unionByName(profile_table(tables[CHILD_TABLE], CHILD_PROFILE))


def top_missing(profile: DataFrame, specs: tuple[ProfileSpec, ...], k: int = 5) -> DataFrame:
    """The k columns with most nulls of each table, ties in the table's column order."""
    places = {f"{s.table}|{c}": i for s in specs for i, c in enumerate(s.columns)}
    place = lookup_constant(places, F.concat_ws("|", "table", "item"))
    ranking = Window.partitionBy("table").orderBy(F.desc("value"), place)
    return (
        profile.where("section = 'missing_counts'")
        .withColumn("rank", F.row_number().over(ranking))
        .where(F.col("rank") <= k)
        .select("table", "rank", F.col("item").alias("column"), F.col("value").alias("null_count"))
    )


def profile_document(df: DataFrame, spec: ProfileSpec, profiled: DataFrame | None = None) -> DataFrame:
    """One nested row per table, for a JSON sink. Holds a few entries per column.

    ``profiled`` is a written profile that holds the table's; without one the table is profiled.
    """
    if profiled is None:
        long = profile_table(df, spec)
    else:
        long = profiled.where(F.col("table") == spec.table)

    def entries(section: str) -> Column:
        pair = F.struct("item", "value")
        return F.map_from_entries(F.collect_list(F.when(F.col("section") == section, pair)))

    numbers = long.groupBy("table").agg(
        F.max(F.when(F.col("section") == "row_count", F.col("value"))).alias("row_count"),
        entries("missing_counts").alias("missing_counts"),
        entries("duplicate_counts").alias("duplicate_counts"),
        entries("format_anomalies").alias("format_anomalies"),
        entries("categorical_cardinality").alias("unique_count"),
    )
    tops = (
        top_values(df, spec.categorical)
        .groupBy("column")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "value", "count"))).alias("top"))
        .groupBy()
        .agg(F.map_from_entries(F.collect_list(F.struct("column", "top"))).alias("tops"))
        .select(F.lit(spec.table).alias("table"), "tops")
    )
    return numbers.join(tops, "table").select(
        "table",
        "row_count",
        "missing_counts",
        "duplicate_counts",
        "format_anomalies",
        F.transform_values(
            "unique_count",
            lambda column, unique: F.struct(
                unique.alias("unique_count"),
                F.transform(
                    F.coalesce(
                        F.try_element_at("tops", column),
                        F.array().cast("array<struct<rank:int,value:string,count:bigint>>"),
                    ),
                    lambda t: F.struct(t["value"].alias("value"), t["count"].alias("count")),
                ).alias("top"),
            ),
        ).alias("categorical_cardinality"),
    )

"""Quality metrics in long form: ``scope, table, column, metric_name, metric_value``.

Every metric is a sum over a sum (or a bare sum). A measure carries the two numbers; measures of
different tables and passes are united, added up per metric and divided at the end, so that
dataset-wide metrics need no second look at the tables.

A measured side (before, after) is a handful of such sums. ``measure_states`` writes them once;
metrics, their comparison and the counts beside the shares are all read from there, and states of
parts of a table add up to those of the whole.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulcra.catalogs import (
    CHILD_COLUMNS,
    CHILD_KEY,
    CHILD_TABLE,
    PARENT_COLUMNS,
    PARENT_KEY,
    PARENT_TABLE,
    SEX_CATALOG,
    STATUS_CATALOG,
)
from pulcra.config import JoinLimits, Settings
from pulcra.functions import (
    age_at,
    email_valid,
    normalize_catalog,
    phone_digits,
    try_double,
)
from pulcra.functions.frames import as_date, text_or_null
from pulcra.functions.literals import inline_structs, sql_literal, sql_struct
from pulcra.operators.integrity import foreign_key_totals
from pulcra.operators.keysets import is_whole, key_words, mark_members, set_totals, small_set
from pulcra.operators.lookup import materialize, write_sized

METRIC_KEY = ["scope", "table", "column", "metric_name"]
COUNTS = "count"  # scope of counts beside the metrics, which are no metrics of the long form
GLOBAL_COMPLETENESS = "completeness_global_pct"
GLOBAL_ROWS = "row_count_total"
GLOBAL_FK = "referential_integrity_fk_valid_pct_among_non_null"



@dataclass(frozen=True)
class MetricSpec:
    """What to measure in one table.

    ``derived`` computes helper columns once per row; ``validity`` maps a metric name to a
    condition over them, ``consistency`` gives the conditions for a pair of values being present
    and being consistent.
    """

    table: str
    pk: str
    columns: list[str]
    derived: Callable[[DataFrame], dict[str, Column]]
    validity: Mapping[str, Callable[[Settings], Column]] = field(default_factory=dict)
    consistency: Callable[[Settings], tuple[Column, Column]] | None = None


def _age_consistency(settings: Settings) -> tuple[Column, Column]:
    """Pair present, pair consistent; the derived age is not bounded here, and an age that is no
    number counts as inconsistent."""
    derived = age_at(F.col("_date"), settings.reference_date)
    pair = F.col("_age_text").isNotNull() & F.col("_date").isNotNull()
    close = F.abs(F.col("_age") - derived) <= settings.age_tolerance_years
    return pair, pair & F.coalesce(close, F.lit(False))


PARENT_METRICS = MetricSpec(
    table=PARENT_TABLE,
    pk=PARENT_KEY,
    columns=PARENT_COLUMNS,
    derived=lambda df: {
        "_date": as_date(df, "fecha_nacimiento"),
        "_sex": normalize_catalog(text_or_null(df, "sexo"), SEX_CATALOG),
        "_email_ok": email_valid(text_or_null(df, "email")),
        "_digits": F.char_length(phone_digits(text_or_null(df, "telefono"))),
        "_age_text": text_or_null(df, "edad"),
        "_age": try_double(text_or_null(df, "edad")),
    },
    validity={
        "fecha_nacimiento_validity_pct": lambda s: F.col("_date").isNotNull(),
        "sexo_validity_pct": lambda s: F.col("_sex").isNotNull(),
        "email_validity_pct": lambda s: F.col("_email_ok"),
        "telefono_validity_pct": lambda s: F.col("_digits").between(
            s.phone_min_digits, s.phone_max_digits
        ),
        "edad_validity_pct": lambda s: F.col("_age").between(s.age_min, s.age_max),
    },
    consistency=_age_consistency,
)
CHILD_METRICS = MetricSpec(
    table=CHILD_TABLE,
    pk=CHILD_KEY,
    columns=CHILD_COLUMNS,
    derived=lambda df: {
        "_date": as_date(df, "fecha_cita"),
        "_status": normalize_catalog(text_or_null(df, "estado_cita"), STATUS_CATALOG),
        "_amount": try_double(text_or_null(df, "costo")),
    },
    validity={
        "fecha_cita_validity_pct": lambda s: F.col("_date").isNotNull(),
        "estado_cita_validity_pct": lambda s: F.col("_status").isNotNull(),
        "costo_validity_pct": lambda s: F.col("_amount") >= 0,
    },
)


def _measure(
    scope: str, table: str | None, column: str | None, name: str, num: str, den: str | None = None
) -> str:
    """A measure record; without a denominator the metric is the bare sum."""
    return sql_struct(
        scope=sql_literal(scope),
        table=sql_literal(table),
        column=sql_literal(column),
        metric_name=sql_literal(name),
        num=f"CAST({num} AS BIGINT)",
        den=f"CAST({den or 'NULL'} AS BIGINT)",
        is_share="true" if den else "false",
    )


def column_measures(df: DataFrame, spec: MetricSpec, settings: Settings) -> DataFrame:
    """Row count, completeness, validity and consistency: one pass, one record per task.

    Shares of validity are taken of all rows, not only of those with a value.
    """
    present = [c for c in spec.columns if c in df.columns]
    conditions = {name: check(settings) for name, check in spec.validity.items()}
    if spec.consistency is not None:
        conditions["_pair"], conditions["_close"] = spec.consistency(settings)
    wide = df.withColumns(spec.derived(df)).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(c)).alias(f"_n_{c}") for c in present],
        *[F.count(F.when(cond, 1)).alias(f"_v_{name}") for name, cond in conditions.items()],
    )
    rows, table = "_rows", spec.table
    records = [_measure("global", None, None, GLOBAL_ROWS, rows)]
    for c in present:
        filled = f"_n_{c}"
        records.append(
            _measure("table_column", table, c, "completeness_pct", filled, "greatest(_rows, 1)")
        )
        records.append(_measure("global", None, None, GLOBAL_COMPLETENESS, filled, rows))
    for name in spec.validity:
        records.append(_measure("table", table, None, name, f"_v_{name}", rows))
    if spec.consistency is not None:
        pairs, close = "_v__pair", "_v__close"
        records.append(_measure("table", table, None, "edad_consistency_pct", close, pairs))
        records.append(_measure("table", table, None, "edad_consistency_pair_count", pairs))
    return wide.select(inline_structs(records))


def _key_totals(groups: DataFrame, key: str, n: str) -> DataFrame:
    """``_keys, _groups, _rows`` of one row per key: distinct keys, the same with null as a key, rows."""
    return groups.agg(
        F.count(key).alias("_keys"),
        F.count(F.lit(1)).alias("_groups"),
        F.coalesce(F.sum(n), F.lit(0)).alias("_rows"),
    )


def _key_records(table: str, keys: str, groups: str, rows: str) -> list[str]:
    return [
        _measure("table", table, None, "pk_uniqueness_pct", keys, rows),
        _measure(COUNTS, table, None, "unique_pk_count", keys),
        _measure(COUNTS, table, None, "duplicate_pk_rows", f"({rows} - {groups})"),
    ]


def _foreign_key_records(table: str, valid: str, given: str) -> list[str]:
    return [
        _measure("table", table, None, "fk_valid_pct_among_non_null", valid, given),
        _measure("table", table, None, "fk_valid_pair_count", valid),
        _measure("table", table, None, "fk_non_null_count", given),
        _measure("global", None, None, GLOBAL_FK, valid, given),
    ]


def key_measures(df: DataFrame, spec: MetricSpec) -> DataFrame:
    """Distinct non-null keys over rows. Reads the key column only and shuffles keys, not rows."""
    if spec.pk not in df.columns:
        zero = F.lit(0)
        wide = df.sparkSession.range(1).select(*[zero.alias(c) for c in ("_keys", "_groups", "_rows")])
    elif is_whole(df, spec.pk):
        wide = set_totals(key_words(df, spec.pk))
    else:
        wide = _key_totals(df.groupBy(spec.pk).agg(F.count(F.lit(1)).alias("n")), spec.pk, "n")
    return wide.select(inline_structs(_key_records(spec.table, "_keys", "_groups", "_rows")))


def foreign_key_measures(
    child: DataFrame, parent: DataFrame, table: str = CHILD_TABLE, fk: str = PARENT_KEY, pk: str = PARENT_KEY
) -> DataFrame:
    if fk not in child.columns:
        wide = child.sparkSession.range(1).select(F.lit(0).alias("valid"), F.lit(0).alias("given"))
    else:
        if pk not in parent.columns:
            parent = parent.select(F.lit(None).cast(child.schema[fk].dataType).alias(pk))
        wide = foreign_key_totals(child, fk, parent, pk)
    return wide.select(inline_structs(_foreign_key_records(table, "valid", "given")))


def _key_rows(df: DataFrame, keys: list[tuple[str, str, str]], kinds: Mapping[str, str]) -> DataFrame:
    """One row per row and key column: a column per key domain, null in the others', and the side."""
    records = []
    for domain, column, side in keys:
        values = {d: f"CAST({column if d == domain else 'NULL'} AS {kind})" for d, kind in kinds.items()}
        records.append(sql_struct(domain=sql_literal(domain), side=sql_literal(side), **values))
    return df.select(inline_structs(records))


def key_pass(parents: DataFrame, children: DataFrame, limits: JoinLimits = JoinLimits()) -> DataFrame:
    """What ``key_measures`` of both tables and ``foreign_key_measures`` give, from one look at the
    key columns of each table.

    Whole-number parent keys are a set of bits; if that may be broadcast, children are counted by
    their own key alone, with their foreign key looked up on the way. Else a parent key and the
    children that name it meet in the group of that key, so foreign keys take no join. Rows combine
    before the shuffle in both, so a key that most children share is one record a task.
    """
    of_parents = _key_records(PARENT_TABLE, "_p_keys", "_p_groups", "_p_rows")
    of_children = _key_records(CHILD_TABLE, "_c_keys", "_c_groups", "_c_rows")
    of_children += _foreign_key_records(CHILD_TABLE, "_valid", "_given")
    known = None
    if is_whole(parents, PARENT_KEY):
        words, size = write_sized(key_words(parents, PARENT_KEY))
        known = small_set(words, limits, size)
    if known is None:
        return _meeting_keys(parents, children).select(inline_structs(of_parents + of_children))
    marked = mark_members(children.select(CHILD_KEY, PARENT_KEY), PARENT_KEY, known, "_member")
    groups = marked.groupBy(CHILD_KEY).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(PARENT_KEY).alias("given"),
        F.count(F.when(F.col("_member"), 1)).alias("valid"),
    )
    total = lambda n: F.coalesce(F.sum(n), F.lit(0))
    counted = groups.agg(
        F.count(CHILD_KEY).alias("_c_keys"),
        F.count(F.lit(1)).alias("_c_groups"),
        total("n").alias("_c_rows"),
        total("valid").alias("_valid"),
        total("given").alias("_given"),
    )
    measured = set_totals(words).toDF("_p_keys", "_p_groups", "_p_rows").select(inline_structs(of_parents))
    return measured.unionByName(counted.select(inline_structs(of_children)))


def _meeting_keys(parents: DataFrame, children: DataFrame) -> DataFrame:
    kinds = {"parent_key": parents.schema[PARENT_KEY].dataType.simpleString(), "child_key": children.schema[CHILD_KEY].dataType.simpleString()}
    of_parents = _key_rows(parents, [("parent_key", PARENT_KEY, "parent")], kinds)
    of_children = _key_rows(children, [("parent_key", PARENT_KEY, "child"), ("child_key", CHILD_KEY, "child")], kinds)
    n = lambda side: F.count(F.when(F.col("side") == side, 1)).alias(side)
    groups = of_parents.unionByName(of_children).groupBy("domain", *kinds).agg(n("parent"), n("child"))
    owner, known = F.col("domain") == "parent_key", F.col("parent") > 0
    given = owner & F.col("parent_key").isNotNull()
    total = lambda condition, n: F.coalesce(F.sum(F.when(condition, F.col(n))), F.lit(0))
    return groups.agg(
        F.count(F.when(given & known, 1)).alias("_p_keys"),
        F.count(F.when(owner & known, 1)).alias("_p_groups"),
        total(owner, "parent").alias("_p_rows"),
        F.count(F.when(~owner & F.col("child_key").isNotNull(), 1)).alias("_c_keys"),
        F.count(F.when(~owner, 1)).alias("_c_groups"),
        total(~owner, "child").alias("_c_rows"),
        total(given & known, "child").alias("_valid"),
        total(given, "child").alias("_given"),
    )


def dataset_measures(tables: Mapping[str, DataFrame], settings: Settings) -> DataFrame:
    """All measures of a dataset from two passes over each table: its columns, and its keys."""
    parents, children = tables[PARENT_TABLE], tables[CHILD_TABLE]
    parts = [
        column_measures(parents, PARENT_METRICS, settings),
        column_measures(children, CHILD_METRICS, settings),
    ]
    alike = PARENT_KEY in parents.columns and {PARENT_KEY, CHILD_KEY} <= set(children.columns)
    if alike and parents.schema[PARENT_KEY].dataType == children.schema[PARENT_KEY].dataType:
        parts.append(key_pass(parents, children))
    else:
        parts += [
            key_measures(parents, PARENT_METRICS),
            key_measures(children, CHILD_METRICS),
            foreign_key_measures(children, parents),
        ]
    return reduce(DataFrame.unionByName, parts)


def add_up(measures: DataFrame, *by: str) -> DataFrame:
    """Measures to metrics; a share of nothing is null."""
    value = F.when(
        F.col("is_share"), F.try_divide(F.col("num").cast("double"), F.col("den"))
    ).otherwise(F.col("num").cast("double"))
    return (
        measures.where(F.col("scope") != COUNTS)
        .groupBy(*by, *METRIC_KEY, "is_share")
        .agg(F.sum("num").alias("num"), F.sum("den").alias("den"))
        .select(*by, *METRIC_KEY, value.alias("metric_value"))
    )


def quality_metrics(tables: Mapping[str, DataFrame], settings: Settings = Settings()) -> DataFrame:
    return add_up(dataset_measures(tables, settings))


def _side_measures(sides: Mapping[str, Mapping[str, DataFrame]], settings: Settings) -> DataFrame:
    measured = [dataset_measures(tables, settings).withColumn("side", F.lit(side)) for side, tables in sides.items()]
    return reduce(DataFrame.unionByName, measured)


def measure_states(sides: Mapping[str, Mapping[str, DataFrame]], settings: Settings = Settings()) -> DataFrame:
    """Written sums of every measure of each named side: ``side``, the metric's key, ``num, den``."""
    sums = _side_measures(sides, settings).groupBy("side", *METRIC_KEY, "is_share")
    return materialize(sums.agg(F.sum("num").alias("num"), F.sum("den").alias("den")))


def compare_states(states: DataFrame) -> DataFrame:
    """``scope, table, column, metric_name, before, after, delta``; null where a side has none."""
    both = add_up(states, "side").groupBy(*METRIC_KEY).agg(
        *[
            F.max(F.when(F.col("side") == side, F.col("metric_value"))).alias(side)
            for side in ("before", "after")
        ]
    )
    return both.withColumn("delta", F.col("after") - F.col("before"))


def compare_metrics(
    before: Mapping[str, DataFrame],
    after: Mapping[str, DataFrame],
    settings: Settings = Settings(),
) -> DataFrame:
    return compare_states(_side_measures({"before": before, "after": after}, settings))


def completeness_counts(measures: DataFrame, *by: str) -> DataFrame:
    """``table, column, non_null_count, completeness_pct`` per column, from measures or states."""
    shares = measures.where(F.col("metric_name") == "completeness_pct").groupBy(*by, "table", "column")
    sums = shares.agg(F.sum("num").alias("non_null_count"), F.sum("den").alias("_rows"))
    share = F.try_divide(F.col("non_null_count").cast("double"), F.col("_rows"))
    return sums.select(*by, "table", "column", "non_null_count", share.alias("completeness_pct"))


def key_counts(measures: DataFrame, *by: str) -> DataFrame:
    """``table, unique_pk_count, duplicate_pk_rows, pk_uniqueness_pct``, from measures or states.

    Duplicate rows are those beyond the first of each key, a missing key being a key of its own.
    """
    num = lambda name: F.sum(F.when(F.col("metric_name") == name, F.col("num")))
    rows = F.sum(F.when(F.col("metric_name") == "pk_uniqueness_pct", F.col("den")))
    names = ["pk_uniqueness_pct", "unique_pk_count", "duplicate_pk_rows"]
    return measures.where(F.col("metric_name").isin(names)).groupBy(*by, "table").agg(
        num("unique_pk_count").alias("unique_pk_count"),
        num("duplicate_pk_rows").alias("duplicate_pk_rows"),
        F.try_divide(num("pk_uniqueness_pct").cast("double"), rows).alias("pk_uniqueness_pct"),
    )

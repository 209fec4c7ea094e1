"""Sources: one JSON document with a row array per table, or one file set per table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulcra.catalogs import (
    CHILD_COLUMNS,
    CHILD_KEY,
    CHILD_TABLE,
    PARENT_COLUMNS,
    PARENT_KEY,
    PARENT_TABLE,
    REQUIRED_COLUMNS,
    ROW_ID,
)
from pulcra.functions import strip, try_int
from pulcra.functions.frames import as_text
from pulcra.operators.lookup import lookup_join
from pulcra.sources.document import read_rows, split_document

_COLUMN_ORDER = {PARENT_TABLE: PARENT_COLUMNS, CHILD_TABLE: CHILD_COLUMNS}


def type_keys(df: DataFrame, table: str) -> DataFrame:
    """Whole-number parent keys and trimmed child keys; the latter only beside a parent key."""
    if PARENT_KEY not in df.columns:
        return df
    typed = df.withColumn(PARENT_KEY, try_int(as_text(df, PARENT_KEY)))
    if table == CHILD_TABLE and CHILD_KEY in df.columns:
        typed = typed.withColumn(CHILD_KEY, strip(F.col(CHILD_KEY).cast("string")))
    return typed


def first_rows(df: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` rows by input position, however those are numbered; 0 means all.

    Every task keeps its own first rows only.
    """
    return df.orderBy(ROW_ID).limit(limit) if limit > 0 else df


def contract(tables: Mapping[str, DataFrame]) -> list[tuple[str, str, bool]]:
    """``(table, column, present)`` for every required column."""
    return [
        (table, column, table in tables and column in tables[table].columns)
        for table, columns in REQUIRED_COLUMNS.items()
        for column in columns
    ]


def check_contract(tables: Mapping[str, DataFrame]) -> None:
    for table in REQUIRED_COLUMNS:
        if table not in tables:
            raise ValueError(f"the input has no table {table!r}")
        missing = [c for t, c, present in contract(tables) if t == table and not present]
        if missing:
            raise ValueError(f"table {table!r} has no columns {missing}")


def contract_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table, column, present, non_null_count`` of every required column."""
    spark = next(iter(tables.values())).sparkSession
    schema = "table string, column string, present boolean"
    report = spark.createDataFrame(contract(tables), schema)
    filled = None
    for table, df in tables.items():
        present = [c for c in REQUIRED_COLUMNS.get(table, []) if c in df.columns]
        if not present:
            continue
        wide = df.agg(*[F.count(c).alias(c) for c in present])
        records = [
            F.struct(F.lit(table).alias("table"), F.lit(c).alias("column"), F.col(c).alias("n"))
            for c in present
        ]
        counts = wide.select(F.inline(F.array(*records)))
        filled = counts if filled is None else filled.unionByName(counts)
    if filled is None:
        return report.withColumn("non_null_count", F.lit(0).cast("bigint"))
    return report.join(filled, ["table", "column"], "left").select(
        "table", "column", "present", F.coalesce("n", F.lit(0)).alias("non_null_count")
    )


def read_document(spark: SparkSession, path: str, *, limit: int = 0) -> dict[str, DataFrame]:
    """Tables of one JSON object ``{table: [row objects]}``; ``source_row_id`` is the array place.

    The document is split between tasks whether it has lines or not, see ``sources.document``.
    """
    document = split_document(spark, path, list(REQUIRED_COLUMNS))
    tables = {}
    for table in REQUIRED_COLUMNS:
        if table not in document.keys:
            raise ValueError(f"the document has no table {table!r}")
        if table not in document.lines:
            raise ValueError(f"table {table!r} has no rows to take columns from")
        rows = read_rows(spark, document, table)
        found = rows.schema["row"].dataType.names
        order = _COLUMN_ORDER[table]
        names = [c for c in order if c in found] + [c for c in found if c not in order]
        rows = rows.select(F.col("place").cast("bigint").alias(ROW_ID), *[F.col(f"row.`{c}`") for c in names])
        tables[table] = type_keys(first_rows(rows, limit), table)
    check_contract(tables)
    return tables


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hand an input with fewer splits than cores to all cores, by hash of a unique key.

    Small tables often are one file with one row group, which a single task would read and clean.
    Inputs with splits enough are returned as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def number_parquet_rows(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table with ``source_row_id``: files in name order, rows as stored in each.

    Positions come from file metadata and one row count per file, so the rows are not sorted.
    """
    rows = spark.read.parquet(path)
    at = rows.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_at"),
    )
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        at.groupBy("_file")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_file", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    placed = lookup_join(
        at, offsets, key=F.col("_file"), lookup_key="_file", weight="_n", row_id=F.col("_at")
    )
    return placed.select((F.col("_offset") + F.col("_at")).alias(ROW_ID), *rows.columns)


def check_row_ids(rows: DataFrame, table: str) -> None:
    """Refuse given row ids that are null or repeated: which duplicate stays depends on them."""
    ids = rows.groupBy(F.col(ROW_ID).cast("bigint").alias(ROW_ID)).agg(F.count(F.lit(1)).alias("n"))
    if ids.where(F.col(ROW_ID).isNull() | (F.col("n") > 1)).limit(1).count():
        raise ValueError(f"{ROW_ID} of {table!r} must be unique and not null")


def read_tables(
    spark: SparkSession, paths: Mapping[str, str], *, file_format: str = "parquet", limit: int = 0
) -> dict[str, DataFrame]:
    """Tables from one file set each: Parquet, or JSON Lines whose rows carry ``source_row_id``.

    All columns are taken as text, as the rules expect raw values.
    """
    tables = {}
    for table, path in paths.items():
        if file_format == "parquet":
            rows = spark.read.parquet(path)
            if ROW_ID not in rows.columns:
                rows = number_parquet_rows(spark, path)
            else:
                check_row_ids(rows, table)
        else:
            rows = spark.read.json(path, primitivesAsString=True)
            if ROW_ID not in rows.columns:
                raise ValueError(f"rows of {table!r} need {ROW_ID}: lines have no position of their own")
            check_row_ids(rows, table)
        order = [c for c in _COLUMN_ORDER.get(table, []) if c in rows.columns]
        rest = [c for c in rows.columns if c not in order and c != ROW_ID]
        rows = rows.select(
            F.col(ROW_ID).cast("bigint"), *[as_text(rows, c).alias(c) for c in order + rest]
        )
        tables[table] = type_keys(first_rows(rows, limit), table)
    check_contract(tables)
    return tables

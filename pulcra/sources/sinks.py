"""Sinks. Every write replaces what the folder held, so a run can be repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame


def export_columns(df: DataFrame, canonical: list[str]) -> DataFrame:
    """The canonical columns the table has; audit columns are left out."""
    return df.select([c for c in canonical if c in df.columns])


def write_table(df: DataFrame, path: str, file_format: str = "csv") -> None:
    writer = df.write.mode("overwrite")
    if file_format == "csv":
        writer.option("header", True).option("encoding", "UTF-8").option("escape", '"').csv(path)
    else:
        writer.format(file_format).save(path)


def write_json(df: DataFrame, path: str) -> None:
    """A few nested rows as JSON Lines, nulls kept."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)

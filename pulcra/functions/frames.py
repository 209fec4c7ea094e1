"""Columns of a table that may lack them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulcra.functions.dates import parse_date


def as_text(df: DataFrame, column: str) -> Column:
    """The column as text; whole floating point numbers as integers.

    Spark writes a double of ten million as ``1.0E7``, which no rule would take for a key or a
    phone number.
    """
    value = F.col(column)
    if df.schema[column].dataType.typeName() not in ("double", "float"):
        return value.cast("string")
    whole = F.when(F.rint(value) == value, value.try_cast("decimal(38,0)")).cast("string")
    return F.coalesce(whole, value.cast("string"))


def text_or_null(df: DataFrame, column: str) -> Column:
    return as_text(df, column) if column in df.columns else F.lit(None).cast("string")


def as_date(df: DataFrame, column: str) -> Column:
    """The column as a date: parsed, unless it already is one or is absent."""
    if column not in df.columns:
        return F.lit(None).cast("date")
    if df.schema[column].dataType.typeName() == "date":
        return F.col(column)
    return parse_date(F.col(column).cast("string"))

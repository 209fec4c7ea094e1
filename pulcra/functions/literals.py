"""Constant columns from Python values, built in one step."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_literal(value: object) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    if isinstance(value, bool | int | float):
        return str(value)
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def lookup_constant(constants: Mapping[object, object], key: Column) -> Column:
    """Value of ``key`` in a constant map, null if it is not there."""
    pairs = ", ".join(sql_literal(part) for entry in constants.items() for part in entry)
    return F.try_element_at(F.expr(f"map({pairs})"), key)


def sql_struct(**fields: str) -> str:
    """SQL text of a struct whose fields are SQL texts themselves."""
    return "named_struct(" + ", ".join(f"'{name}', {sql}" for name, sql in fields.items()) + ")"


def inline_structs(structs: list[str]) -> Column:
    """Generator of one row per struct, from one expression instead of a call per field."""
    return F.inline(F.expr(f"array({', '.join(structs)})"))

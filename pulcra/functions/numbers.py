"""Text to number, null instead of an error.

Spark's own ``try_cast`` takes texts such as ``12d`` and refuses ``1_000``, so a pattern decides
what counts as a number and the cast only converts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulcra.catalogs import DECIMAL_PATTERN, INFINITY_PATTERN, INTEGER_PATTERN
from pulcra.functions.text import strip


def _without_groups(text: Column) -> Column:
    return F.replace(text, F.lit("_"), F.lit(""))


def try_int(value: Column) -> Column:
    """Whole number as bigint.

    JSON numbers arrive as text, so ``58.0`` counts as 58 whether it was a number or a quoted
    text in the source document.
    """
    text = strip(value.cast("string"))
    whole = F.when(text.contains("."), F.regexp_replace(text, r"\.0+$", "")).otherwise(text)
    return F.when(text.rlike(INTEGER_PATTERN), _without_groups(whole).try_cast("bigint"))


def int_text(value: Column) -> Column:
    """Whether a value is a whole number of any size; ``try_int`` is null beyond bigint."""
    return F.coalesce(strip(value.cast("string")).rlike(INTEGER_PATTERN), F.lit(False))


def try_double(value: Column) -> Column:
    """Decimal or scientific text as double; infinities are numbers, ``nan`` is null."""
    text = strip(value.cast("string"))
    numeric = text.rlike(DECIMAL_PATTERN) | text.rlike(INFINITY_PATTERN)
    return F.when(numeric, _without_groups(text).try_cast("double"))

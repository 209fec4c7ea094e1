"""Date recovery, ages and date keys."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulcra.catalogs import (
    ISO_DATE_PATTERN,
    SPANISH_DATE_PATTERN,
    SPANISH_MONTHS,
    SWAPPED_DATE_PATTERN,
)
from pulcra.functions.literals import lookup_constant
from pulcra.functions.text import strip


def _calendar_date(year: Column, month: Column, day: Column) -> Column:
    """Date of three texts; ``concat`` is null if one of them is, ``concat_ws`` would skip it."""
    return F.concat(year, F.lit("-"), month, F.lit("-"), day).try_cast("date")


def _iso(text: Column) -> Column:
    compact = F.replace(text, F.lit(" "), F.lit(""))
    return F.when(text.rlike(ISO_DATE_PATTERN), compact.try_cast("date"))


def _spanish(text: Column) -> Column:
    day, month, year = (F.regexp_extract(text, SPANISH_DATE_PATTERN, i) for i in (1, 2, 3))
    number = lookup_constant(SPANISH_MONTHS, F.lower(month))
    return F.when(text.rlike(SPANISH_DATE_PATTERN), _calendar_date(year, number.cast("string"), day))


def _swapped(text: Column) -> Column:
    year, day, month = (F.regexp_extract(text, SWAPPED_DATE_PATTERN, i) for i in (1, 2, 3))
    return F.when(text.rlike(SWAPPED_DATE_PATTERN), _calendar_date(year, month, day))


def parse_date(value: Column) -> Column:
    """Date from ``YYYY-MM-DD``, else Spanish text, else ``YYYY-DD-MM``; null if none fits.

    The order matters: a text that is a valid ISO date is never swapped.
    """
    text = strip(value)
    return F.coalesce(_iso(text), _spanish(text), _swapped(text))


def strict_iso_date(value: Column) -> Column:
    return F.coalesce(_iso(strip(value)).isNotNull(), F.lit(False))


def age_at(birth: Column, reference: date) -> Column:
    """Completed years at the reference date.

    Month and day are compared as such: someone born on 29 February is one year older from
    1 March on in common years, which ``months_between`` sees differently.
    """
    day_of_year = F.month(birth) * 100 + F.dayofmonth(birth)
    before_birthday = day_of_year > reference.month * 100 + reference.day
    return F.lit(reference.year) - F.year(birth) - before_birthday.cast("int")


def age_bounded(age: Column, low: int = 0, high: int = 120) -> Column:
    return F.when(age.between(low, high), age)


def date_key(value: Column) -> Column:
    """Integer ``yyyymmdd`` of a date, 0 for the unknown member."""
    key = F.year(value) * 10000 + F.month(value) * 100 + F.dayofmonth(value)
    return F.coalesce(key, F.lit(0))


def date_key_of_text(value: Column) -> Column:
    """``date_key`` of a zero-padded ISO text (``yyyy-mm-dd`` or ``yyyymmdd``)."""
    text = strip(value)
    dashed = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return date_key(F.when(dashed.rlike(r"^(?!0000)\d{4}-\d{2}-\d{2}$"), dashed.try_cast("date")))


def date_key_parts(key: Column) -> dict[str, Column]:
    """ISO text, year, month and day of a date key."""
    year = F.floor(key / 10000).cast("int")
    month = (F.floor(key / 100) % 100).cast("int")
    day = (key % 100).cast("int")
    return {
        "fecha_date": F.format_string("%04d-%02d-%02d", year, month, day),
        "ano": year,
        "mes": month,
        "dia": day,
    }

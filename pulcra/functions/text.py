"""Text clean-up: whitespace, catalogs, e-mail, phone, audit snippets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulcra.catalogs import EMAIL_PATTERN, WHITESPACE
from pulcra.functions.literals import lookup_constant


def strip(value: Column) -> Column:
    """Trim all Unicode whitespace; Spark's plain ``trim`` removes spaces only.

    Most texts begin and end with a visible ASCII character, which two comparisons of bytes tell.
    Those are taken as they are: ``btrim`` looks every outer character up in a list and copies it.
    """
    text = value.cast("string")
    last = F.substring(text, -1, 1)
    plain = (text >= "!") & (text < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(plain, text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def text_normalize(value: Column) -> Column:
    text = strip(value)
    return F.when(text != "", text)


def normalize_catalog(value: Column, catalog: Mapping[str, str]) -> Column:
    """Canonical value of a raw text, null where the catalog does not know it."""
    return lookup_constant(catalog, F.lower(strip(value)))


def email_valid(value: Column) -> Column:
    return F.coalesce(strip(value).rlike(EMAIL_PATTERN), F.lit(False))


def email_normalize(value: Column) -> Column:
    lowered = F.lower(strip(value))
    return F.when(lowered.rlike(EMAIL_PATTERN), lowered)


def phone_digits(value: Column) -> Column:
    return F.nullif(F.regexp_replace(value, r"(?U)\D+", ""), F.lit(""))


def phone_gate(digits: Column, low: int, high: int) -> Column:
    return F.when(F.char_length(digits).between(low, high), digits)


def truncate_text(value: Column, max_len: int = 140) -> Column:
    """One-line audit snippet: null as ``NULL``, line feeds as spaces, cut with an ellipsis."""
    flat = strip(F.replace(F.coalesce(value, F.lit("NULL")), F.lit("\n"), F.lit(" ")))
    cut = F.concat(F.substring(flat, 1, max_len - 3), F.lit("..."))
    return F.when(F.char_length(flat) > max_len, cut).otherwise(flat)

"""Whole-row comparison."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _texts(columns: Iterable[str]) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]


def row_signature(columns: Iterable[str], separator: str = "|") -> Column:
    """The named columns as one text, null and empty alike."""
    return F.concat_ws(separator, *_texts(columns))


def row_fingerprint(columns: Iterable[str]) -> tuple[Column, Column]:
    """128 bits that stand for a row's values, as two bigints.

    Two rows with different values share both halves with a chance of 2**-128 each, so equal
    halves are taken as equal rows. Fixed-width halves let a group-by keep its buffers in place
    and shuffle 16 bytes per row instead of the row. Each column is hashed on top of the previous
    one, so ``('a', 'b')`` and ``('ab', '')`` differ.
    """
    texts = _texts(columns)
    return F.xxhash64(*texts), F.xxhash64(F.lit("second half"), *reversed(texts))


def value_fingerprint(columns: Iterable[str]) -> tuple[Column, Column]:
    """128 bits of a row's values as they are; unlike :func:`row_fingerprint` a null is a value of
    its own. Equal rows have equal bits; unequal ones may share them and have to be looked at."""
    names = list(columns)
    values = [F.col(c) for c in names]
    nulls = F.array(*[v.isNull() for v in values]) if names else F.lit(0)
    return F.xxhash64(nulls, *values), F.xxhash64(F.lit("second half"), nulls, *reversed(values))

"""Column -> Column expressions. Everything here is a built-in expression; no UDF."""

from pulcra.functions.dates import (
    age_at,
    age_bounded,
    date_key,
    date_key_of_text,
    date_key_parts,
    parse_date,
    strict_iso_date,
)
from pulcra.functions.numbers import int_text, try_double, try_int
from pulcra.functions.rows import row_fingerprint, row_signature, value_fingerprint
from pulcra.functions.text import (
    email_normalize,
    email_valid,
    normalize_catalog,
    phone_digits,
    phone_gate,
    strip,
    text_normalize,
    truncate_text,
)

__all__ = [
    "age_at",
    "age_bounded",
    "date_key",
    "date_key_of_text",
    "date_key_parts",
    "email_normalize",
    "email_valid",
    "normalize_catalog",
    "parse_date",
    "phone_digits",
    "phone_gate",
    "row_fingerprint",
    "row_signature",
    "strict_iso_date",
    "strip",
    "text_normalize",
    "truncate_text",
    "try_double",
    "int_text",
    "try_int",
    "value_fingerprint",
]

"""Run settings handed to every operator that needs a bound or a reference date."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class Settings:
    # Results must agree on these defaults.
    reference_date: date = date(2026, 3, 18)
    age_tolerance_years: int = 2
    phone_min_digits: int = 10
    phone_max_digits: int = 15
    age_min: int = 0
    age_max: int = 120


@dataclass(frozen=True)
class JoinLimits:
    """When a lookup table is broadcast, and which keys count as hot beyond that.

    ``broadcast_bytes`` bounds a lookup that is sent to every executor whole.
    ``hot_rows`` is the number of rows from which one key is dealt over several tasks.
    """

    broadcast_bytes: int = 64 * 1024 * 1024
    hot_rows: int = 1_000_000

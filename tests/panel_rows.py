"""The small sales panel of the tests: its first day and its demand."""

from __future__ import annotations

from datetime import date

ORIGIN = date(2015, 1, 1)


def sales_of(series: int, day: int) -> int:
    """Known demand with zeros, a weekly shape, and a late start of the odd series."""
    if series % 2 and day < 100:
        return 0
    return ((day * (series + 3)) % 11) * (1 if (day + series) % 3 else 0) + (2 if day % 7 >= 5 else 0)

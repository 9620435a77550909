"""Ids and labels derived from a UTC timestamp, as SQL expressions."""

from __future__ import annotations


def date_id(ts: str) -> str:
    """Days since 1970-01-01."""
    return f"unix_date(to_date({ts}))"


def time_of_day_id(ts: str) -> str:
    """Whole seconds since midnight."""
    return f"hour({ts}) * 3600 + minute({ts}) * 60 + second({ts})"


def seconds_from_ms(ms: str) -> str:
    """Milliseconds to whole seconds, halves away from zero."""
    return f"cast(round({ms} / 1000) as int)"


def micros_text(ts: str) -> str:
    """``yyyy-MM-dd HH:mm:ss`` with six decimals."""
    return f"date_format({ts}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"

"""Time expressions as SQL text for ``selectExpr``, ``filter`` and ``F.expr``.

Everything is ``timestamp_ntz``, so no result depends on the session zone.
"""

from __future__ import annotations

from datetime import datetime, timedelta

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
# unix_timestamp cuts fractions towards zero, which floors only from 1970 on. Earlier times
# are moved up by a full Gregorian cycle of 146097 days first.
CYCLE_DAYS = 146097


def at(value: str | datetime) -> datetime:
    """A Python datetime without a zone, from text or a datetime."""
    if not isinstance(value, datetime):
        value = datetime.fromisoformat(value)
    return value.replace(tzinfo=None)


def ts_lit(value: str | datetime, plus_minutes: int = 0) -> str:
    """A timestamp literal, optionally some minutes later; a zone on the value is dropped."""
    moved = at(value) + timedelta(minutes=plus_minutes)
    return f"timestamp_ntz'{moved.isoformat(sep=' ')}'"


def seconds(ts: str) -> str:
    """Whole seconds since 1970, rounded down."""
    early = f"unix_timestamp({ts} + INTERVAL '{CYCLE_DAYS}' DAY) - {CYCLE_DAYS * 86400}L"
    return f"(CASE WHEN {ts} >= {EPOCH} THEN unix_timestamp({ts}) ELSE {early} END)"


def floor_index(ts: str, width_seconds: int, plus_seconds: int = 0) -> str:
    """Number of the fixed-width interval that holds ``ts``, or ``ts`` some seconds later.

    Integer work only: adding intervals to every row would cost a calendar computation each.
    """
    return f"floor(({seconds(ts)} + {plus_seconds}) / {width_seconds})"


def interval_start(index: str, width_seconds: int) -> str:
    return f"({EPOCH} + {index} * INTERVAL '{width_seconds}' SECOND)"


def floor_to(ts: str, width_seconds: int) -> str:
    """Start of the half-open interval ``[start, start + width)`` that holds ``ts``."""
    return interval_start(floor_index(ts, width_seconds), width_seconds)


def shift(ts: str, minutes: int | str) -> str:
    """``ts`` moved by a number of minutes, which may be a column."""
    if isinstance(minutes, int):
        return f"({ts} + INTERVAL '{minutes}' MINUTE)"
    return f"({ts} + {minutes} * INTERVAL '1' MINUTE)"


def minutes_between(start: str, end: str) -> str:
    """Exact length of ``end - start`` in minutes, to the microsecond."""
    length = f"cast(cast({end} - {start} AS interval second) AS decimal(18,6))"
    return f"(cast({length} AS double) / 60.0D)"


def calendar(ts: str) -> dict[str, str]:
    """Hour, weekday with Monday 0, and the weekend flag."""
    return {
        "hour": f"hour({ts})",
        "day_of_week": f"weekday({ts})",
        "is_weekend": f"cast(weekday({ts}) IN (5, 6) AS int)",
    }


def named(columns: dict[str, str]) -> list[str]:
    """``expression AS name`` for every entry."""
    return [f"{expression} AS {name}" for name, expression in columns.items()]

"""The two epoch rules, day keys and report time texts."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Epoch rules and text formats of the reports.
SECONDS_DIGITS = 10
MILLIS_DIGITS = 13
SECONDS_BELOW = 100_000_000_000
DAY_TEXT = "yyyyMMdd"
PT_TEXT = "yyyy-MM-dd"
SECOND_TEXT = "yyyy-MM-dd HH:mm:ss"


def log_time(ts: Column) -> Column:
    """Log rule: ten characters are seconds, thirteen are milliseconds, others no time."""
    width = F.length(ts.cast("string"))
    return F.when(width == SECONDS_DIGITS, F.timestamp_seconds(ts)).when(
        width == MILLIS_DIGITS, F.timestamp_millis(ts)
    )


def order_time(ts: Column) -> Column:
    """Order rule: small epochs are seconds, all others milliseconds."""
    return F.timestamp_millis(F.when(ts < SECONDS_BELOW, ts * 1000).otherwise(ts))


def epoch_from(ts: Column, since: Column) -> Column:
    """``order_time(ts) >= since`` on the raw epoch, so that a columnar scan can skip blocks.

    ``since`` must fall on a whole second.
    """
    return ((ts >= SECONDS_BELOW) & (ts >= F.unix_millis(since))) | (
        (ts < SECONDS_BELOW) & (ts >= F.unix_seconds(since))
    )


def day_text(ts: Column) -> Column:
    """Day key ``yyyyMMdd`` in the session zone."""
    return F.date_format(ts, DAY_TEXT)


def pt_of_day_text(day: Column) -> Column:
    """``yyyyMMdd`` text to the partition date."""
    return F.to_date(day, DAY_TEXT)


def second_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; zone-free times keep their wall clock."""
    return F.date_format(ts, SECOND_TEXT)


def wall_clock(ts: Column) -> Column:
    """Local wall clock of an instant (session zone); zone-free times pass unchanged."""
    return ts.cast("timestamp_ntz")


def second_of_day(wall: Column) -> Column:
    return F.hour(wall) * 3600 + F.minute(wall) * 60 + F.second(wall)


def floor_to_step(epoch_seconds: Column, step_seconds: int = 300) -> Column:
    """Aligned tick at or before an epoch second (five minutes by default)."""
    return epoch_seconds - F.pmod(epoch_seconds, F.lit(step_seconds))


def as_date(as_of: date | datetime | str | Column | None) -> Column:
    """The "today" of a report: a given day, or the current one in the session zone."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    return F.lit(str(as_of)[:10]).cast("date")


def start_of_day(as_of: date | datetime | str | Column | None) -> Column:
    """Midnight of that day in the session zone."""
    return as_date(as_of).cast("timestamp")


def start_of_day_millis(as_of: date | datetime | str | Column | None) -> Column:
    return F.unix_millis(start_of_day(as_of))

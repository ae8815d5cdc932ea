"""Cumulative windows: ``[start, start + k * step)`` for every k up to the window size.

Copying each row into all its windows would multiply the input by up to ``size / step``.
Instead rows are summed once per step slot (partially before the shuffle), a running total
per key is taken over at most ``size / step`` slot rows, and only that small result is
spread over the windows that follow a slot.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailtide.functions.times import second_of_day, wall_clock

DAY = 86_400

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


@dataclass(frozen=True)
class Steps:
    """Step and size in seconds; windows are aligned to the local wall clock."""

    step: int = 600
    size: int = DAY

    def __post_init__(self) -> None:
        if self.step <= 0 or self.size % self.step:
            raise ValueError("size must be a positive multiple of step")

    @property
    def last(self) -> int:
        return self.size // self.step - 1

    def position(self, bucket: int, slot: int) -> int:
        """Windows numbered by their end, over all window starts."""
        return bucket * (self.last + 1) + slot


# Aggregates that can be carried on from slot to slot. Sums must fail on overflow rather than
# turn null: the next level would skip the null and report too little.
_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
_FIRST = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def with_slot(df: DataFrame, ts: str, steps: Steps = Steps()) -> DataFrame:
    """Add ``bucket`` (window start, in sizes since the epoch) and ``slot`` (0-based step)."""
    wall = wall_clock(F.col(ts))
    second = second_of_day(wall)
    if steps.size == DAY:
        bucket, within = F.unix_date(wall.cast("date")), second
    else:
        local = F.unix_date(wall.cast("date")).cast("bigint") * DAY + second
        bucket = F.floor(local / steps.size).cast("int")
        within = F.pmod(local, F.lit(steps.size))
    return (
        df.filter(F.col(ts).isNotNull())
        .withColumn("bucket", bucket)
        .withColumn("slot", F.floor(within / steps.step).cast("int"))
    )


def slot_totals(
    df: DataFrame,
    ts: str,
    keys: list[str],
    aggs: dict[str, tuple[str, str | Column]],
    steps: Steps = Steps(),
) -> DataFrame:
    """One row per window start, slot and key. ``aggs`` is ``name -> (function, column)``."""
    columns = [_FIRST[fn](col).alias(name) for name, (fn, col) in aggs.items()]
    return with_slot(df, ts, steps).groupBy("bucket", "slot", *keys).agg(*columns)


def running_totals(
    slots: DataFrame,
    keys: list[str],
    aggs: dict[str, str],
    extra: list[Column] | None = None,
) -> DataFrame:
    """Totals from the window start to each slot that has rows, plus the next such slot."""
    by_key = Window.partitionBy("bucket", *keys).orderBy("slot")
    so_far = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return slots.select(
        "bucket",
        "slot",
        *keys,
        *[_MERGE[fn](name).over(so_far).alias(name) for name, fn in aggs.items()],
        F.lead("slot").over(by_key).alias("next_slot"),
        *(extra or []),
    )


def fill_windows(
    running: DataFrame, steps: Steps = Steps(), after: int | None = None, upto: int | None = None
) -> DataFrame:
    """Repeat each running total until the key's next slot, or the end of the window.

    ``after`` and ``upto`` limit the windows by position, so that a stream makes only those
    that closed since its last batch.
    """
    first = F.col("slot")
    until = F.coalesce(F.col("next_slot") - 1, F.lit(steps.last))
    base = F.col("bucket").cast("bigint") * (steps.last + 1)
    if after is not None:
        first = F.greatest(first, (F.lit(after + 1) - base).cast("int"))
    if upto is not None:
        until = F.least(until, (F.lit(upto) - base).cast("int"))
    others = [c for c in running.columns if c not in ("slot", "next_slot")]
    return running.filter(first <= until).select(
        *others, F.explode(F.sequence(first, until)).alias("slot")
    )


def window_start(steps: Steps = Steps()) -> Column:
    return F.timestamp_add(
        "SECOND", F.col("bucket").cast("bigint") * steps.size, F.expr(_EPOCH)
    )


def window_end(steps: Steps = Steps()) -> Column:
    seconds = F.col("bucket").cast("bigint") * steps.size + (F.col("slot") + 1) * steps.step
    return F.timestamp_add("SECOND", seconds, F.expr(_EPOCH))


def with_bounds(df: DataFrame, steps: Steps = Steps()) -> DataFrame:
    """Replace ``bucket`` and ``slot`` by zone-free ``window_start`` and ``window_end``."""
    others = [c for c in df.columns if c not in ("bucket", "slot")]
    return df.select(
        window_start(steps).alias("window_start"), window_end(steps).alias("window_end"), *others
    )


def cumulate(
    df: DataFrame,
    ts: str,
    keys: list[str],
    aggs: dict[str, tuple[str, str | Column]],
    steps: Steps = Steps(),
) -> DataFrame:
    """Cumulative-window aggregate: one row per window and key that has rows so far."""
    slots = slot_totals(df, ts, keys, aggs, steps)
    running = running_totals(slots, keys, {name: fn for name, (fn, _) in aggs.items()})
    return with_bounds(fill_windows(running, steps), steps)

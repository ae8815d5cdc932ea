"""Broadcast only what was measured."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_LIMIT = 64 * 1024 * 1024
_ROW_OVERHEAD = 32


def measured_bytes(df: DataFrame) -> int:
    """Size of a lookup side: text widths plus a fixed cost per row and column."""

    def width(name: str) -> Column:
        text = F.col(f"`{name}`").cast("string")
        return F.coalesce(F.octet_length(text), F.lit(0)) + 8

    row = sum((width(c) for c in df.columns), F.lit(_ROW_OVERHEAD))
    return df.agg(F.coalesce(F.sum(row), F.lit(0)).alias("bytes")).first()["bytes"]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Mark a lookup side for broadcast when its measured size is within ``limit``.

    Beyond it the side stays unmarked: Spark shuffles both sides and adaptive execution
    splits hot keys.
    """
    return F.broadcast(df) if measured_bytes(df) <= limit else df

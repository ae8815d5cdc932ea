"""Newest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Last row of each key by ``order``. An aggregate, so copies collapse before the shuffle."""
    others = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*[F.col(f"`{c}`") for c in others]), order)
    return df.groupBy(*keys).agg(newest.alias("__row")).select(*keys, "__row.*").select(*df.columns)

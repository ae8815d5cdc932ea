"""Is a word in a named set.

The joins are not marked: adaptive execution broadcasts the set when its shuffled size turns out
small (``spark.sql.adaptive.autoBroadcastJoinThreshold``), at no extra pass over it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def members(sets: DataFrame, name: str | None = None) -> DataFrame:
    """Distinct words of one set; ``sets`` has ``word`` and, when it holds several, ``set_name``."""
    chosen = sets if name is None else sets.filter(F.col("set_name") == name)
    return chosen.select("word").filter("word is not null").distinct()


def _lookup(column: str, words: DataFrame) -> DataFrame:
    return words.select(F.col("word").alias(column))


def in_set(df: DataFrame, column: str, words: DataFrame) -> DataFrame:
    return df.join(_lookup(column, words), column, "left_semi")


def not_in_set(df: DataFrame, column: str, words: DataFrame) -> DataFrame:
    return df.join(_lookup(column, words), column, "left_anti")


def flag_in_set(
    df: DataFrame,
    column: str,
    words: DataFrame,
    flag: str = "is_member",
) -> DataFrame:
    """Keep every row and say whether its word is a member. ``words`` must be distinct."""
    side = _lookup(column, words).withColumn(flag, F.lit(True))
    return df.join(side, column, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))

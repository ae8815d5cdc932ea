"""Exact distinct counts that merge: a value has a dense number, a set of values is bitmaps over them.

A day's users of a page are one bitmap per 32,768 numbers. Sets of days and pages are joined by OR, so a
count over any span never lists users, and a page with very many of them is a few bitmaps when it is
shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Parts in which values are numbered side by side.
NUMBER_PARTS = 1024


def numbered(values: DataFrame, value: str, parts: int = NUMBER_PARTS) -> DataFrame:
    """``value, number``: every distinct value, not null, with a number from 1 on, without gaps.

    Values are numbered within parts by a hash; the parts' offsets are ``parts`` rows, whatever the input.
    """
    part = F.pmod(F.xxhash64(value), F.lit(parts)).cast("int")
    dealt = values.filter(F.col(value).isNotNull()).select(value).distinct().withColumn("part", part)
    ranked = dealt.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy(value)))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return ranked.join(F.broadcast(offsets), "part").select(value, (F.col("offset") + F.col("place")).alias("number"))


def bitmaps(rows: DataFrame, keys: list[str], number: str = "number") -> DataFrame:
    """``keys, bucket, bitmap``: the set of numbers of each key."""
    bucket = F.bitmap_bucket_number(number).alias("bucket")
    return rows.groupBy(*keys, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap"))


def merged(sets: DataFrame, keys: list[str]) -> DataFrame:
    """The sets of several rows as one per key and bucket."""
    return sets.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def counted(sets: DataFrame, keys: list[str], name: str = "users") -> DataFrame:
    """Members of each key's set; there must be one row per bucket."""
    return sets.groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).alias(name))


def over_days(sets: DataFrame, keys: list[str], spans: tuple[int, ...], day: str = "day") -> DataFrame:
    """``keys, day`` and, per span, the members of the days that end with it, for all days of the sets.

    A day's bitmap goes to each day whose longest span it is in; shorter spans take part of the same rows.
    """
    present = sets.select(day).distinct()
    ends = F.explode(F.sequence(F.col(day), F.date_add(day, max(spans) - 1))).alias("end")
    spread = sets.select("*", ends).join(
        F.broadcast(present.select(F.col(day).alias("end"))), "end", "left_semi"
    )
    within = lambda n: F.when(F.col(day) > F.date_sub("end", n), F.col("bitmap"))
    whole = spread.groupBy(*keys, "end", "bucket").agg(*[F.bitmap_or_agg(within(n)).alias(f"b{n}") for n in spans])
    counts = [F.sum(F.coalesce(F.bitmap_count(f"b{n}"), F.lit(0))).alias(f"users_{n}") for n in spans]
    return whole.groupBy(*keys, F.col("end").alias(day)).agg(*counts)

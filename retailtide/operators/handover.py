"""From a snapshot to the changes after it, as one feed that is complete and never stale.

A large table is read chunk by chunk while changes go on. Around each chunk two marks are taken in the
change feed: every change up to ``low`` is in the chunk's rows, none after ``high`` is, and of those
between nobody knows. So a row whose key has a change between the marks is left out, as that change brings
its newest image anyway, and the others take the place of the mark ``high`` in the feed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kind of a record that comes from the snapshot.
READ = "r"
DELETE = "d"


def read_in_chunks(
    read: Callable[[Column], DataFrame], chunks: Iterable[Column], mark: Callable[[], int], path: str
) -> DataFrame:
    """Write the rows of each chunk below ``path`` between two marks, and read them all back.

    ``read`` gives the rows that meet a condition, ``mark`` the present position of the change feed. A
    chunk is read by Spark like any table; only its two marks pass the driver. A chunk that was written
    before, in a run that was lost, is not read again.
    """
    spark = None
    for number, condition in enumerate(chunks):
        rows = read(condition)
        spark = rows.sparkSession
        place = f"{path.rstrip('/')}/chunk={number}"
        low = mark()
        rows.withColumn("low", F.lit(low).cast("long")).write.mode("overwrite").parquet(f"{place}/rows")
        spark.createDataFrame([(mark(),)], "high long").write.mode("overwrite").parquet(f"{place}/mark")
    if spark is None:
        raise ValueError("a snapshot needs at least one chunk")
    root = path.rstrip("/")
    read_rows = spark.read.option("basePath", root).parquet(f"{root}/chunk=*/rows")
    marks = spark.read.option("basePath", root).parquet(f"{root}/chunk=*/mark")
    return read_rows.join(marks, "chunk")


def joined_feed(snapshot: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """``key, op, image, position, from_snapshot`` of the rows and changes that the feed has.

    ``snapshot`` is ``key, image, low, high``, ``changes`` is ``key, op, image, seq``, with one type of image.
    The test for changes between the marks is an inner join, in which a key with very many changes can
    be split, and its answer is one row per key.
    """
    marks = snapshot.select(key, "low", "high")
    between = changes.select(key, "seq").join(marks, key).filter("seq > low and seq <= high")
    touched = between.select(key, "high").distinct()
    kept = snapshot.join(touched, [key, "high"], "left_anti").select(
        key, F.lit(READ).alias("op"), "image", F.col("high").alias("position"), F.lit(True).alias("from_snapshot")
    )
    return kept.unionByName(
        changes.select(key, "op", "image", F.col("seq").alias("position"), F.lit(False).alias("from_snapshot"))
    )


def newest_state(feed: DataFrame, key: str) -> DataFrame:
    """The present image of every key that is not deleted."""
    last = F.max_by(F.struct("op", "image"), F.struct("position", "from_snapshot")).alias("last")
    return feed.groupBy(key).agg(last).filter(F.col("last.op") != DELETE).select(key, F.col("last.image").alias("image"))

"""Day partitions a report table keeps, and clearing them."""

from __future__ import annotations

import re
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailtide.functions.times import as_date

# Days kept before and after today.
DAYS_BACK = 30
DAYS_AHEAD = 30


def kept(
    df: DataFrame, as_of=None, back: int = DAYS_BACK, ahead: int = DAYS_AHEAD, pt: str = "pt"
) -> DataFrame:
    """Rows of the kept days; on a table partitioned by ``pt`` only those folders are read."""
    today = as_date(as_of)
    return df.filter(
        (F.col(pt) >= F.date_sub(today, back)) & (F.col(pt) <= F.date_add(today, ahead))
    )


def _delete_days(spark: SparkSession, path: str, pt: str, before: date | None) -> list[str]:
    """Remove day folders by name; no rows are read."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    removed = []
    for status in files.listStatus(root):
        name = status.getPath().getName()
        day = re.fullmatch(rf"{re.escape(pt)}=(\d{{4}}-\d\d-\d\d)", name)
        if day and (before is None or date.fromisoformat(day[1]) < before):
            files.delete(status.getPath(), True)
            removed.append(name)
    return sorted(removed)


def drop_expired(
    spark: SparkSession, path: str, as_of: date, back: int = DAYS_BACK, pt: str = "pt"
) -> list[str]:
    """Delete the days before the kept range of a partitioned table."""
    return _delete_days(spark, path, pt, as_of - timedelta(days=back))


def truncate(spark: SparkSession, path: str, pt: str = "pt") -> list[str]:
    """Delete every day of a partitioned table."""
    return _delete_days(spark, path, pt, None)

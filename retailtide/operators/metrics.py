"""Counts behind the behaviour-log reports, keyed by the log's day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailtide.functions.texts import (
    UNKNOWN_NAME,
    UNKNOWN_VERSION,
    lower_or,
)

IDS_PER_ROW = 100_000


def device_columns() -> list[Column]:
    """System, brand and version of a log row in lower case, with defaults."""
    return [
        lower_or(F.col("device.plat"), UNKNOWN_NAME).alias("os"),
        lower_or(F.col("device.brand"), UNKNOWN_NAME).alias("brand"),
        lower_or(F.col("device.platv"), UNKNOWN_VERSION).alias("platv"),
    ]


def device_counts(logs: DataFrame, day: str = "day") -> DataFrame:
    return (
        logs.select(day, *device_columns())
        .groupBy(day, "os", "brand", "platv")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def page_user_counts(logs: DataFrame, day: str = "day") -> DataFrame:
    """Views per page and user; rows without a user share a null id."""
    user = F.nullif(F.col("user_id").cast("string"), F.lit("")).alias("user_id")
    return (
        logs.select(day, F.col("log_type").alias("page"), user)
        .groupBy(day, "page", "user_id")
        .agg(F.count(F.lit(1)).alias("views"))
    )


def page_views(user_counts: DataFrame, day: str = "day") -> DataFrame:
    """Views and distinct users per page. Each user is one row by now, so plain counts do."""
    return user_counts.groupBy(day, "page").agg(
        F.sum("views").alias("pv"), F.count("user_id").alias("users")
    )


def page_user_lists(
    user_counts: DataFrame, day: str = "day", ids_per_row: int = IDS_PER_ROW
) -> DataFrame:
    """Views and the whole list of users per page.

    A page's list may outgrow one row and one task, so it is spread by a hash of the id
    over ``chunks`` rows of about ``ids_per_row`` ids, numbered by ``chunk``. ``pv`` and ``users`` are
    the page's own and stand on chunk 0 alone, which every page has, so they can be summed.
    """
    # every row has views, and pages are never null here; asking keeps all uses below on the same
    # plan, which then runs once
    user_counts = user_counts.filter(
        (F.col("views") > 0) & F.col(day).isNotNull() & F.col("page").isNotNull()
    )
    totals = page_views(user_counts, day).withColumn(
        "chunks", F.greatest(F.lit(1), F.ceil(F.col("users") / ids_per_row)).cast("int")
    )
    chunk = F.when(F.col("user_id").isNull(), 0).otherwise(F.pmod(F.xxhash64("user_id"), F.col("chunks")).cast("int"))
    ids = (
        user_counts.select(day, "page", "user_id")
        .join(totals.select(day, "page", "chunks"), [day, "page"])
        .select(day, "page", "chunks", chunk.alias("chunk"), "user_id")
    )
    none = F.lit(None)
    heads = totals.select(
        day, "page", "chunks", F.lit(0).alias("chunk"), none.cast("string").alias("user_id"), "pv", "users"
    )
    rows = ids.withColumns({n: none.cast("bigint") for n in ("pv", "users")}).unionByName(heads)
    return rows.groupBy(day, "page", "chunks", "chunk").agg(
        F.max("pv").alias("pv"),
        F.max("users").alias("users"),
        F.array_sort(F.collect_list("user_id")).alias("user_ids"),
    )


def keyword_counts(words: DataFrame, day: str = "day") -> DataFrame:
    """Searches per day and word, of rows made by ``keyword_rows``."""
    return words.groupBy(day, "keyword").agg(F.count(F.lit(1)).alias("cnt"))


def address_counts(logs: DataFrame, day: str = "day") -> DataFrame:
    """Hits per address with the time of the newest, ahead of the region lookup."""
    return logs.groupBy(day, F.col("gis.ip").alias("ip")).agg(
        F.count(F.lit(1)).alias("count"), F.max("event_time").alias("newest")
    )


def region_counts(addresses: DataFrame, day: str = "day") -> DataFrame:
    """Hits per day and raw region, with the address of the newest hit (ties: the greatest)."""
    return addresses.groupBy(day, F.col("region").alias("region_raw")).agg(
        F.sum("count").alias("count"),
        F.max_by("ip", F.struct("newest", "ip")).alias("ip"),
        F.max("newest").alias("newest"),
    )

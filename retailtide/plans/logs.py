"""Behaviour-log reports: device, page, search words, region heat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailtide.functions import texts
from retailtide.functions.times import as_date
from retailtide.operators import iprange, metrics, parse
from retailtide.operators.bounded import BROADCAST_LIMIT
from retailtide.operators.ranking import top_k

TOP_WORDS = 10


def with_day(logs: DataFrame) -> DataFrame:
    """Add the log's day in the session zone."""
    return logs.withColumn("day", F.col("event_time").cast("date"))


def day_type(day: Column, as_of=None) -> Column:
    return F.when(day == as_date(as_of), texts.TYPE_TODAY).otherwise(texts.TYPE_HISTORY)


def device_columns(counts: DataFrame, as_of=None) -> DataFrame:
    """Report columns of the device counts."""
    return counts.select(
        F.col("day").alias("pt"),
        "os",
        "brand",
        "platv",
        "count",
        day_type(F.col("day"), as_of).alias("type"),
    )


def device_report(logs: DataFrame, as_of=None) -> DataFrame:
    return device_columns(metrics.device_counts(logs), as_of)


def page_columns(lists: DataFrame, emit_time: Column | None = None) -> DataFrame:
    """Report columns; user ids as a JSON list."""
    columns = [
        F.col("day").alias("pt"),
        F.col("page"),
        F.col("pv"),
        F.to_json("user_ids").alias("user_ids"),
        F.col("users"),
        F.col("chunk"),
        F.col("chunks"),
    ]
    if emit_time is not None:
        columns.append(emit_time.alias("emit_time"))
    return lists.select(*columns)


def page_report(logs: DataFrame, ids_per_row: int = metrics.IDS_PER_ROW) -> DataFrame:
    return page_columns(metrics.page_user_lists(metrics.page_user_counts(logs), "day", ids_per_row))


def word_item(word: Column, cnt: Column) -> Column:
    return F.struct(word.alias("word"), cnt.alias("cnt"))


def search_word_columns(counts: DataFrame, emit_time: Column | None = None) -> DataFrame:
    """One report row per day and word, its list holding that word."""
    columns = [
        F.col("day").alias("pt"),
        F.to_json(F.array(word_item(F.col("keyword"), F.col("cnt")))).alias("search_item"),
    ]
    if emit_time is not None:
        columns.append(emit_time.alias("emit_time"))
    return counts.select(*columns)


def search_word_report(logs: DataFrame) -> DataFrame:
    return search_word_columns(metrics.keyword_counts(parse.keyword_rows(logs)))


def search_top_columns(counts: DataFrame, k: int = TOP_WORDS) -> DataFrame:
    """One report row per day with its ``k`` most searched words, most searched first."""
    tops = top_k(counts, ["day"], [F.col("cnt").desc(), F.col("keyword").asc()], k)
    item = F.struct("rn", word_item(F.col("keyword"), F.col("cnt")).alias("item"))
    ordered = F.transform(F.array_sort(F.collect_list(item)), lambda x: x["item"])
    return tops.groupBy(F.col("day").alias("pt")).agg(F.to_json(ordered).alias("search_item"))


def search_top_report(logs: DataFrame, k: int = TOP_WORDS) -> DataFrame:
    return search_top_columns(metrics.keyword_counts(parse.keyword_rows(logs)), k)


def with_region_parts(df: DataFrame, zero_is_abnormal: bool = False) -> DataFrame:
    """Add label, parts and ``abnormal`` of ``region_raw``.

    A region text without parts is abnormal. ``zero_is_abnormal`` also counts texts with
    a ``0`` part as such and clears their parts, which the original rule means to do.
    """
    raw = F.col("region_raw")
    parts = {n: texts.region_part(raw, i) for i, n in ((1, "province"), (2, "city"), (3, "district"))}
    df = df.withColumns(parts).withColumn("abnormal", raw.isNull() | ~F.contains(raw, F.lit("|")))
    if zero_is_abnormal:
        pieces = F.transform(F.slice(F.split(raw, r"\|"), 2, 3), lambda part: F.trim(part))
        df = df.withColumn("abnormal", F.col("abnormal") | F.array_contains(pieces, "0"))
        df = df.withColumns({n: F.when(~F.col("abnormal"), F.col(n)) for n in parts})
    label = texts.region_label(F.col("province"), F.col("city"), F.col("district"))
    return df.withColumn("region", label)


def _region_report_columns(df: DataFrame, as_of) -> DataFrame:
    no_province = F.col("province").isNull() | (F.col("province") == texts.NULL_LABEL)
    return df.select(
        F.col("day").alias("pt"),
        "region",
        "province",
        "city",
        "district",
        "count",
        "abnormal",
        "region_raw",
        day_type(F.col("day"), as_of).alias("type"),
        F.when(no_province, F.col("ip")).alias("ip"),
    )


def region_columns(counts: DataFrame, as_of=None, zero_is_abnormal: bool = False) -> DataFrame:
    """Detail: a report row per ``day, region_raw`` of such counts, with the newest ``ip``."""
    return _region_report_columns(with_region_parts(counts, zero_is_abnormal), as_of)


def region_label_counts(parts: DataFrame, day: str = "day") -> DataFrame:
    """Hits per day and region label, with text and address of the newest hit.

    Takes hits or sums of hits, with ``count``, ``ip`` and ``newest``, and the parts of their region;
    ties go to the greatest address, then text.
    """
    newest = F.struct("newest", "ip", "region_raw")
    return parts.groupBy(day, "region").agg(
        *[F.max(c).alias(c) for c in ("province", "city", "district")],
        F.sum("count").alias("count"),
        F.bool_or("abnormal").alias("abnormal"),
        F.max(newest).alias("last"),
    ).select(
        "*", F.col("last.region_raw").alias("region_raw"), F.col("last.ip").alias("ip")
    ).drop("last")


def region_label_columns(counts: DataFrame, as_of=None) -> DataFrame:
    """Report rows of counts per label, the key of the region table."""
    return _region_report_columns(counts, as_of)


def region_label_report(
    logs: DataFrame,
    ranges: DataFrame,
    as_of=None,
    zero_is_abnormal: bool = False,
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Heat per region label: one row per ``pt, region``."""
    located = iprange.with_region(metrics.address_counts(logs), ranges, "ip", limit)
    raw = metrics.region_counts(located)
    return region_label_columns(region_label_counts(with_region_parts(raw, zero_is_abnormal)), as_of)


def region_report(
    logs: DataFrame,
    ranges: DataFrame,
    as_of=None,
    zero_is_abnormal: bool = False,
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """Heat per raw region, the detail behind ``region_label_report``.

    Hits are counted per address first: the lookup then sees each address of a day once,
    however many hits it had.
    """
    located = iprange.with_region(metrics.address_counts(logs), ranges, "ip", limit)
    return region_columns(metrics.region_counts(located), as_of, zero_is_abnormal)

"""Behaviour-log streams: running counts per day, written as the rows that changed.

Each query groups by the start of the log's day. State is kept for good by default, so no row is
ever late, whatever the order in which a topic's partitions are read. With ``keep``, such as
``KEEP_COUNTS``, the watermark sits on the day: a day's state is dropped once a day that much later
has been seen, and rows of it that come later still are dropped with it (``LateRows`` counts them).
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from retailtide.operators import iprange, metrics, parse
from retailtide.operators.bounded import BROADCAST_LIMIT
from retailtide.operators.latest import latest_by_key
from retailtide.plans import logs as reports
from retailtide.sinks.tables import (
    BATCH,
    ReportTable,
    day_files,
    read_days,
    read_table,
    write_batch,
)
from retailtide.sinks.topics import Deliver
from retailtide.sources.topics import judged_logs
from retailtide.streaming.run import Running, start

# Fixed value: days a count is kept after its day.
KEEP_COUNTS = "2 days"

# Files a day gets per batch in tables whose rows are few by their keys.
DAY_FILES = 4

DAY = "day_start"

USERS = (
    T.StructType()
    .add("page", T.StringType())
    .add("user_id", T.StringType())
    .add("views", T.LongType())
    .add("pt", T.DateType())
)


def _by_day(logs: DataFrame, keep: str | None) -> DataFrame:
    dated = logs.withColumn(DAY, F.date_trunc("day", F.col("event_time").cast("timestamp")))
    return dated.withWatermark(DAY, keep) if keep else dated


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("day", F.col(DAY).cast("date")).drop(DAY)


def device_table(folder: str) -> ReportTable:
    keys = ("pt", "os", "brand", "platv")
    return ReportTable(f"{folder}/device", keys, required=keys, files=DAY_FILES)


def region_table(folder: str) -> ReportTable:
    return ReportTable(f"{folder}/region", ("pt", "region"), required=("pt", "region"), files=DAY_FILES)


def word_table(spark: SparkSession, folder: str) -> ReportTable:
    """Present count of each word."""
    return ReportTable(f"{folder}/search_words", ("pt", "keyword"), files=day_files(spark))


def search_table(spark: SparkSession, folder: str) -> ReportTable:
    """Every emitted search row."""
    return ReportTable(f"{folder}/search", required=("pt",), files=day_files(spark))


def user_table(spark: SparkSession, folder: str) -> ReportTable:
    """Present views of each page and user."""
    return ReportTable(f"{folder}/page_users", ("pt", "page", "user_id"), files=day_files(spark), schema=USERS)


def page_table(folder: str, files: int | None = None) -> ReportTable:
    """Every emitted page row; rows hold lists of users, so who writes it names its files."""
    return ReportTable(f"{folder}/page", required=("pt",), files=files)


def device_stream(
    logs: DataFrame,
    folder: str,
    running: Running,
    as_of=None,
    keep: str | None = None,
    name: str = "device_stats",
) -> StreamingQuery:
    table = device_table(folder)

    def each_batch(df: DataFrame, batch_id: int) -> None:
        write_batch(reports.device_columns(_dated(df), as_of), batch_id, table, unique=True)

    counts = metrics.device_counts(_by_day(logs, keep), DAY)
    return start(counts, name, "update", each_batch, running)


def region_stream(
    logs: DataFrame,
    ranges: DataFrame,
    folder: str,
    running: Running,
    as_of=None,
    keep: str | None = None,
    name: str = "region_heat",
    limit: int = BROADCAST_LIMIT,
) -> StreamingQuery:
    table = region_table(folder)

    def each_batch(df: DataFrame, batch_id: int) -> None:
        write_batch(reports.region_label_columns(_dated(df), as_of), batch_id, table, unique=True)

    blocks = iprange.stored_blocks(logs.sparkSession, ranges, f"{folder}/range_blocks")
    hits = iprange.with_region(_by_day(logs, keep), blocks, "gis.ip", limit, stored=True).select(
        DAY,
        F.col("region").alias("region_raw"),
        F.lit(1).alias("count"),
        F.col("gis.ip").alias("ip"),
        F.col("event_time").alias("newest"),
    )
    counts = reports.region_label_counts(reports.with_region_parts(hits), DAY)
    return start(counts, name, "update", each_batch, running)


def search_stream(
    logs: DataFrame,
    folder: str,
    running: Running,
    keep: str | None = None,
    name: str = "search_words",
) -> StreamingQuery:
    """Counts per word: appended as report rows, and kept as the table ``top_words`` reads."""
    spark = logs.sparkSession
    words, report = word_table(spark, folder), search_table(spark, folder)

    def each_batch(df: DataFrame, batch_id: int) -> None:
        df = _dated(df).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_batch(df.withColumnRenamed("day", "pt"), batch_id, words, unique=True)
            rows = reports.search_word_columns(df, F.current_timestamp())
            write_batch(rows, batch_id, report)
        finally:
            df.unpersist()

    counts = metrics.keyword_counts(parse.keyword_rows(_by_day(logs, keep)), DAY)
    return start(counts, name, "update", each_batch, running)


def page_stream(
    logs: DataFrame,
    folder: str,
    running: Running,
    keep: str | None = None,
    name: str = "page_views",
    emit: bool = True,
) -> StreamingQuery:
    """Views per page and user, and with ``emit`` a report row of every page that got views.

    State and changes hold one row per user instead of one list per page, so a page with
    very many users costs no more per batch than its active ones; only the report gathers
    lists, from the stored rows.
    """
    spark = logs.sparkSession
    users, report = user_table(spark, folder), page_table(folder, day_files(spark))

    def each_batch(df: DataFrame, batch_id: int) -> None:
        rows = _dated(df).withColumnRenamed("day", "pt").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_batch(rows, batch_id, users, unique=True)
            if emit:
                days = [r.pt for r in rows.select("pt").distinct().collect()]
                lists = page_lists(spark, folder, rows.select("pt", "page").distinct(), days)
                write_batch(reports.page_columns(lists, F.current_timestamp()), batch_id, report)
        finally:
            rows.unpersist()

    counts = metrics.page_user_counts(_by_day(logs, keep), DAY)
    return start(counts, name, "update", each_batch, running)


def page_lists(
    spark: SparkSession, folder: str, pages: DataFrame | None = None, days: list | None = None
) -> DataFrame:
    """Views and users per page from the stored rows, of all pages or the given ``pt, page``.

    With ``days`` only the folders of these days are listed and read, and only rows of the given pages
    are looked through for the newest.
    """
    table = user_table(spark, folder)
    rows = read_days(spark, table, days)
    if pages is not None:
        rows = rows.join(pages, ["pt", "page"], "left_semi")
    present = latest_by_key(rows, list(table.keys), F.col(BATCH)).drop(BATCH)
    return metrics.page_user_lists(present.withColumnRenamed("pt", "day"))


def top_words(spark: SparkSession, folder: str, k: int = reports.TOP_WORDS) -> DataFrame:
    """Most searched words per day from the stored counts."""
    present = read_table(spark, word_table(spark, folder)).withColumnRenamed("pt", "day")
    return reports.search_top_columns(present, k)


def stage_logs(
    texts: DataFrame, path: str, running: Running, name: str = "log_rows"
) -> StreamingQuery:
    """Parse a topic once into a columnar table by day, committed by Spark's file sink.

    Texts that no report can use are staged with the others, in the column ``broken``.
    """
    rows = judged_logs(texts).withColumn("pt", F.col("event_time").cast("date"))
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .queryName(name)
        .option("checkpointLocation", f"{running.checkpoints.rstrip('/')}/{name}")
        .option("path", path)
        .partitionBy("pt")
        .trigger(**running.trigger)
        .start()
    )


def _staged(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(_staged_frame(spark).schema).parquet(path)


def staged_logs(spark: SparkSession, path: str) -> DataFrame:
    """The staged log rows as a stream; a report reads the columns it needs, and no JSON."""
    return _staged(spark, path).filter("broken is null").drop("broken")


def staged_dead_letters(
    spark: SparkSession, path: str, broken: Deliver, running: Running, name: str = "broken_logs"
) -> StreamingQuery:
    """Deliver the staged texts that no report can use."""
    rows = _staged(spark, path).filter("broken is not null").select(F.col("broken").alias("value"))
    return start(rows, name, "append", broken, running)


def log_reports(
    logs: DataFrame, ranges: DataFrame, folder: str, running: Running, as_of=None
) -> list[StreamingQuery]:
    """The four reports of one stream of log rows, a query each."""
    return [
        device_stream(logs, folder, running, as_of),
        region_stream(logs, ranges, folder, running, as_of),
        search_stream(logs, folder, running),
        page_stream(logs, folder, running),
    ]


def log_job(
    texts: DataFrame,
    ranges: DataFrame,
    folder: str,
    running: Running,
    broken: Deliver,
    as_of=None,
) -> list[StreamingQuery]:
    """The whole log job: a topic is read and parsed once, into ``<folder>/rows``.

    Four reports and the dead letters read on from there, a query each. With a trigger that ends
    by itself the staging is waited for first, so that they see all of it.
    """
    path = f"{folder}/rows"
    staging = stage_logs(texts, path, running)
    if "processingTime" not in running.trigger:
        staging.awaitTermination()
    spark = texts.sparkSession
    _staged_folder(spark, path)
    reports_running = log_reports(staged_logs(spark, path), ranges, folder, running, as_of)
    return [staging, *reports_running, staged_dead_letters(spark, path, broken, running)]


def _staged_folder(spark: SparkSession, path: str) -> None:
    """A stream can only read a folder that is there; one without files stays empty to it."""
    _staged_frame(spark).limit(0).write.mode("ignore").parquet(path)


def _staged_frame(spark: SparkSession) -> DataFrame:
    return judged_logs(spark.createDataFrame([], "value string")).withColumn("pt", F.lit(None).cast("date"))

"""Message topics and files of texts as streams or tables of one ``value`` column."""

from __future__ import annotations

from datetime import date, datetime
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailtide import schemas
from retailtide.operators import parse

# Fixed value: how often the client looks for new partitions of a topic.
PARTITION_DISCOVERY_MS = "10000"


def midnight_millis(tz: str, day: date | None = None) -> int:
    """Start of a day (today by default) in a zone, as epoch milliseconds."""
    zone = ZoneInfo(tz)
    day = day or datetime.now(zone).date()
    return int(datetime(day.year, day.month, day.day, tzinfo=zone).timestamp() * 1000)


def kafka_options(
    servers: str, topic: str, start: str | int = "earliest", max_per_trigger: int | None = None
) -> dict[str, str]:
    """Reader options; ``start`` is ``earliest``, ``latest`` or epoch milliseconds."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "kafka.metadata.max.age.ms": PARTITION_DISCOVERY_MS,
    }
    if isinstance(start, int):
        options["startingTimestamp"] = str(start)
        options["startingOffsetsByTimestampStrategy"] = "latest"
    else:
        options["startingOffsets"] = start
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def topic_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    start: str | int = "earliest",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Texts of a topic; records without a value (tombstones) are skipped."""
    options = kafka_options(servers, topic, start, max_per_trigger)
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.selectExpr("CAST(value AS STRING) AS value").filter("value IS NOT NULL")


def text_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The same from text files that appear in a folder."""
    return spark.readStream.options(**options).text(path).filter("value IS NOT NULL")


def table_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Rows of Parquet files that appear below a path."""
    path = path.rstrip("/")
    schema = spark.read.parquet(path).schema
    # a pattern, because a stream takes a folder or a pattern but not one file's name
    pattern = f"{path[:-1]}[{path[-1]}]"
    return spark.readStream.schema(schema).options(**options).parquet(pattern)


def order_rows(texts: DataFrame, schema: T.StructType = schemas.ORDER) -> DataFrame:
    """Order columns with event and processing time; texts that do not parse are ignored.

    Pass ``schemas.SALE`` where only the sales reports read on.
    """
    return parse.order_records(parse.with_record(texts, schema))


def log_rows(texts: DataFrame) -> DataFrame:
    """Log columns of the complete records; see ``broken_logs`` for the others."""
    records = parse.with_record(texts, schemas.LOG)
    return parse.log_records(records).filter(parse.complete_log())


def judged_logs(texts: DataFrame) -> DataFrame:
    """Log columns of every text, with ``broken`` holding those that no report can use.

    Such a text is no log record, or lacks a part every report needs. One parse serves both.
    """
    records = parse.with_record(texts, schemas.LOG)
    ts = F.col("record.ts").try_cast("bigint")
    others = [F.col(f"record.{n}") for n in schemas.LOG.names if n != "ts"]
    rows = records.select("value", *others, ts.alias("ts"), parse.record_log_time().alias("event_time"))
    return rows.withColumn("broken", F.when(~parse.complete_log(), F.col("value"))).drop("value")


def broken_logs(texts: DataFrame) -> DataFrame:
    """Texts that are no log record, or lack a part every report needs."""
    return judged_logs(texts).filter("broken is not null").select(F.col("broken").alias("value"))

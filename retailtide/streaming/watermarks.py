"""Event time and lateness bound of the different record kinds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailtide.operators.parse import with_record

ORDER_DELAY = "5 seconds"


def by_column(df: DataFrame, column: str, delay: str = ORDER_DELAY) -> DataFrame:
    return df.withWatermark(column, delay)


def by_text_field(
    df: DataFrame, field: str, delay: str, value: str = "value", name: str = "event_time"
) -> DataFrame:
    """From a millisecond field of a JSON text; broken texts and missing fields count as 0."""
    schema = T.StructType([T.StructField(field, T.StringType())])
    read = with_record(df, schema, value, "__read")
    millis = F.col("__read").getField(field).try_cast("bigint")
    timed = read.withColumn(name, F.timestamp_millis(F.coalesce(millis, F.lit(0))))
    return timed.drop("__read").withWatermark(name, delay)


def by_block_time(df: DataFrame, delay: str, name: str = "event_time") -> DataFrame:
    """From ``block_timestamp``, or ``timestamp`` where that is absent, in seconds."""
    seconds = F.coalesce("block_timestamp", "timestamp")
    return df.withColumn(name, F.timestamp_seconds(seconds)).withWatermark(name, delay)


def by_first_item(
    df: DataFrame, delay: str, items: str = "items", name: str = "event_time"
) -> DataFrame:
    """From the first list element's ``window_start_time`` in milliseconds."""
    millis = F.get(items, F.lit(0)).getField("window_start_time")
    return df.withColumn(name, F.timestamp_millis(millis)).withWatermark(name, delay)

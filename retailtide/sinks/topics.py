"""Texts to message topics, files and the console."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from retailtide.operators.parse import as_json

Deliver = Callable[[DataFrame, int], None]


def kafka_options(servers: str, topic: str, **more: str) -> dict[str, str]:
    """Acknowledged by all replicas, without duplicates from producer retries."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
        **more,
    }


def to_topic(servers: str, topic: str, **more: str) -> Deliver:
    """Deliver batches of a ``value`` text column to a topic, at least once."""
    options = kafka_options(servers, topic, **more)

    def deliver(df: DataFrame, batch_id: int) -> None:
        df.select("value").write.format("kafka").options(**options).save()

    return deliver


def to_files(path: str) -> Deliver:
    """Deliver batches of a ``value`` text column to one folder per batch, exactly once."""

    def deliver(df: DataFrame, batch_id: int) -> None:
        (
            df.select("value", F.lit(batch_id).alias("batch_id"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .text(path)
        )

    return deliver


def send(rows: DataFrame, deliver: Deliver) -> None:
    """Send a finite table to a topic, each row as one JSON text."""
    deliver(as_json(rows), 0)


def show(df: DataFrame, label: str, **trigger) -> StreamingQuery:
    """Print a stream to the console."""
    return (
        df.writeStream.format("console").queryName(label).trigger(**trigger).start()
        if trigger
        else df.writeStream.format("console").queryName(label).start()
    )

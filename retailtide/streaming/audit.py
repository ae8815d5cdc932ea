"""The state of a stream as a table, and where a report differs from it.

A report is written from the changes of the state, so after a restart, a restore from a copy or a repair by
hand the two can be held against one another: what the stream will go on from, and what readers see.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailtide.sinks.tables import ReportTable, read_table
from retailtide.streaming.run import Running


def stored_state(spark: SparkSession, running: Running, name: str, operator: int = 0) -> DataFrame:
    """Keys and values of a stateful operator of a query, as of its last committed batch."""
    place = f"{running.checkpoints.rstrip('/')}/{name}"
    state = spark.read.format("statestore").option("operatorId", str(operator)).load(place)
    return state.select("key.*", "value.*")


def differences(state: DataFrame, report: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Keys whose values differ, or that only one side has: ``keys``, ``state`` and ``report``.

    One shuffle of each side by the keys, all of which are unique. A side that lacks a key is null.
    """
    sides = [side.select(*keys, F.struct(*values).alias(name)) for name, side in (("state", state), ("report", report))]
    whole = sides[0].unionByName(sides[1], allowMissingColumns=True)
    found = whole.groupBy(*keys).agg(F.max("state").alias("state"), F.max("report").alias("report"))
    return found.filter(~F.col("state").eqNullSafe(F.col("report")))


def device_differences(
    spark: SparkSession, running: Running, table: ReportTable, name: str = "device_stats"
) -> DataFrame:
    """Devices whose stored count is not the one in the report."""
    state = stored_state(spark, running, name)
    start, os, brand, platv = state.columns[:4]
    named = state.select(
        F.col(start).cast("date").alias("pt"),
        F.col(os).alias("os"),
        F.col(brand).alias("brand"),
        F.col(platv).alias("platv"),
        F.col(state.columns[4]).cast("long").alias("count"),
    )
    keys = ["pt", "os", "brand", "platv"]
    return differences(named, read_table(spark, table), keys, ["count"])

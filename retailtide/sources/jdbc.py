"""Queries on databases, and table snapshots for the change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retailtide.functions.texts import camel_columns
from retailtide.operators.parse import snapshot_changes


def options(
    url: str, user: str | None = None, password: str | None = None, driver: str | None = None
) -> dict[str, str]:
    named = {"url": url, "user": user, "password": password, "driver": driver}
    return {k: v for k, v in named.items() if v is not None}


def split_options(column: str, lower: int, upper: int, parts: int) -> dict[str, str]:
    """Read a table in ``parts`` ranges of a numeric column, each by its own task."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(parts),
    }


def query_rows(
    spark: SparkSession, connection: dict[str, str], query: str, camel: bool = False
) -> DataFrame:
    """Result of a query, columns named by label (``AS`` names count), optionally in camel case."""
    rows = spark.read.format("jdbc").options(**connection).option("query", query).load()
    return camel_columns(rows) if camel else rows


def snapshot(
    spark: SparkSession,
    connection: dict[str, str],
    db: str,
    schema: str,
    table: str,
    split: dict[str, str] | None = None,
) -> DataFrame:
    """A table's present rows as change-record texts (``op`` is ``r``)."""
    reader = spark.read.format("jdbc").options(**connection).option("dbtable", f"{schema}.{table}")
    return snapshot_changes(reader.options(**(split or {})).load(), db, schema, table)

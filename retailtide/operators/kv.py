"""Key/value tables: cells ``row_key, qualifier, value`` (all text) and rows made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_cells(df: DataFrame, key: Column) -> DataFrame:
    """Put form of each row: one text cell per field that is present."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("qualifier"), F.col(f"`{c}`").cast("string").alias("value"))
            for c in df.columns
        ]
    )
    return (
        df.select(key.cast("string").alias("row_key"), F.explode(pairs).alias("cell"))
        .select("row_key", "cell.qualifier", "cell.value")
        .filter("value is not null")
    )


def cells_to_rows(
    cells: DataFrame, qualifiers: list[str], version: str | None = None
) -> DataFrame:
    """One row per key, one text column per named qualifier; the newest version of a cell wins."""
    newest = F.max_by("value", version) if version else F.max("value")
    return cells.groupBy("row_key").pivot("qualifier", qualifiers).agg(newest)


def cells_to_maps(cells: DataFrame, version: str | None = None) -> DataFrame:
    """One row per key with its cells as a map, for tables without a fixed set of qualifiers."""
    newest = F.max_by("value", version) if version else F.max("value")
    latest = cells.groupBy("row_key", "qualifier").agg(newest.alias("value"))
    entries = F.array_sort(F.collect_list(F.struct("qualifier", "value")))
    return latest.groupBy("row_key").agg(F.map_from_entries(entries).alias("info"))


def get(rows: DataFrame, key: str) -> DataFrame:
    return rows.filter(F.col("row_key") == key)


def get_many(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of the given keys. Adaptive execution broadcasts few keys, by their shuffled size."""
    return rows.join(keys.select("row_key"), "row_key", "left_semi")


def delete(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The table without the given keys; write the result where the table is to be without them."""
    return rows.join(keys.select("row_key"), "row_key", "left_anti")


def scan(rows: DataFrame, n: int) -> DataFrame:
    """First ``n`` rows in key order."""
    return rows.orderBy("row_key").limit(n)


def count_rows(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("rows"))


def put(df: DataFrame, key: Column, order: Column) -> DataFrame:
    """Every field as text under its row key; of several rows with one key the last stays."""
    texts = [F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]
    keyed = df.select(key.cast("string").alias("row_key"), order.alias("put_order"), F.struct(*texts).alias("info"))
    return (
        keyed.groupBy("row_key")
        .agg(F.max_by("info", "put_order").alias("info"))
        .select("row_key", "info.*")
    )


#: Columns of an entry: what was put under a key, or that it was deleted, and the place of that in time.
ENTRY = "row_key string, info map<string,string>, deleted boolean, seq long"


def put_entries(df: DataFrame, key: Column, seq: Column) -> DataFrame:
    """An entry with every field of a row that is present, as text."""
    pairs = [x for c in df.columns for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]
    info = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
    return df.select(
        key.cast("string").alias("row_key"), info.alias("info"), F.lit(False).alias("deleted"), seq.cast("long").alias("seq")
    )


def delete_entries(keys: DataFrame, seq: Column) -> DataFrame:
    """A tombstone for each ``row_key``; the key need not be there."""
    nothing = F.lit(None).cast("map<string,string>")
    return keys.select("row_key", nothing.alias("info"), F.lit(True).alias("deleted"), seq.cast("long").alias("seq"))


def merged(entries: DataFrame) -> DataFrame:
    """The newest entry of every key, tombstones too: by number, and of equal ones the tombstone."""
    newest = F.max_by(F.struct("info", "deleted", "seq"), F.struct("seq", "deleted"))
    return entries.groupBy("row_key").agg(newest.alias("e")).select("row_key", "e.info", "e.deleted", "e.seq")


def present(entries: DataFrame) -> DataFrame:
    """``row_key, info`` of the keys whose newest entry is a put.

    Entries may come in any order and any number of times, as after a replay.
    """
    return merged(entries).filter("not deleted").select("row_key", "info")

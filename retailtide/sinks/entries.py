"""Stored key/value tables: entries that are merged when read, and rows laid out for reads by key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailtide.operators import kv
from retailtide.sinks.tables import BATCH, read_if_there


@dataclass(frozen=True)
class EntryTable:
    """Folders of entries by batch, and one of entries merged before.

    ``files`` is the number of files of a batch, filled by a hash of the key.
    """

    path: str
    files: int = 16

    @property
    def batches(self) -> str:
        return f"{self.path.rstrip('/')}/batches"


def write_entries(entries: DataFrame, batch_id: int, table: EntryTable) -> None:
    """Write the puts and deletes of a batch; one that is replayed replaces what it wrote before."""
    dealt = entries.repartition(table.files, "row_key").sortWithinPartitions("row_key")
    dealt.write.mode("overwrite").parquet(f"{table.batches}/{BATCH}={batch_id}")


def read_entries(spark: SparkSession, table: EntryTable) -> DataFrame:
    return read_if_there(spark, kv.ENTRY, f"{table.batches}/*")


def read_present(spark: SparkSession, table: EntryTable) -> DataFrame:
    """``row_key, info`` of the keys that are there."""
    return kv.present(read_entries(spark, table))


def fold(spark: SparkSession, table: EntryTable, new: EntryTable, upto: int) -> None:
    """Write the merged entries of all batches up to one to a new table, the later ones as they are.

    Tombstones stay while a batch that is not folded could still hold an older put of their key; a key is
    gone for good when a fold of all batches meets its tombstone.
    """
    entries = spark.read.option("basePath", table.batches).schema(f"{kv.ENTRY}, {BATCH} long").parquet(table.batches)
    last = entries.agg(F.max(BATCH)).first()[0]
    if last is None:
        return
    settled = kv.merged(entries.filter(F.col(BATCH) <= upto))
    if upto >= last:
        settled = settled.filter("not deleted")
    write_entries(settled, upto, new)
    for row in entries.filter(F.col(BATCH) > upto).select(BATCH).distinct().collect():
        write_entries(entries.filter(F.col(BATCH) == row[0]).drop(BATCH), row[0], new)


#: Folders of a table laid out by key, and the column that names them.
KEY_PARTS = 64
_PART = "key_part"


def _part_of(key: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def store_by_key(rows: DataFrame, path: str, parts: int = KEY_PARTS) -> None:
    """Write rows with a ``row_key`` so that a read by key opens one folder's file.

    A folder holds the keys of one hash value, in order and with a Bloom filter, so that the groups of rows
    in its file that lack a key are skipped too.
    """
    (
        rows.withColumn(_PART, _part_of(F.col("row_key"), parts))
        .repartition(parts, _PART)
        .sortWithinPartitions(_PART, "row_key")
        .write.mode("overwrite")
        .option("parquet.bloom.filter.enabled#row_key", "true")
        .partitionBy(_PART)
        .parquet(path)
    )


def get_stored(spark: SparkSession, path: str, key: str, parts: int = KEY_PARTS) -> DataFrame:
    """The row of a key; the other folders are pruned by the plan."""
    rows = spark.read.parquet(path)
    mine = (F.col(_PART) == _part_of(F.lit(key), parts)) & (F.col("row_key") == key)
    return rows.filter(mine).drop(_PART)

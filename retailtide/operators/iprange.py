"""Address to region by a table of ranges.

Ranges are cut at /16 borders, which turns the range condition into an equality on the
upper half of the address plus a check inside one block; without that Spark could only
compare every address with every range.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retailtide.functions.texts import UNKNOWN_REGION
from retailtide.operators.bounded import BROADCAST_LIMIT, measured_bytes
from retailtide.workers import ship

_BLOCK = 65_536

# Copies of a block's ranges in a stream that joins a large range table.
STREAM_SALTS = 16

# Fixed value: dotted quad of decimal octets, none above 255.
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_IPV4 = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"


def ip_number(ip: Column) -> Column:
    """IPv4 text as a number, null when it is not one."""
    parts = F.split(ip, r"\.")
    number = sum(
        (F.get(parts, F.lit(i)).cast("bigint") * 256 ** (3 - i) for i in range(1, 4)),
        F.get(parts, F.lit(0)).cast("bigint") * 256**3,
    )
    return F.when(ip.rlike(_IPV4), number)


def block_ranges(ranges: DataFrame) -> DataFrame:
    """``ip_lo, ip_hi, region`` as pieces that do not overlap, each within one /16 block.

    Where ranges overlap, the one with the greatest start has the address; of equal starts the
    one that ends first, then the greater text. A block is swept in one pass, whatever its overlaps.
    """
    blocks = F.sequence(
        F.floor(F.col("ip_lo") / _BLOCK), F.floor(F.col("ip_hi") / _BLOCK)
    )
    cut = (
        ranges.filter("ip_lo <= ip_hi")
        .select("ip_lo", "ip_hi", "region", F.explode(blocks).alias("block"))
        .select(
            "block",
            F.greatest("ip_lo", F.col("block") * _BLOCK).alias("at"),
            F.least("ip_hi", F.col("block") * _BLOCK + (_BLOCK - 1)).alias("upto"),
            "ip_lo",
            "ip_hi",
            "region",
        )
    )
    ship(ranges.sparkSession)
    order = ["block", "at", "ip_lo", F.col("ip_hi").desc(), F.col("region").desc_nulls_last()]
    return cut.repartition("block").sortWithinPartitions(*order).mapInArrow(_swept, _PIECES)


_PIECES = "block long, ip_lo long, ip_hi long, region string"
_PIECE_ROWS = 8192


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of ranges in order of their blocks and starts, in one pass.

    Open ranges are held by rank, the one that has the address on top; only they are in memory. Each
    range makes at most two pieces: one where it begins, one where a range inside it ends.
    """
    pieces: list[tuple] = []
    open_ranges: list[tuple] = []  # (-ip_lo, ip_hi, upto, region)
    block, at = None, 0

    def advance(to: int) -> None:
        """Give out the addresses from ``at`` to before ``to``."""
        nonlocal at
        while at < to:
            while open_ranges and open_ranges[0][2] < at:
                heapq.heappop(open_ranges)
            if not open_ranges:
                at = to
                return
            end = min(open_ranges[0][2], to - 1)
            pieces.append((block, at, end, open_ranges[0][3]))
            at = end + 1

    def given() -> pa.RecordBatch:
        columns = list(zip(*pieces)) or [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        pieces.clear()
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], ["block", "ip_lo", "ip_hi", "region"])

    before = None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[0] != block:
                advance(2**62)
                open_ranges.clear()
                block, at, before = row[0], row[1], None
            _, start, upto, ip_lo, ip_hi, region = row
            if (ip_lo, ip_hi) == before:
                continue  # of equal ranges the greater text comes first
            before = (ip_lo, ip_hi)
            advance(start)
            heapq.heappush(open_ranges, (-ip_lo, ip_hi, upto, region))
            if len(pieces) >= _PIECE_ROWS:
                yield given()
    advance(2**62)
    yield given()


def _joined(numbered: DataFrame, blocks: DataFrame, salts: int = 1) -> DataFrame:
    """Equi-join by block; with ``salts`` a block's rows are dealt to so many copies of its ranges."""
    numbered = numbered.withColumn("salt", F.pmod(F.col("ip_number"), F.lit(salts)).cast("int"))
    blocks = blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    inside = (
        (F.col("l.block") == F.col("r.block"))
        & (F.col("l.salt") == F.col("r.salt"))
        & (F.col("l.ip_number") >= F.col("r.ip_lo"))
        & (F.col("l.ip_number") <= F.col("r.ip_hi"))
    )
    return (
        numbered.alias("l")
        .join(blocks.alias("r"), inside, "left")
        .select("l.*", F.col("r.region").alias("region"))
        .drop("ip_number", "block", "salt")
    )


def _numbered(df: DataFrame, ip: Column) -> DataFrame:
    number = ip_number(ip)
    return df.withColumn("ip_number", number).withColumn(
        "block", F.floor(F.col("ip_number") / _BLOCK)
    )


def _last_range(addresses: DataFrame, blocks: DataFrame) -> DataFrame:
    """Region of each distinct address by one ordered pass over its block.

    Addresses and range starts are laid in one line per block; the range begun last is the
    only one that can cover an address, so no pairs are formed.
    """
    text = F.col("ip_text")
    points = (
        _numbered(addresses, text)
        .filter("ip_number is not null")
        .select("block", F.col("ip_number").alias("at"), "ip_text", F.lit(None).alias("span"))
    )
    starts = blocks.select(
        "block",
        F.col("ip_lo").alias("at"),
        F.lit(None).cast("string").alias("ip_text"),
        F.struct("ip_hi", "region").alias("span"),
    )
    line = (
        Window.partitionBy("block")
        .orderBy("at", F.col("ip_text").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    begun = F.last("span", ignorenulls=True).over(line)
    return (
        starts.unionByName(points)
        .withColumn("begun", begun)
        .filter("ip_text is not null")
        .select("ip_text", F.when(F.col("at") <= F.col("begun.ip_hi"), F.col("begun.region")).alias("region"))
    )


def stored_blocks(spark: SparkSession, ranges: DataFrame, path: str) -> DataFrame:
    """The pieces of a range table, worked out once and written, for jobs that look up again and again."""
    block_ranges(ranges).write.mode("overwrite").parquet(path)
    return spark.read.schema(_PIECES).parquet(path)


def with_region(
    df: DataFrame,
    ranges: DataFrame,
    ip: str = "gis.ip",
    limit: int = BROADCAST_LIMIT,
    stored: bool = False,
) -> DataFrame:
    """Add ``region`` to every row; unreadable or uncovered addresses get the unknown label.

    Of ranges that overlap the one with the greatest start counts, whatever the way taken (see
    ``block_ranges``). A range table within ``limit`` bytes (measured) is broadcast
    and the rows stay where they are. A larger one is joined to the distinct addresses
    only, of which a /16 block holds at most 65,536 however hot it is; the rows then take
    the answer by address in a join whose hot keys adaptive execution can split. A stream, which
    runs without adaptive execution, meets a large range table block by block, a block's rows
    dealt to ``STREAM_SALTS`` copies of its ranges. With ``stored`` the ranges are what ``stored_blocks`` gave.
    """
    blocks = ranges if stored else block_ranges(ranges)
    labelled = F.coalesce("region", F.lit(UNKNOWN_REGION))
    small = measured_bytes(blocks) <= limit
    if small or df.isStreaming:
        side = F.broadcast(blocks) if small else blocks
        joined = _joined(_numbered(df, F.col(ip)), side, 1 if small else STREAM_SALTS)
        return joined.withColumn("region", labelled)
    keyed = df.withColumn("ip_text", F.col(ip))
    addresses = keyed.select("ip_text").distinct()
    answers = _last_range(addresses, blocks)
    return keyed.join(answers, "ip_text", "left").drop("ip_text").withColumn("region", labelled)

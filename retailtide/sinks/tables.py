"""Report tables on plain Parquet, written by micro-batch.

Every batch owns the folders ``<day>/batch_id=<n>`` and replaces them when it is replayed, so
a retry after a lost driver or executor leaves the table as one run would. Nothing written
earlier is read or rewritten; a keyed table resolves "newest row wins" when it is read, and
``compact`` folds old batches away. Rows that cannot be stored are kept beside the table.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailtide.functions.times import as_date
from retailtide.operators.latest import latest_by_key

# Fixed value: share of unusable rows above which a load is refused.
MAX_REJECTED = 0.1

BATCH = "batch_id"

_MARK = "cannot_be_stored"


class LoadRejected(RuntimeError):
    """Too many rows of a load lack a required column."""


@dataclass(frozen=True)
class ReportTable:
    """``keys`` makes it an upsert table; without them rows are only appended.

    ``files`` is the number of files a day gets per batch, filled by a hash of the key, so a
    day never depends on one task alone. Unset, every task writes its own file per day.
    ``back`` and ``ahead`` are the days before and after today that the table has; rows of other days
    are rejected like those that lack a required column.
    """

    path: str
    keys: tuple[str, ...] = ()
    day: str = "pt"
    required: tuple[str, ...] = ()
    files: int | None = None
    schema: T.StructType | None = None
    back: int | None = None
    ahead: int | None = None


def day_files(spark: SparkSession, most: int = 64) -> int:
    """Files per day and batch for large tables, by the cores of the cluster."""
    return min(most, spark.sparkContext.defaultParallelism)


def unusable(required: tuple[str, ...] | list[str]) -> Column:
    """True where a required column is missing."""
    bad = F.lit(False)
    for name in required:
        bad = bad | F.col(name).isNull()
    return bad


def cannot_store(table: ReportTable, as_of=None) -> Column:
    """True for rows that a table cannot take: a column is missing, or the table has no such day."""
    bad, today = unusable(table.required), as_date(as_of)
    if table.back is not None:
        bad = bad | F.coalesce(F.col(table.day) < F.date_sub(today, table.back), F.lit(True))
    if table.ahead is not None:
        bad = bad | F.coalesce(F.col(table.day) > F.date_add(today, table.ahead), F.lit(True))
    return bad


def refuse(total: int, rejected: int, limit: float = MAX_REJECTED) -> None:
    """Refuse a load when more than ``limit`` of its rows are unusable."""
    if rejected > limit * total:
        raise LoadRejected(f"{rejected} of {total} rows cannot be stored")


def check_rejects(df: DataFrame, bad: Column, limit: float = MAX_REJECTED) -> None:
    """Refuse a table that is there already when too many of its rows are unusable."""
    refuse(*df.agg(F.count(F.lit(1)), F.count(F.when(bad, F.lit(1)))).first(), limit)


def _put(df: DataFrame, batch_id: int, table: ReportTable) -> None:
    if table.files:
        spread = [k for k in table.keys or df.columns if k != table.day]
        df = df.repartition(table.day, F.pmod(F.xxhash64(*spread), F.lit(table.files)))
    (
        df.withColumn("update_time", F.current_timestamp())
        .withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(table.day, BATCH)
        .parquet(table.path)
    )


def rejected_path(table: ReportTable) -> str:
    """Where the rows of a table that lack a required column go, by batch."""
    return f"{table.path.rstrip('/')}_rejected"


def write_batch(
    df: DataFrame,
    batch_id: int,
    table: ReportTable,
    order: Column | None = None,
    unique: bool = False,
    as_of=None,
) -> None:
    """Write one batch of a table.

    A keyed table needs ``order``, which picks the newest row where a key occurs more than once in
    the batch, or the caller's word that its rows are ``unique``. Rows that the table cannot take
    are stored beside it (``read_rejected``), each with its batch; with too many of them the whole load
    is refused and the table stays as it was. The input is read once: rows wait beside the table until
    they have been counted.
    """
    if table.keys and order is None and not unique:
        raise ValueError("rows for a keyed table need an order, or must be unique")
    if not table.required and table.back is None and table.ahead is None:
        _put(_newest(df, table, order), batch_id, table)
        return
    # Rows are written once, counted as they pass, judged, and then published from what was written.
    mark, counted = _MARK, Observation(f"load_{batch_id}")
    staged = f"{table.path.rstrip('/')}_staged/{BATCH}={batch_id}"
    marked = df.withColumn(mark, cannot_store(table, as_of))
    observed = marked.observe(
        counted, F.count(F.lit(1)).alias("total"), F.count(F.when(F.col(mark), F.lit(1))).alias("rejected")
    )
    observed.write.mode("overwrite").partitionBy(mark).parquet(staged)
    refuse(**counted.get)
    rows = df.sparkSession.read.schema(marked.schema).parquet(staged)
    _put(_newest(rows.filter(~F.col(mark)).drop(mark), table, order), batch_id, table)
    rejected = rows.filter(F.col(mark)).drop(mark).withColumn("rejected_at", F.current_timestamp())
    rejected.write.mode("overwrite").parquet(f"{rejected_path(table)}/{BATCH}={batch_id}")
    df.sparkSession.createDataFrame([], marked.schema).write.mode("overwrite").parquet(staged)


def _newest(df: DataFrame, table: ReportTable, order: Column | None) -> DataFrame:
    return latest_by_key(df, list(table.keys), order) if table.keys and order is not None else df


def read_rejected(spark: SparkSession, table: ReportTable) -> DataFrame:
    """Rejected rows of all batches, with their batch."""
    return spark.read.parquet(rejected_path(table))


def read_if_there(spark: SparkSession, schema: str | T.StructType, *paths: str, **options: str) -> DataFrame:
    """Parquet below paths or patterns; no rows where nothing is there yet."""
    try:
        return spark.read.schema(schema).options(**options).parquet(*paths)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _batch_schema(schema: T.StructType) -> T.StructType:
    extra = [T.StructField("update_time", T.TimestampType()), T.StructField(BATCH, T.LongType())]
    known = [f for f in schema.fields if f.name not in ("update_time", BATCH)]
    return T.StructType(known + extra)


def read_batches(spark: SparkSession, table: ReportTable) -> DataFrame:
    """All rows ever written and not yet compacted, with their batch."""
    if table.schema is not None:
        return spark.read.schema(_batch_schema(table.schema)).parquet(table.path)
    return spark.read.parquet(table.path)


def read_days(spark: SparkSession, table: ReportTable, days) -> DataFrame:
    """Rows of some days, listing no other day's folders; ``days`` is a list, a first and last day, or None.

    The table needs a schema.
    """
    schema = _batch_schema(table.schema)
    if days is None:
        return read_if_there(spark, schema, table.path)
    if isinstance(days, tuple):
        first, last = days
        days = [first + timedelta(days=n) for n in range((last - first).days + 1)]
    root = table.path.rstrip("/")
    names = ",".join(f"{table.day}={day}" for day in days)
    return read_if_there(spark, schema, f"{root}/{{{names}}}", basePath=root)


def read_table(spark: SparkSession, table: ReportTable) -> DataFrame:
    """The table as its readers see it: newest row per key, or every row."""
    rows = read_batches(spark, table)
    if table.keys:
        rows = latest_by_key(rows, list(table.keys), F.col(BATCH))
    return rows.drop(BATCH)


def compact(spark: SparkSession, table: ReportTable, new_path: str) -> None:
    """Write the present state to a new place, all batches but the newest as one per day.

    Only the newest batch can be replayed, as its commit may have been lost. It keeps its folders, so a
    replay replaces it and nothing else; the ones before it, which are committed, become one batch
    numbered just below. Readers and the stream switch to the new path between two batches.
    """
    rows = read_batches(spark, table)
    newest = rows.agg(F.max(BATCH)).first()[0]
    if newest is None:
        return
    settled, last = rows.filter(F.col(BATCH) < newest), rows.filter(F.col(BATCH) == newest)
    if table.keys:
        settled = latest_by_key(settled, list(table.keys), F.col(BATCH))
    whole = settled.withColumn(BATCH, F.lit(newest - 1).cast("bigint")).unionByName(last)
    (
        whole.hint("rebalance", table.day)
        .write.mode("errorifexists")
        .partitionBy(table.day, BATCH)
        .parquet(new_path)
    )

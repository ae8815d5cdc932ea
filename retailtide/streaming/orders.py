"""Order streams: change-feed sync, and cumulative sales as their windows close."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from retailtide.operators import parse
from retailtide.operators.cumulate import Steps
from retailtide.plans import gmv
from retailtide.sinks.tables import (
    BATCH,
    ReportTable,
    day_files,
    read_days,
    read_if_there,
    write_batch,
)
from retailtide.sinks.topics import Deliver
from retailtide.streaming import windows
from retailtide.streaming.run import Running, start

EPOCH = datetime(1970, 1, 1)

# Fixed value: how long a closed window waits for late sales.
ORDER_DELAY = timedelta(seconds=5)

SLOTS = (
    T.StructType()
    .add("bucket", T.IntegerType())
    .add("slot", T.IntegerType())
    .add("product_id", T.StringType())
    .add("cents", T.LongType())
    .add("pt", T.DateType())
)

REPORT = (
    T.StructType()
    .add("window_start", T.StringType())
    .add("window_end", T.StringType())
    .add("win_gmv", T.DecimalType(18, 2))
    .add("win_gmv_ids", T.StringType())
    .add("top5_product_ids", T.StringType())
    .add("ds", T.DateType())
)


def sync_changes(
    texts: DataFrame, deliver: Deliver, broken: Deliver, running: Running, name: str = "order_sync"
) -> StreamingQuery:
    """Change feed to order topic; texts that do not parse go to ``broken``.

    The batch is parsed once and kept while both outputs are written.
    """

    def each_batch(df: DataFrame, batch_id: int) -> None:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            deliver(parse.change_texts(parse.parsed(df)), batch_id)
            broken(parse.dead_letters(df), batch_id)
        finally:
            df.unpersist()

    return start(parse.order_changes(texts), name, "append", each_batch, running)


_PROGRESS = "upto long"


def _progress_path(folder: str, batch_id: int) -> str:
    return f"{folder}/progress/{BATCH}={batch_id}"


def reported_upto(spark: SparkSession, folder: str, batch_id: int) -> int | None:
    """The last window that a batch has reported, from what it left beside itself."""
    row = read_if_there(spark, _PROGRESS, _progress_path(folder, batch_id)).first()
    return row[0] if row else None


def _write_progress(spark: SparkSession, folder: str, batch_id: int, upto: int | None) -> None:
    frame = spark.createDataFrame([(upto,)], _PROGRESS).coalesce(1)
    frame.write.mode("overwrite").parquet(_progress_path(folder, batch_id))


def _position(steps: Steps):
    return F.col("bucket").cast("bigint") * (steps.last + 1) + F.col("slot")


def _day(position: int, steps: Steps) -> date:
    seconds = position // (steps.last + 1) * steps.size
    return (EPOCH + timedelta(seconds=seconds)).date()


def _store_slots(placed: DataFrame, batch_id: int, slots: ReportTable, steps: Steps) -> None:
    day = F.date_from_unix_date(F.floor(F.col("bucket") * (steps.size / 86_400)).cast("int"))
    write_batch(
        placed.select("bucket", "slot", "product_id", "cents", day.alias("pt")), batch_id, slots
    )


def _stored(spark: SparkSession, slots: ReportTable, days, batch_id: int) -> DataFrame:
    """One row per slot and product of the rows that batches have stored for some days."""
    rows = read_days(spark, slots, days).filter(F.col(BATCH) <= batch_id)
    return rows.groupBy("bucket", "slot", "product_id").agg(F.sum("cents").alias("cents"))


def report_changed(
    batch: DataFrame,
    batch_id: int,
    spark: SparkSession,
    folder: str,
    report: ReportTable,
    plan: Callable[..., DataFrame],
    steps: Steps,
) -> None:
    """Store what this batch adds to its slots, then report every window that changes.

    Slot rows of several batches add up, so no state is held and no sale is ever late: one
    that arrives days behind corrects the windows of its own day.
    """
    before = reported_upto(spark, folder, batch_id - 1)
    totals = gmv.sale_slots(batch, steps).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        slots = slot_table(spark, f"{folder}/slots")
        _store_slots(totals, batch_id, slots, steps)
        low, high = totals.agg(F.min(_position(steps)), F.max(_position(steps))).first()
        touched = {_day(r[0] * (steps.last + 1), steps) for r in totals.select("bucket").distinct().collect()}
    finally:
        totals.unpersist()
    reached = before
    if low is not None:
        after, upto = low - 1, high
        if before is not None:
            # the newest day so far goes on to its end, even without further sales
            touched.add(_day(before, steps))
            after, upto = min(after, before), max(upto, before)
        changed = plan(_stored(spark, slots, sorted(touched), batch_id), steps, span=(after, upto))
        write_batch(changed, batch_id, report, unique=True)
        reached = upto
    _write_progress(spark, folder, batch_id, reached)


def report_closed(
    batch: DataFrame, batch_id: int, folder: str, report: ReportTable, plan: Callable[[DataFrame], DataFrame]
) -> None:
    """Write the windows that a batch has closed, and beside them how many sales came too late."""
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_batch(plan(batch.filter(F.col("slot") != windows.NO_SLOT)), batch_id, report, unique=True)
        late = batch.filter(F.col("slot") == windows.NO_SLOT).agg(F.sum("late").alias("late")).filter("late > 0")
        late.coalesce(1).write.mode("overwrite").parquet(_late_path(folder, batch_id))
    finally:
        batch.unpersist()


def _late_path(folder: str, batch_id: int | str) -> str:
    return f"{folder}/late/{BATCH}={batch_id}"


def late_sales(spark: SparkSession, folder: str) -> int:
    """All sales that the report in ``folder`` has dropped, because every window of theirs was reported."""
    return read_if_there(spark, "late long", _late_path(folder, "*")).agg(F.sum("late")).first()[0] or 0


def slot_table(spark: SparkSession, path: str) -> ReportTable:
    return ReportTable(path, files=day_files(spark), schema=SLOTS)


def gmv_table(spark: SparkSession, path: str, keyed: bool = True) -> ReportTable:
    keys = ("ds", "window_start", "window_end") if keyed else ()
    return ReportTable(path, keys, day="ds", files=day_files(spark), schema=REPORT)


def _gmv_query(
    orders: DataFrame,
    folder: str,
    running: Running,
    name: str,
    plan: Callable[..., DataFrame],
    closed_plan: Callable[..., DataFrame],
    keyed: bool,
    steps: Steps,
    delay: timedelta | None,
) -> StreamingQuery:
    spark = orders.sparkSession
    report = gmv_table(spark, f"{folder}/report", keyed or delay is None)
    if delay is None:
        each_batch = partial(
            report_changed, spark=spark, folder=folder, report=report, plan=plan, steps=steps
        )
        return start(orders, name, "append", each_batch, running)
    each_batch = partial(report_closed, folder=folder, report=report, plan=partial(closed_plan, steps=steps))
    return start(windows.closed_windows(orders, delay, steps), name, "append", each_batch, running)


def gmv_all_history(
    orders: DataFrame,
    folder: str,
    running: Running,
    name: str = "gmv_all",
    steps: Steps = Steps(),
    delay: timedelta | None = None,
) -> StreamingQuery:
    """Keyed report of every cumulative window, over all products.

    By default a window is reported as soon as it has sales and again whenever they change, and no
    sale is ever too late: an old topic may be read whose partitions do not run level. With a
    ``delay`` (such as ``ORDER_DELAY``) a window is reported once, when the newest sale is that far
    past its end. A sale that comes later counts in the windows of its day that are still open; when
    none is, it is dropped, and ``late_sales`` counts it when the next window closes.
    """
    return _gmv_query(
        orders,
        folder,
        running,
        name,
        gmv.gmv_all_from_slots,
        windows.all_products_report,
        True,
        steps,
        delay,
    )


def gmv_since_today(
    orders: DataFrame,
    folder: str,
    running: Running,
    as_of=None,
    name: str = "gmv_today",
    steps: Steps = Steps(),
    delay: timedelta | None = ORDER_DELAY,
) -> StreamingQuery:
    """Report of the windows from today on, counting best sellers only.

    It has no key while windows are reported once, and is keyed with ``delay=None``.
    """
    return _gmv_query(
        gmv.since_today(orders, as_of),
        folder,
        running,
        name,
        gmv.gmv_top_from_slots,
        windows.best_sellers_report,
        False,
        steps,
        delay,
    )

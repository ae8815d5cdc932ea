"""Cumulative sales windows that event time closes: keyed state with timers, and an aggregate behind it.

Sales are summed per slot and product in the tasks that read them, so a hot product is a few rows by
the time it is shuffled. State is kept per window start and part of the products: what has not been
reported yet, the running totals, and a timer at the end of the next slot. When the watermark passes that
end, the part adds up the slot and hands on its total, its best sellers and its products; a second stateful
operator puts the parts of a window together and emits it once. A sale that comes after its own slot
was reported counts in all windows still to come. If none is, it is dropped and counted: the counts go
the way of the totals, as rows without a slot.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta
from functools import partial
from zoneinfo import ZoneInfo

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from retailtide.operators.cumulate import Steps, with_slot
from retailtide.plans import gmv
from retailtide.workers import ship

_EPOCH = datetime(1970, 1, 1)
_SUMS = "bucket int, slot int, product_id string, cents long, sales long"
_RANKED = "array<struct<no_cents:boolean, less:bigint, no_id:boolean, product_id:string>>"
_PARTS = (
    f"closed_at timestamp, bucket int, slot int, cents long, tops {_RANKED}, "
    "ids array<struct<first:int, id:string>>, late long"
)
_COLUMNS = ["closed_at", "bucket", "slot", "cents", "tops", "ids", "late"]

#: The slot of rows that count late sales.
NO_SLOT = -1


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cents per slot and product of each batch; null while a product has no readable amount."""
    keys = ["bucket", "slot", "product_id"]
    for batch in batches:
        wide = pa.table([*(batch.column(k) for k in keys), batch.column("cents").cast(pa.decimal128(19))], [*keys, "cents"])
        one = pc.ScalarAggregateOptions(min_count=1)
        sums = wide.group_by(keys).aggregate([("cents", "sum", one), ([], "count_all")])
        cents = sums["cents_sum"].cast(pa.int64())  # fails on overflow
        sums = sums.select([*keys, "count_all"]).rename_columns([*keys, "sales"])
        yield from sums.add_column(3, "cents", cents).to_batches()


def slot_end_millis(bucket: int, slot: int, steps: Steps, zone: ZoneInfo) -> int:
    """The instant at which a slot of the local clock ends."""
    wall = _EPOCH + timedelta(seconds=bucket * steps.size + (slot + 1) * steps.step)
    return int(wall.replace(tzinfo=zone, fold=1).timestamp() * 1000)


def _rank(total: tuple[str | None, int | None]) -> tuple:
    product, cents = total
    return (cents is None, -(cents or 0), product is None, product or "")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_COLUMNS).astype({"cents": "Int64"})


class SlotTimers(StatefulProcessor):
    """Unreported sales and running totals of one part of the products, by window start."""

    def __init__(self, steps: Steps, zone: str, k: int, with_ids: bool):
        self.steps, self.zone, self.k, self.with_ids = steps, ZoneInfo(zone), k, with_ids

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.following = handle.getValueState("following", "slot int")
        self.waiting = handle.getListState("waiting", "slot int, product_id string, cents long")
        self.totals = handle.getListState("totals", "product_id string, first int, cents long")

    def _end(self, bucket: int, slot: int) -> int:
        return slot_end_millis(bucket, slot, self.steps, self.zone)

    def _first_open(self, bucket: int, watermark: int) -> int:
        """The first slot that the watermark has not passed, the last if it has passed all."""
        begin = self._end(bucket, -1)
        shift = 7200 // self.steps.step + 1  # clocks may be put forward or back meanwhile
        slot = max(0, min(self.steps.last, (watermark - begin) // (self.steps.step * 1000) - shift))
        while slot < self.steps.last and self._end(bucket, slot) <= watermark:
            slot += 1
        return slot

    def handleInputRows(self, key, rows, timerValues):
        bucket, watermark = int(key[0]), timerValues.getCurrentWatermarkInMs()
        following = self.following.get()[0] if self.following.exists() else None
        if following is None and self._end(bucket, self.steps.last) <= watermark:
            late = sum(int(frame["sales"].sum()) for frame in rows)
            now = pd.Timestamp(watermark + 1, unit="ms")
            yield _frame([(now, bucket, NO_SLOT, None, [], [], late)])
            return
        first_open = self._first_open(bucket, watermark)
        sales = []
        for frame in rows:
            for slot, product, cents in zip(frame["slot"], frame["product_id"], frame["cents"]):
                product = None if pd.isna(product) else product
                sales.append((max(int(slot), first_open), product, None if pd.isna(cents) else int(cents)))
        self.waiting.appendList(sales)
        soonest = min(s[0] for s in sales)
        if following is None or soonest < following:
            if following is not None:
                self.handle.deleteTimer(self._end(bucket, following))
            self.following.update((soonest,))
            self.handle.registerTimer(self._end(bucket, soonest))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        bucket, watermark = int(key[0]), timerValues.getCurrentWatermarkInMs()
        totals = {p: [first, cents] for p, first, cents in self.totals.get()}
        waiting: dict[int, list] = {}
        for sale in self.waiting.get():
            waiting.setdefault(sale[0], []).append(sale)
        slot, rows = self.following.get()[0], []
        while slot <= self.steps.last and self._end(bucket, slot) <= watermark:
            for _, product, cents in waiting.pop(slot, ()):
                known = totals.setdefault(product, [slot, None])
                if cents is not None:
                    known[1] = (known[1] or 0) + cents
            rows.append(self._part(bucket, slot, totals))
            slot += 1
        if slot > self.steps.last:
            for state in (self.following, self.waiting, self.totals):
                state.clear()
        else:
            self.following.update((slot,))
            self.totals.put([(p, first, cents) for p, (first, cents) in totals.items()])
            if waiting:
                self.waiting.put([tuple(s) for sales in waiting.values() for s in sales])
            else:
                self.waiting.clear()
            self.handle.registerTimer(self._end(bucket, slot))
        yield _frame(rows)

    def _part(self, bucket: int, slot: int, totals: dict) -> tuple:
        amounts = [c for _, c in totals.values() if c is not None]
        best = sorted(((p, c) for p, (_, c) in totals.items()), key=_rank)[: self.k]
        names = ("no_cents", "less", "no_id", "product_id")
        tops = [dict(zip(names, (c is None, None if c is None else -c, p is None, p))) for p, c in best]
        ids = [{"first": first, "id": p} for p, (first, _) in totals.items() if p is not None] if self.with_ids else []
        closed = pd.Timestamp(self._end(bucket, slot), unit="ms")
        return closed, bucket, slot, sum(amounts) if amounts else None, tops, ids, 0

    def close(self) -> None:
        pass


def closed_windows(
    orders: DataFrame,
    delay: timedelta,
    steps: Steps = Steps(),
    k: int = gmv.TOP,
    with_ids: bool = True,
    parts: int | None = None,
) -> DataFrame:
    """``bucket, slot, cents, tops, ids, late`` of every window that the newest sale less ``delay`` has closed.

    Rows whose slot is ``NO_SLOT`` are no windows: they count sales that came when none was open. A window
    is emitted once, its products in the order in which the windows of the day got them. ``parts`` are the shards of a window start's products, by default as many as
    the session has shuffle partitions.
    """
    spark = ship(orders.sparkSession)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    timed = gmv.sale_lines(orders).withColumn("at", F.col("ts_ms").cast("timestamp"))
    timed = timed.withWatermark("at", f"{delay // timedelta(milliseconds=1)} milliseconds")
    placed = with_slot(timed, "ts_ms", steps).select("bucket", "slot", "product_id", "cents")
    sums = placed.mapInArrow(_summed, _SUMS)
    keyed = sums.withColumn("part", F.pmod(F.xxhash64("product_id"), F.lit(parts))).groupBy("bucket", "part")
    shards = keyed.transformWithStateInPandas(
        statefulProcessor=SlotTimers(steps, zone, k, with_ids),
        outputStructType=_PARTS,
        outputMode="Append",
        timeMode="EventTime",
        eventTimeColumnName="closed_at",
    )
    whole = shards.groupBy("closed_at", "bucket", "slot").agg(
        F.sum("cents").alias("cents"),
        F.slice(F.sort_array(F.flatten(F.collect_list("tops"))), 1, k).alias("tops"),
        F.sort_array(F.flatten(F.collect_list("ids"))).alias("ids"),
        F.sum("late").alias("late"),
    )
    return whole.select("bucket", "slot", "cents", "tops", "ids", "late")


def _text(items) -> F.Column:
    """Names joined by commas; null where there is none."""
    return F.when(F.size(items) > 0, F.array_join(items, ","))


def all_products_report(windows: DataFrame, steps: Steps = Steps()) -> DataFrame:
    """Closed windows as rows of the report over all products."""
    tops = _text(F.filter(F.transform("tops", lambda t: t["product_id"]), lambda p: p.isNotNull()))
    ids = _text(F.transform("ids", lambda i: i["id"]))
    return gmv.report_columns(windows.withColumn("top5_product_ids", tops), steps, F.col("cents"), ids)


def best_sellers_report(windows: DataFrame, steps: Steps = Steps()) -> DataFrame:
    """Closed windows as rows of the report that counts best sellers only."""
    tops = _text(F.filter(F.transform("tops", lambda t: t["product_id"]), lambda p: p.isNotNull()))
    add = lambda total, t: F.when(t["less"].isNull(), total).otherwise(F.coalesce(total, F.lit(0)) - t["less"])
    total = F.aggregate("tops", F.lit(None).cast("bigint"), add)
    named = windows.withColumn("top5_product_ids", tops)
    return gmv.report_columns(named, steps, total, F.col("top5_product_ids"))

"""Cumulative windows against brute force, at their borders, and under skew."""

import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retailtide.operators.cumulate import Steps, cumulate
from retailtide.operators.ranking import top_k
from retailtide.plans import gmv

STEP, DAY = timedelta(minutes=10), timedelta(days=1)


def sales(seed=7, n=600, products=9, hot="p0"):
    """Three days of sales; a third of them of one product, some without amount or product."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        at = datetime(2024, 3, 1) + timedelta(seconds=rng.randrange(3 * 86_400))
        product = hot if rng.random() < 1 / 3 else f"p{rng.randrange(products)}"
        amount = None if i % 41 == 0 else Decimal(rng.randrange(-500, 90_000)) / 100
        rows.append((i, None if i % 53 == 0 else product, amount, at))
    return rows


def brute_windows(rows):
    """{(start, end): {product: total}} by copying each row into all its windows."""
    windows = defaultdict(dict)
    for _, product, amount, at in rows:
        start = datetime(at.year, at.month, at.day)
        end = start + STEP
        while end <= start + DAY:
            if at < end:
                seen = windows[start, end]
                old = seen.get(product)
                seen[product] = old if amount is None else (old or 0) + amount
            end += STEP
    return windows


def brute_report(rows):
    first = {}
    for _, product, _, at in rows:
        key = (at.date(), product)
        slot = int((at - datetime(at.year, at.month, at.day)) / STEP)
        first[key] = min(first.get(key, slot), slot)
    report = {}
    for (start, end), totals in brute_windows(rows).items():
        ranked = sorted(
            totals.items(),
            key=lambda t: (t[1] is None, -(t[1] or 0), t[0] is None, t[0] or ""),
        )[:5]
        amounts = [v for v in totals.values() if v is not None]
        ids = sorted((p for p in totals if p), key=lambda p: (first[start.date(), p], p))
        report[str(start), str(end)] = (
            sum(amounts) if amounts else None,
            ",".join(ids) or None,
            ",".join(p for p, _ in ranked if p) or None,
        )
    return report


def orders(spark, rows):
    frame = spark.createDataFrame(
        [(i, p, None if a is None else str(a), t) for i, p, a, t in rows],
        "id long, product_id string, total_amount string, at timestamp_ntz",
    )
    return frame.withColumn("ts_ms", F.col("at").cast("timestamp"))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_report_equals_brute_force(spark, seed):
    rows = sales(seed)
    got = {
        (r.window_start, r.window_end): (r.win_gmv, r.win_gmv_ids, r.top5_product_ids)
        for r in gmv.gmv_all(orders(spark, rows)).collect()
    }
    assert got == brute_report(rows)


def test_top_only_report_counts_best_sellers(spark):
    rows = sales(5)
    got = gmv.gmv_today_top(orders(spark, rows), as_of="2024-03-02").collect()
    later = [r for r in rows if r[3] >= datetime(2024, 3, 2)]
    brute = brute_windows(later)
    assert len(got) == len(brute)
    for r in got:
        totals = brute[datetime.fromisoformat(r.window_start), datetime.fromisoformat(r.window_end)]
        best = sorted(totals.items(), key=lambda t: (t[1] is None, -(t[1] or 0), t[0] is None, t[0] or ""))[:5]
        assert r.win_gmv == sum(v for _, v in best if v is not None)
        ids = ",".join(p for p, _ in best if p) or None  # a list of nulls is null
        assert r.win_gmv_ids == r.top5_product_ids == ids


def test_borders(spark):
    """A row on a slot's edge belongs to the next slot, one at midnight to the new day."""
    rows = [
        (1, "a", Decimal("1.00"), datetime(2024, 3, 1, 10, 0)),
        (2, "a", Decimal("2.00"), datetime(2024, 3, 1, 23, 59, 59, 999999)),
        (3, "a", Decimal("4.00"), datetime(2024, 3, 2)),
    ]
    got = {(r.window_start, r.window_end): r.win_gmv for r in gmv.gmv_all(orders(spark, rows)).collect()}
    day = "2024-03-01 00:00:00"
    assert (day, "2024-03-01 10:00:00") not in got
    assert got[day, "2024-03-01 10:10:00"] == 1
    assert got[day, "2024-03-01 23:50:00"] == 1
    assert got[day, "2024-03-02 00:00:00"] == 3
    assert got["2024-03-02 00:00:00", "2024-03-02 00:10:00"] == 4


def test_totals_beyond_the_report_range(spark):
    """A total that does not fit the report is null; a sum that cannot be held is an error."""
    huge = Decimal("9999999999999999.99")
    day = datetime(2024, 3, 1)
    rows = [(i, "a", huge, day + timedelta(hours=10)) for i in range(3)]
    rows += [(20, "b", Decimal("1.50"), day + timedelta(hours=9)), (21, "b", Decimal("2.00"), day + DAY)]
    got = {(r.window_start, r.window_end): r.win_gmv for r in gmv.gmv_all(orders(spark, rows)).collect()}
    assert got["2024-03-01 00:00:00", "2024-03-01 10:00:00"] == Decimal("1.50")
    assert got["2024-03-01 00:00:00", "2024-03-01 10:10:00"] is None
    assert got["2024-03-02 00:00:00", "2024-03-02 00:10:00"] == 2
    assert len(got) == 144 - 54 + 144
    with pytest.raises(Exception, match="ARITHMETIC_OVERFLOW"):
        gmv.sale_slots(orders(spark, rows[:1] * 12)).collect()


def test_days_follow_the_session_zone(shanghai):
    frame = shanghai.createDataFrame([(1, "a", "1", 1709308800000)], "id long, product_id string, total_amount string, ts long")
    frame = frame.withColumn("ts_ms", F.timestamp_millis("ts"))  # 2024-03-01 16:00 UTC
    first = gmv.gmv_all(frame).orderBy("window_end").first()
    assert (first.ds, first.window_end) == (date(2024, 3, 2), "2024-03-02 00:10:00")


def test_totals_never_fall_and_end_at_the_day(spark):
    rows = [(i, p, abs(a) if a is not None else a, t) for i, p, a, t in sales(11)]
    report = gmv.gmv_all(orders(spark, rows)).orderBy("window_start", "window_end").collect()
    by_day = defaultdict(list)
    for r in report:
        by_day[r.ds].append(r.win_gmv)
    for day, totals in by_day.items():
        assert totals == sorted(totals)
        assert totals[-1] == sum(a for _, _, a, t in rows if a is not None and t.date() == day)


def test_other_steps_and_aggregates(spark):
    rows = sales(13, 300)
    frame = orders(spark, rows).withColumn("amount", F.col("total_amount").cast("decimal(18,2)"))
    got = cumulate(
        frame,
        "at",
        ["product_id"],
        {"n": ("count", "amount"), "low": ("min", "amount"), "high": ("max", "amount"), "s": ("sum", "amount")},
        Steps(step=1800, size=3 * 3600),
    ).collect()
    step, size, epoch = timedelta(minutes=30), timedelta(hours=3), datetime(1970, 1, 1)
    want = defaultdict(list)
    for _, product, amount, at in rows:
        start = epoch + (at - epoch) // size * size
        end = start + step
        while end <= start + size:
            if at < end:
                want[start, end, product].append(amount)
            end += step
    assert len(got) == len(want)
    for r in got:
        amounts = [a for a in want[r.window_start, r.window_end, r.product_id] if a is not None]
        assert r.n == len(amounts)
        assert (r.low, r.high, r.s) == (
            (min(amounts), max(amounts), sum(amounts)) if amounts else (None, None, None)
        )


def test_size_must_be_a_multiple_of_step():
    with pytest.raises(ValueError):
        Steps(step=700)


def test_raw_epoch_filter_is_the_time_filter(spark):
    frame = spark.createDataFrame(
        [(t,) for t in (1710460799, 1710460800, 1710460799999, 1710460800000, None)], "ts long"
    ).withColumn("ts_ms", F.timestamp_millis(F.when(F.col("ts") < 10**11, F.col("ts") * 1000).otherwise(F.col("ts"))))
    by_epoch = gmv.since_today(frame, "2024-03-15").select("ts").collect()
    by_time = gmv.since_today(frame.drop("ts").withColumn("keep", F.lit(1)), "2024-03-15").count()
    assert {r.ts for r in by_epoch} == {1710460800, 1710460800000}
    assert by_time == 2


def test_top_k_is_cut_before_the_shuffle(spark):
    frame = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    plan = top_k(frame, ["g"], [F.col("id").desc()], 5)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_newest_state_per_order(spark):
    frame = spark.createDataFrame(
        [(1, 10, "c", "5"), (1, 20, "u", "7"), (2, 10, "r", "1")],
        "id long, ts long, op string, total_amount string",
    )
    got = {(r.id, r.total_amount) for r in gmv.latest_per_order(frame).collect()}
    assert got == {(1, "7"), (2, "1")}


def executed_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_report_reads_its_orders_once(spark, tmp_path):
    orders(spark, sales(3, 200)).write.parquet(str(tmp_path / "orders"))
    plan = executed_plan(gmv.gmv_all(spark.read.parquet(str(tmp_path / "orders"))))
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan
    # three of the stored columns are read, and nothing is multiplied before the first shuffle
    assert "ReadSchema: struct<product_id:string,total_amount:string,ts_ms:timestamp>" in plan


def test_no_window_or_list_gathers_a_days_products(spark):
    """Ids are joined in a group per window; the windows over a day see sums only."""
    plan = executed_plan(gmv.gmv_all(orders(spark, sales(3, 50))))
    assert "collect_list" not in plan
    over_days = [line for line in plan.splitlines() if "Window [" in line and "product_id" not in line]
    assert over_days and not any("ids" in line for line in over_days)


def test_hot_product_collapses_before_the_shuffle(spark):
    """200,000 rows of one product reach the shuffle as at most one per task and slot."""
    frame = spark.range(0, 200_000, 1, 4).select(
        F.lit("hot").alias("product_id"),
        F.lit("1.00").alias("total_amount"),
        F.timestamp_seconds(F.col("id") % 86_400 + 1709251200).alias("ts_ms"),
    )
    slots = gmv.sale_slots(frame)
    assert slots.agg(F.sum("cents")).first()[0] == 20_000_000
    slots.collect()
    plan = slots._jdf.queryExecution().executedPlan()
    written = shuffled_rows(plan)
    assert written <= 4 * 144


def shuffled_rows(plan):
    """Records written by the first shuffle of an executed adaptive plan."""
    stage = plan.executedPlan()
    while not (name := stage.getClass().getSimpleName()).startswith("ShuffleQueryStage"):
        stage = stage.plan() if name.startswith("ResultQueryStage") else stage.children().head()
    return stage.shuffle().metrics().get("shuffleRecordsWritten").get().value()


def test_products_that_cannot_be_best_sellers_are_left_out_before_windows_are_filled(spark):
    """Two thousand small products and a few great ones: hardly a row of the small ones reaches the sort."""
    rng = random.Random(3)
    start = datetime(2024, 3, 1)
    rows = [
        (f"big{i % 6}", Decimal(1000 + rng.randrange(100)), start + timedelta(minutes=10 * (i // 6) + 1)) for i in range(6 * 144)
    ]
    rows += [(f"small{rng.randrange(2000)}", Decimal(rng.randrange(-5, 90)), start + timedelta(seconds=rng.randrange(86_400))) for _ in range(6000)]
    rows += [(None, None, start + timedelta(minutes=3)), ("none", None, start + timedelta(minutes=4))]
    frame = spark.createDataFrame(rows, "product_id string, total_amount decimal(18,2), ts_ms timestamp")
    from retailtide.operators.cumulate import fill_windows, running_totals

    running = running_totals(gmv.sale_slots(frame), ["product_id"], {"cents": "sum"})
    before, after = fill_windows(running).count(), fill_windows(gmv.pruned(running)).count()
    assert after * 10 < before
    want = top_k(
        fill_windows(running), ["bucket", "slot"], [F.col("cents").desc_nulls_last(), F.col("product_id").asc_nulls_last()], 5
    )
    got = gmv._ranked(gmv.sale_slots(frame), Steps(), 5, prune=True)
    order = lambda df: sorted((tuple(r) for r in df.select("bucket", "slot", "rn", "product_id", "cents").collect()), key=repr)
    assert order(got) == order(want)


@pytest.mark.parametrize("seed", [1, 2])
def test_pruned_best_sellers_of_rows_with_refunds_and_gaps(spark, seed):
    frame = spark.createDataFrame(
        [(p, a, t) for _, p, a, t in sales(seed, 300, 12)], "product_id string, total_amount decimal(18,2), ts_ms timestamp"
    )
    order = lambda df: sorted((tuple(r) for r in df.select("bucket", "slot", "rn", "product_id", "cents").collect()), key=repr)
    slots = gmv.sale_slots(frame)
    assert order(gmv._ranked(slots, Steps(), 5, prune=True)) == order(gmv._ranked(slots, Steps(), 5))

"""Sales (GMV) reports over cumulative ten-minute windows of a day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailtide.functions.texts import cents, clean_product_id, from_cents, money
from retailtide.functions.times import epoch_from, start_of_day
from retailtide.operators.cumulate import (
    Steps,
    fill_windows,
    running_totals,
    slot_totals,
    window_end,
    window_start,
    with_bounds,
)
from retailtide.operators.latest import latest_by_key
from retailtide.operators.ranking import top_k

TOP = 5

Span = tuple[int | None, int | None]
ALL: Span = (None, None)


def sale_lines(orders: DataFrame, *keep: str) -> DataFrame:
    """The three columns the sales reports use, cleaned, and any to ``keep`` beside them."""
    return orders.select(
        *keep,
        clean_product_id(F.col("product_id")).alias("product_id"),
        cents(money(F.col("total_amount"))).alias("cents"),
        "ts_ms",
    )


def latest_per_order(
    orders: DataFrame, key: str = "id", order: tuple[str, ...] | list[str] = ("ts", "op")
) -> DataFrame:
    """Optional: count only the newest state of each order instead of every change."""
    return latest_by_key(orders, [key], F.struct(*order))


def sale_slots(orders: DataFrame, steps: Steps = Steps()) -> DataFrame:
    """Cents per (day, slot, product)."""
    return slot_totals(sale_lines(orders), "ts_ms", ["product_id"], {"cents": ("sum", "cents")}, steps)


def _product_windows(slots: DataFrame, steps: Steps, span: Span = ALL) -> DataFrame:
    running = running_totals(slots, ["product_id"], {"cents": "sum"})
    return fill_windows(running, steps, *span)


def product_windows(orders: DataFrame, steps: Steps = Steps()) -> DataFrame:
    """Product sales of every cumulative window."""
    filled = with_bounds(_product_windows(sale_slots(orders, steps), steps), steps)
    return filled.select(
        "window_start", "window_end", "product_id", from_cents(F.col("cents")).alias("product_gmv")
    )


_LOWEST = -(2**63)


def _bounds(running: DataFrame, steps: Steps, k: int) -> DataFrame:
    """``bucket, bounds``: for each slot a total that at least ``k`` products reach in its window.

    Any ``k`` products will do, the least of their totals being such a bound; these are the ones that
    sold most in the day. Slots before all of them have sold have no bound. There are ``k`` products and one
    row a day, however many products there are.
    """
    most = running.groupBy("bucket", "product_id").agg(F.max("cents").alias("cents")).filter("cents is not null")
    leaders = top_k(most, ["bucket"], [F.col("cents").desc(), F.col("product_id").asc_nulls_last()], k)
    chosen = leaders.groupBy("bucket").agg(F.collect_list(F.struct("product_id")).alias("leaders"))
    named = running.join(F.broadcast(chosen), "bucket").filter(
        F.exists("leaders", lambda p: p["product_id"].eqNullSafe(F.col("product_id")))
    )
    windows = fill_windows(named.drop("leaders"), steps).groupBy("bucket", "slot")
    least = windows.agg(F.min("cents").alias("least"), F.count("cents").alias("n")).filter(F.col("n") == k)
    by_slot = least.groupBy("bucket").agg(F.map_from_entries(F.collect_list(F.struct("slot", "least"))).alias("of"))
    slot = F.sequence(F.lit(0), F.lit(steps.last))
    bound = F.transform(slot, lambda s: F.coalesce(F.col("of")[s], F.lit(_LOWEST).cast("bigint")))
    return by_slot.select("bucket", bound.alias("bounds"))


def pruned(running: DataFrame, steps: Steps = Steps(), k: int = TOP) -> DataFrame:
    """Running totals without those that are below a bound of the best ``k`` in all windows they fill.

    The bounds are a row a day, of a few bytes a slot: a century of days is within the broadcast limit.
    """
    until = F.coalesce(F.col("next_slot") - 1, F.lit(steps.last))
    inside = F.slice(F.col("bounds"), F.col("slot") + 1, until - F.col("slot") + 1)
    lowest = F.lit(_LOWEST).cast("bigint")
    reached = F.coalesce("cents", lowest) >= F.coalesce(F.array_min(inside), lowest)
    bounds = F.broadcast(_bounds(running, steps, k))
    return running.join(bounds, "bucket", "left").filter(reached).drop("bounds")


def _ranked(slots: DataFrame, steps: Steps, k: int, span: Span = ALL, prune: bool = False) -> DataFrame:
    running = running_totals(slots, ["product_id"], {"cents": "sum"})
    if prune:
        running = pruned(running, steps, k)
    return top_k(
        fill_windows(running, steps, *span),
        ["bucket", "slot"],
        [F.col("cents").desc_nulls_last(), F.col("product_id").asc_nulls_last()],
        k,
    )


def top_products(orders: DataFrame, steps: Steps = Steps(), k: int = TOP) -> DataFrame:
    """Best sellers of every cumulative window, with their rank.

    Products that cannot be among them are left out before windows are filled.
    """
    slots = _computed_once(sale_slots(orders, steps))
    return with_bounds(_ranked(slots, steps, k, prune=True), steps).select(
        "window_start",
        "window_end",
        "product_id",
        from_cents(F.col("cents")).alias("product_gmv"),
        "rn",
    )


def _computed_once(slots: DataFrame) -> DataFrame:
    """Let the branches of a report share the slot aggregate, and so one read of the orders.

    Spark reuses a shuffle only between equal plans. A branch that does not look at the sums
    would get its own aggregate without them; this condition, which every row meets, keeps
    them in all branches.
    """
    lowest = F.lit(-(2**63)).cast("bigint")
    return slots.filter(F.col("cents").isNull() | (F.col("cents") >= lowest))


def _new_ids(slots: DataFrame) -> DataFrame:
    """Products per slot of their first sale of the day, as one text in id order."""
    by_product = Window.partitionBy("bucket", "product_id").orderBy("slot")
    firsts = slots.withColumn("nth", F.row_number().over(by_product)).filter("nth = 1")
    ids = F.expr("listagg(product_id, ',') WITHIN GROUP (ORDER BY product_id)")
    return firsts.groupBy("bucket", "slot").agg(ids.alias("ids")).filter("ids is not null")


def _id_lists(slots: DataFrame, steps: Steps, span: Span) -> DataFrame:
    """Product list of every window: those of its slots, in the order of their first sales.

    A slot's text goes to each window that has it, so a window's list is joined in a group of its
    own and no task holds a day's.
    """
    texts = _new_ids(slots).select(
        "bucket", "slot", F.lit(None).cast("int").alias("next_slot"), "ids", F.col("slot").alias("first")
    )
    joined = F.expr("listagg(ids, ',') WITHIN GROUP (ORDER BY first)")
    return fill_windows(texts, steps, *span).groupBy("bucket", "slot").agg(joined.alias("win_gmv_ids"))


def _window_totals(slots: DataFrame, steps: Steps, with_ids: bool, span: Span) -> DataFrame:
    """Total and product list of every window, from per-slot totals."""
    per_slot = slots.groupBy("bucket", "slot").agg(F.sum("cents").alias("cents"))
    totals = fill_windows(running_totals(per_slot, [], {"cents": "sum"}), steps, *span)
    if with_ids:
        # while all sales lack a product id there is no list at all
        totals = totals.join(_id_lists(slots, steps, span), ["bucket", "slot"], "left")
    return totals


def _top_lists(slots: DataFrame, steps: Steps, k: int, span: Span) -> DataFrame:
    return (
        _ranked(slots, steps, k, span)
        .groupBy("bucket", "slot")
        .agg(
            F.expr("listagg(product_id, ',') WITHIN GROUP (ORDER BY rn)").alias("top5_product_ids"),
            F.sum("cents").alias("top_cents"),
        )
    )


def report_columns(df: DataFrame, steps: Steps, amount: Column, ids: Column) -> DataFrame:
    return df.select(
        window_start(steps).cast("date").alias("ds"),
        window_start(steps).cast("string").alias("window_start"),
        window_end(steps).cast("string").alias("window_end"),
        from_cents(amount).alias("win_gmv"),
        ids.alias("win_gmv_ids"),
        "top5_product_ids",
    )


def gmv_all_from_slots(
    slots: DataFrame,
    steps: Steps = Steps(),
    k: int = TOP,
    with_ids: bool = True,
    span: Span = ALL,
) -> DataFrame:
    """All-product total, product list and best sellers per window.

    ``span`` keeps the windows after one position up to another (see ``Steps.position``).
    """
    slots = _computed_once(slots)
    totals = _window_totals(slots, steps, with_ids, span)
    tops = _top_lists(slots, steps, k, span).drop("top_cents")
    ids = F.col("win_gmv_ids") if with_ids else F.lit(None).cast("string")
    return report_columns(totals.join(tops, ["bucket", "slot"]), steps, F.col("cents"), ids)


def gmv_top_from_slots(
    slots: DataFrame, steps: Steps = Steps(), k: int = TOP, span: Span = ALL
) -> DataFrame:
    """The other report's rule: only the best sellers count, in total and in both lists."""
    tops = _top_lists(slots, steps, k, span)
    return report_columns(tops, steps, F.col("top_cents"), F.col("top5_product_ids"))


def gmv_all(
    orders: DataFrame, steps: Steps = Steps(), k: int = TOP, with_ids: bool = True
) -> DataFrame:
    """All-history cumulative sales per window.

    ``with_ids=False`` leaves the full product list out; its text grows with the number of
    products sold in a day, and ``product_windows`` holds the same facts as rows.
    """
    return gmv_all_from_slots(sale_slots(orders, steps), steps, k, with_ids)


def since_today(orders: DataFrame, as_of=None) -> DataFrame:
    """Orders from today's midnight on, by the raw epoch where there is one."""
    midnight = start_of_day(as_of)
    if "ts" in orders.columns:
        return orders.filter(epoch_from(F.col("ts"), midnight))
    return orders.filter(F.col("ts_ms") >= midnight)


def gmv_today_top(orders: DataFrame, as_of=None, steps: Steps = Steps(), k: int = TOP) -> DataFrame:
    """Cumulative sales from today on, counting the best sellers of each window only."""
    return gmv_top_from_slots(sale_slots(since_today(orders, as_of), steps), steps, k)

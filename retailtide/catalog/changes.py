"""Parsing: change records, broken texts, log and order texts, time rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from retailtide import schemas
from retailtide.catalog import derive
from retailtide.functions import times
from retailtide.operators import handover, parse
from retailtide.plans import changes
from retailtide.plans.gmv import latest_per_order, sale_lines


def cdc_flatten(spark, sf_dir):
    texts = derive.changes(derive.table(spark, sf_dir, "orders"))
    flat = parse.flatten_changes(parse.parsed(parse.order_changes(texts)))
    unlisted = [F.get_json_object("after", f"$.{n}").alias(n) for n in ("priority", "lines")]
    return flat.select("id", "order_id", "user_id", "total_amount", "ds", *unlisted, "table_name", "op")


def cdc_topic_text(spark, sf_dir):
    return changes.order_topic(derive.changes(derive.table(spark, sf_dir, "orders")))


def cdc_snapshot(spark, sf_dir):
    """Present rows of a table as the first phase of its change feed, flattened again."""
    rows = derive.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("user_id")
    )
    texts = parse.snapshot_changes(rows, "oms", "dbo", "orders")
    flat = parse.flatten_changes(parse.parsed(parse.order_changes(texts)))
    return flat.select("id", "user_id", "table_name", "op")


def log_texts(events):
    """Events as log texts, every tenth damaged in one of five ways."""
    number = F.col("log_id").cast("bigint")
    stamp = F.unix_millis(F.col("ts").cast("timestamp")).alias("ts")
    logs = derive.log_columns(events, stamp)
    good = F.to_json(F.struct(*logs.columns))
    kind = F.floor(number / 10) % 5
    bad = (
        F.when(kind == 0, F.concat(F.lit("{broken "), number))
        .when(kind == 1, F.concat(F.lit("["), number, F.lit("]")))
        .when(kind == 2, F.lit("null"))
        .when(kind == 3, F.concat(good, F.lit(" tail")))
        .otherwise(F.lit(""))
    )
    return logs.select(
        number.alias("event_id"), F.when(number % 10 == 0, bad).otherwise(good).alias("value")
    )


def json_dead_letter(spark, sf_dir):
    texts = parse.with_record(log_texts(derive.table(spark, sf_dir, "events")), schemas.LOG)
    return texts.filter(F.col("record").isNull()).select("event_id")


def json_log_records(spark, sf_dir):
    """Complete log records read back from their texts."""
    texts = parse.with_record(log_texts(derive.table(spark, sf_dir, "events")), schemas.LOG)
    records = parse.log_records(texts)
    return records.filter(parse.complete_log()).select(
        F.col("log_id").cast("bigint").alias("event_id"),
        "log_type",
        F.col("gis.ip").alias("ip"),
        F.col("device.plat").alias("plat"),
        F.col("device.brand").alias("brand"),
        times.day_text(F.col("event_time")).alias("day"),
    )


def json_order_records(spark, sf_dir):
    """Order texts to typed rows with a clean product id, a decimal amount and an event time."""
    texts = parse.as_json(derive.order_columns(derive.table(spark, sf_dir, "events")))
    records = parse.order_records(parse.with_record(texts, schemas.ORDER))
    lines = sale_lines(records.withColumn("order_no", F.col("id")), "order_no")
    return lines.select(
        F.col("order_no").alias("id"),
        "product_id",
        "cents",
        times.second_text(F.col("ts_ms")).alias("at"),
    )


def order_latest_state(spark, sf_dir):
    """Optional rule of the sales reports: only the newest state of each order counts."""
    lineitem = derive.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_linenumber").cast("bigint").alias("ts"),
        F.lit("u").alias("op"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("total_amount"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("user_id"),
    )
    return latest_per_order(lineitem, order=["ts", "total_amount", "product_id", "user_id"]).select(
        "id", "ts", "total_amount"
    )


def epoch_day_rules(spark, sf_dir):
    """Both epoch rules on seconds, milliseconds and lengths that only one of them accepts."""
    instant = F.col("ts").cast("timestamp")
    kind = F.col("event_id") % 4
    epoch = (
        F.when(kind == 0, F.unix_seconds(instant))
        .when(kind == 1, F.unix_millis(instant))
        .when(kind == 2, F.floor(F.unix_seconds(instant) / 10))
        .otherwise(F.unix_micros(instant))
    )
    rows = derive.table(spark, sf_dir, "events").select("event_id", epoch.alias("epoch"))
    order_ts = F.when(kind != 3, times.order_time(F.col("epoch")))
    return rows.select(
        "event_id",
        times.day_text(times.log_time(F.col("epoch"))).alias("log_day"),
        times.pt_of_day_text(times.day_text(times.log_time(F.col("epoch")))).alias("pt"),
        times.second_text(order_ts).alias("order_at"),
    )


def cdc_handover(spark, sf_dir):
    """Newest state of the orders from a snapshot in ten chunks and the changes that overlap with it.

    The feed has a change for every fifth order, a delete for every seventh of those, and orders that are
    new. Chunk ``c`` lies between the marks ``100 * c`` and ``100 * c + 60`` and is read in the middle.
    """
    orders = derive.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount")
    )
    key, seq, raised = F.col("id"), F.col("id") * 7919 % 1000 + 1, (F.col("amount") + 1).cast("decimal(18,2)")
    is_new, is_changed, is_deleted = key % 11 == 3, key % 5 == 0, key % 35 == 0
    image = lambda amount: F.struct(amount.alias("amount"))
    changes = (
        orders.filter(is_new).select("id", F.lit("c").alias("op"), image(F.col("amount")).alias("image"), seq.alias("seq"))
    ).unionAll(
        orders.filter(is_changed & ~is_new).select(
            "id",
            F.when(is_deleted, "d").otherwise("u").alias("op"),
            F.when(~is_deleted, image(raised)).alias("image"),
            seq.alias("seq"),
        )
    )
    low = key % 10 * 100
    seen = seq <= low + 30
    snapshot = orders.filter((~is_new | seen) & ~(is_deleted & ~is_new & seen)).select(
        "id", image(F.when(is_changed & ~is_new & seen, raised).otherwise(F.col("amount"))).alias("image"),
        low.alias("low"), (low + 60).alias("high"),
    )
    feed = handover.joined_feed(snapshot, changes, "id")
    return handover.newest_state(feed, "id").select("id", "image.amount")


QUERIES = {
    "cdc_handover": cdc_handover,
    "cdc_flatten": cdc_flatten,
    "cdc_topic_text": cdc_topic_text,
    "cdc_snapshot": cdc_snapshot,
    "json_dead_letter": json_dead_letter,
    "json_log_records": json_log_records,
    "json_order_records": json_order_records,
    "order_latest_state": order_latest_state,
    "epoch_day_rules": epoch_day_rules,
}

_TABLE_NAME = "'oms.' || CASE WHEN o_orderkey % 3 <> 0 THEN 'dbo' ELSE '' END || '.orders'"
_OP = "CASE o_orderstatus WHEN 'F' THEN 'c' ELSE 'u' END"

ORACLE = {
    "cdc_handover": """
SELECT o_orderkey AS id,
       CAST(CAST(o_totalprice AS DECIMAL(18,2))
            + CASE WHEN o_orderkey % 5 = 0 AND o_orderkey % 11 <> 3 THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS amount
FROM orders WHERE o_orderkey % 35 <> 0 OR o_orderkey % 11 = 3""",
    "cdc_flatten": f"""
SELECT CAST(o_orderkey AS VARCHAR) AS id, 'SO' || o_orderkey AS order_id,
       CAST(o_custkey AS VARCHAR) AS user_id,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total_amount,
       strftime(o_orderdate, '%Y%m%d') AS ds, o_orderpriority AS priority,
       CAST(o_orderkey % 7 AS VARCHAR) AS lines,
       {_TABLE_NAME} AS table_name, {_OP} AS op
FROM orders WHERE o_orderstatus <> 'P'""",
    "cdc_topic_text": f"""
SELECT '{{"ds":"' || strftime(o_orderdate, '%Y%m%d') || '","id":' || o_orderkey
       || ',"lines":' || (o_orderkey % 7) || ',"order_id":"SO' || o_orderkey
       || '","priority":"' || o_orderpriority || '","total_amount":"'
       || CAST(o_totalprice AS DECIMAL(18,2)) || '","user_id":"' || o_custkey
       || '","table_name":"' || {_TABLE_NAME} || '","op":"' || {_OP} || '"}}' AS "value"
FROM orders WHERE o_orderstatus <> 'P'""",
    "cdc_snapshot": """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
       'oms.dbo.orders' AS table_name, 'r' AS op
FROM orders""",
    "json_dead_letter": "SELECT event_id FROM events WHERE event_id % 10 = 0",
    "json_log_records": """
SELECT event_id, event_type AS log_type,
       '10.' || (user_id % 30) || '.' || (event_id % 256) || '.1' AS ip,
       upper(event_type) AS plat,
       CASE WHEN k % 10 <> 3 THEN 'B' || (k % 7) END AS brand,
       strftime(ts, '%Y%m%d') AS day
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
WHERE event_id % 10 <> 0""",
    "json_order_records": """
SELECT event_id AS id, json_extract_string(props, '$.k') AS product_id,
       CASE WHEN event_id % 97 <> 0 THEN CAST(CAST(value AS DECIMAL(18,2)) * 100 AS BIGINT) END AS cents,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS at
FROM events""",
    "order_latest_state": """
SELECT id, ts, total_amount FROM (
    SELECT l_orderkey AS id, CAST(l_linenumber AS BIGINT) AS ts,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS total_amount,
           row_number() OVER (PARTITION BY l_orderkey
               ORDER BY l_linenumber DESC, CAST(l_extendedprice AS DECIMAL(18,2)) DESC,
                        l_partkey DESC, l_suppkey DESC) AS n
    FROM lineitem) WHERE n = 1""",
    "epoch_day_rules": """
SELECT event_id,
       CASE WHEN event_id % 4 < 2 THEN strftime(ts, '%Y%m%d') END AS log_day,
       CASE WHEN event_id % 4 < 2 THEN CAST(ts AS DATE) END AS pt,
       CASE event_id % 4
            WHEN 2 THEN strftime(make_timestamp(CAST(floor(epoch(ts) / 10) AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S')
            WHEN 3 THEN NULL
            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS order_at
FROM events""",
}

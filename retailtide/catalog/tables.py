"""Key/value tables, membership, keyed upserts, retention, naming and event-time fields."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from retailtide.catalog import derive
from retailtide.functions.texts import camel_columns
from retailtide.operators import kv, membership
from retailtide.operators.latest import latest_by_key
from retailtide.session import shared_folder
from retailtide.functions import times
from retailtide.sinks.entries import EntryTable, fold, get_stored, read_present, store_by_key, write_entries
from retailtide.sinks.retention import kept, truncate
from retailtide.sinks.tables import (
    ReportTable,
    compact,
    day_files,
    read_batches,
    read_rejected,
    read_table,
    write_batch,
)
from retailtide.streaming import watermarks

FIELDS = ["c_name", "c_mktsegment", "c_nationkey", "c_acctbal"]


def _customer_cells(spark, sf_dir):
    customer = derive.table(spark, sf_dir, "customer").withColumn(
        "c_acctbal", F.col("c_acctbal").cast("decimal(18,2)")
    )
    key = F.format_string("%09d", "c_custkey")
    cells = kv.to_cells(customer.select("c_custkey", *FIELDS), key)
    return cells.filter(F.col("qualifier") != "c_custkey")


def _customer_rows(spark, sf_dir):
    return kv.cells_to_rows(_customer_cells(spark, sf_dir), FIELDS)


def kv_cells(spark, sf_dir):
    return _customer_cells(spark, sf_dir)


def kv_cells_to_rows(spark, sf_dir):
    return _customer_rows(spark, sf_dir)


def kv_cells_to_maps(spark, sf_dir):
    rows = kv.cells_to_maps(kv_cells(spark, sf_dir))
    return rows.select("row_key", F.to_json("info").alias("info"))


def kv_get(spark, sf_dir):
    return kv.get(_customer_rows(spark, sf_dir), "000000042")


def kv_get_stored(spark, sf_dir):
    """The row of a key in a table laid out by key."""
    path = f"{shared_folder(spark, 'kv_get_stored')}/table"
    store_by_key(_customer_rows(spark, sf_dir), path, 16)
    return get_stored(spark, path, "000000042", 16)


def kv_get_many(spark, sf_dir):
    """Rows of the customers that ordered in urgent priority."""
    orders = derive.table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    keys = orders.select(F.format_string("%09d", "o_custkey").alias("row_key")).distinct()
    return kv.get_many(_customer_rows(spark, sf_dir), keys)


def kv_delete(spark, sf_dir):
    """The table without the customers that ordered in urgent priority."""
    orders = derive.table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    keys = orders.select(F.format_string("%09d", "o_custkey").alias("row_key")).distinct()
    return kv.delete(_customer_rows(spark, sf_dir), keys)


def _stored_entries(spark, sf_dir, purpose):
    """Customers put, those with urgent orders deleted, those of one segment put again; the deletes twice."""
    customer = derive.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    orders = derive.table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    key = F.format_string("%09d", "c_custkey")
    urgent = orders.select(F.format_string("%09d", "o_custkey").alias("row_key")).distinct()
    again = customer.filter(F.col("c_mktsegment") == "BUILDING").withColumn("c_name", F.upper("c_name"))
    table = EntryTable(f"{shared_folder(spark, purpose)}/entries", files=4)
    deletes = kv.delete_entries(urgent, F.lit(1))
    write_entries(kv.put_entries(customer, key, F.lit(0)), 0, table)
    write_entries(deletes, 1, table)
    write_entries(kv.put_entries(again, key, F.lit(2)), 2, table)
    write_entries(deletes, 1, table)
    return table


def _entry_rows(spark, table):
    rows = read_present(spark, table)
    return rows.select("row_key", *[F.col("info")[c].alias(c) for c in ("c_name", "c_mktsegment")])


def kv_tombstones(spark, sf_dir):
    """Put, delete and put over three batches, one of them replayed."""
    return _entry_rows(spark, _stored_entries(spark, sf_dir, "kv_tombstones"))


def kv_tombstones_folded(spark, sf_dir):
    """The same when the first two batches are folded."""
    table = _stored_entries(spark, sf_dir, "kv_tombstones_folded")
    new = EntryTable(f"{table.path}_folded", files=4)
    fold(spark, table, new, 1)
    return _entry_rows(spark, new)


def kv_scan_limit(spark, sf_dir):
    return kv.scan(_customer_rows(spark, sf_dir), 25)


def kv_count(spark, sf_dir):
    return kv.count_rows(derive.table(spark, sf_dir, "customer"))


def kv_put_latest(spark, sf_dir):
    """Orders put under their customer's key, in order of the order key."""
    orders = derive.table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderpriority"
    )
    return kv.put(orders, F.col("o_custkey"), F.col("o_orderkey"))


def _part_words(spark, sf_dir):
    part = derive.table(spark, sf_dir, "part")
    return part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))


def _listed_words(spark, sf_dir):
    """Two named word sets: words of cheap parts' names, and of the rest."""
    part = derive.table(spark, sf_dir, "part")
    name = F.when(F.col("p_retailprice") < 900.3, F.lit("listed")).otherwise(F.lit("other"))
    sets = part.select(name.alias("set_name"), F.explode(F.split("p_name", " ")).alias("word"))
    return membership.members(sets, "listed")


def blacklist_semi(spark, sf_dir):
    return membership.in_set(_part_words(spark, sf_dir), "word", _listed_words(spark, sf_dir))


def blacklist_anti(spark, sf_dir):
    return membership.not_in_set(_part_words(spark, sf_dir), "word", _listed_words(spark, sf_dir))


def blacklist_flag(spark, sf_dir):
    return membership.flag_in_set(_part_words(spark, sf_dir), "word", _listed_words(spark, sf_dir))


def upsert_last_wins(spark, sf_dir):
    """Newest event per user and type."""
    events = derive.table(spark, sf_dir, "events").select(
        "user_id", "event_type", "event_id", F.col("value").cast("decimal(18,2)").alias("value")
    )
    return latest_by_key(events, ["user_id", "event_type"], F.col("event_id"))


def _report_rows(spark, sf_dir):
    return derive.table(spark, sf_dir, "events").select(
        F.col("ts").cast("date").alias("pt"),
        "user_id",
        "event_type",
        "event_id",
        F.col("value").cast("decimal(18,2)").alias("value"),
        F.hour("ts").alias("hour"),
    )


def _stored_report(spark, sf_dir, purpose):
    """Events written to a keyed table in two batches, the second of them twice."""
    events = _report_rows(spark, sf_dir)
    table = ReportTable(
        f"{shared_folder(spark, purpose)}/table",
        ("pt", "user_id", "event_type"),
        required=("pt", "user_id"),
        files=day_files(spark, 2),
    )
    late = events.filter("hour >= 12").drop("hour")
    write_batch(events.filter("hour < 12").drop("hour"), 0, table, F.col("event_id"))
    for _ in range(2):
        write_batch(late, 1, table, F.col("event_id"))
    return table


def report_table_upsert(spark, sf_dir):
    """Newest row per key of a table written by batches, one of which was replayed."""
    table = _stored_report(spark, sf_dir, "report_table_upsert")
    return read_table(spark, table).drop("update_time")


def report_table_compacted(spark, sf_dir):
    """The same after its older batches were folded into one and the newest was replayed."""
    table = _stored_report(spark, sf_dir, "report_table_compacted")
    compacted = replace(table, path=f"{table.path}_compacted")
    compact(spark, table, compacted.path)
    write_batch(_report_rows(spark, sf_dir).filter("hour >= 12").drop("hour"), 1, compacted, F.col("event_id"))
    return read_table(spark, compacted).drop("update_time")


def report_table_rejects(spark, sf_dir):
    """Rows of a load with what became of them: stored, or kept beside the table for want of a user."""
    rows = _report_rows(spark, sf_dir).drop("hour").withColumn(
        "user_id", F.when(F.col("event_id") % 20 != 0, F.col("user_id"))
    )
    path = f"{shared_folder(spark, 'report_table_rejects')}/table"
    table = ReportTable(path, required=("pt", "user_id"), files=day_files(spark))
    write_batch(rows, 0, table)
    columns = ["event_id", "user_id", F.col("batch_id").cast("bigint").alias("batch_id")]
    stored = read_batches(spark, table).select(*columns, F.lit("stored").alias("fate"))
    return stored.union(read_rejected(spark, table).select(*columns, F.lit("rejected").alias("fate")))


def report_table_truncated(spark, sf_dir):
    """A table after all its days were cleared and one more batch was written."""
    table = _stored_report(spark, sf_dir, "report_table_truncated")
    truncate(spark, table.path)
    write_batch(_report_rows(spark, sf_dir).filter("hour >= 12").drop("hour"), 2, table, F.col("event_id"))
    return read_table(spark, table).drop("update_time")


def retention_30d(spark, sf_dir):
    """Line items of the days a report table would still hold."""
    lines = derive.table(spark, sf_dir, "lineitem").withColumn("pt", F.col("l_shipdate").cast("date"))
    held = kept(lines, "1998-06-30")
    return held.select("l_orderkey", "l_linenumber", "l_partkey", "pt")


def camel_names(spark, sf_dir):
    return camel_columns(derive.table(spark, sf_dir, "nation"))


def watermark_block_ts(spark, sf_dir):
    """Event time of records that carry a block time, or else a plain time, in seconds."""
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    records = derive.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_id") % 2 == 0, seconds).alias("block_timestamp"),
        (seconds + 60).alias("timestamp"),
    )
    timed = watermarks.by_block_time(records, "5 seconds")
    return timed.select("event_id", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("at"))


def watermark_list_first(spark, sf_dir):
    """Event time of list records: their first element's window start."""
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    item = F.struct(millis.alias("window_start_time"))
    later = F.struct((millis + 60_000).alias("window_start_time"))
    records = derive.table(spark, sf_dir, "events").select(
        "event_id", F.array(item, later).alias("items")
    )
    timed = watermarks.by_first_item(records, "5 seconds")
    return timed.select("event_id", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("at"))


def watermark_text_field(spark, sf_dir):
    """Event time of raw texts from a named field; texts without it count from the epoch."""
    number = F.col("event_id")
    stamp = F.unix_millis(F.col("ts").cast("timestamp"))
    text = (
        F.when(number % 5 == 0, F.lit("{broken"))
        .when(number % 7 == 0, F.to_json(F.struct(number.alias("event_id"))))
        .otherwise(F.to_json(F.struct(number.alias("event_id"), stamp.alias("ts"))))
    )
    texts = derive.table(spark, sf_dir, "events").select("event_id", text.alias("value"))
    timed = watermarks.by_text_field(texts, "ts", "5 seconds")
    return timed.select("event_id", F.unix_millis("event_time").alias("at"))


def time_floors(spark, sf_dir):
    """The five-minute tick of each event and its milliseconds since its day's midnight."""
    instant = F.col("ts").cast("timestamp")
    return derive.table(spark, sf_dir, "events").select(
        "event_id",
        times.floor_to_step(F.unix_seconds(instant)).alias("tick"),
        (F.unix_millis(instant) - times.start_of_day_millis(instant)).alias("since_midnight"),
    )


QUERIES = {
    "kv_get_stored": kv_get_stored,
    "kv_tombstones": kv_tombstones,
    "kv_tombstones_folded": kv_tombstones_folded,
    "report_table_rejects": report_table_rejects,
    "report_table_truncated": report_table_truncated,
    "time_floors": time_floors,
    "kv_cells": kv_cells,
    "kv_cells_to_rows": kv_cells_to_rows,
    "kv_cells_to_maps": kv_cells_to_maps,
    "kv_get": kv_get,
    "kv_get_many": kv_get_many,
    "kv_delete": kv_delete,
    "kv_scan_limit": kv_scan_limit,
    "kv_count": kv_count,
    "kv_put_latest": kv_put_latest,
    "blacklist_semi": blacklist_semi,
    "blacklist_anti": blacklist_anti,
    "blacklist_flag": blacklist_flag,
    "upsert_last_wins": upsert_last_wins,
    "report_table_upsert": report_table_upsert,
    "report_table_compacted": report_table_compacted,
    "retention_30d": retention_30d,
    "camel_names": camel_names,
    "watermark_block_ts": watermark_block_ts,
    "watermark_list_first": watermark_list_first,
    "watermark_text_field": watermark_text_field,
}

_ROWS = """WITH kv AS (
    SELECT lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS row_key, c_name, c_mktsegment,
           CAST(c_nationkey AS VARCHAR) AS c_nationkey,
           CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS c_acctbal
    FROM customer
),
urgent AS (
    SELECT DISTINCT lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS row_key
    FROM orders WHERE o_orderpriority = '1-URGENT'
)
"""

_WORD_SETS = """WITH words AS (
    SELECT p_partkey, p_retailprice, unnest(string_split(p_name, ' ')) AS word FROM part
),
listed AS (SELECT DISTINCT word FROM words WHERE p_retailprice < 900.3)
"""

_STORED = """
SELECT CAST(ts AS DATE) AS pt, user_id, event_type,
       arg_max(event_id, (hour(ts) >= 12, event_id)) AS event_id,
       arg_max(CAST(value AS DECIMAL(18,2)), (hour(ts) >= 12, event_id)) AS "value"
FROM events GROUP BY ALL"""

_TOMBSTONES = """
SELECT printf('%09d', c_custkey) AS row_key,
       CASE WHEN c_mktsegment = 'BUILDING' THEN upper(c_name) ELSE c_name END AS c_name, c_mktsegment
FROM customer
WHERE c_mktsegment = 'BUILDING'
   OR c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')"""

ORACLE = {
    "kv_get_stored": _ROWS + "SELECT * FROM kv WHERE row_key = '000000042'",
    "kv_tombstones": _TOMBSTONES,
    "kv_tombstones_folded": _TOMBSTONES,
    "report_table_rejects": """
SELECT event_id, CASE WHEN event_id % 20 <> 0 THEN user_id END AS user_id,
       CAST(0 AS BIGINT) AS batch_id,
       CASE WHEN event_id % 20 <> 0 THEN 'stored' ELSE 'rejected' END AS fate
FROM events""",
    "report_table_truncated": """
SELECT CAST(ts AS DATE) AS pt, user_id, event_type, max(event_id) AS event_id,
       arg_max(CAST(value AS DECIMAL(18,2)), event_id) AS "value"
FROM events WHERE hour(ts) >= 12 GROUP BY ALL""",
    "time_floors": """
SELECT event_id, CAST(floor(epoch(ts) / 300) AS BIGINT) * 300 AS tick,
       (epoch_us(ts) - epoch_us(date_trunc('day', ts))) // 1000 AS since_midnight
FROM events""",
    "report_table_upsert": _STORED,
    "report_table_compacted": _STORED,
    "kv_cells": _ROWS + """
SELECT row_key, 'c_name' AS qualifier, c_name AS "value" FROM kv
UNION ALL SELECT row_key, 'c_mktsegment', c_mktsegment FROM kv
UNION ALL SELECT row_key, 'c_nationkey', c_nationkey FROM kv
UNION ALL SELECT row_key, 'c_acctbal', c_acctbal FROM kv""",
    "kv_cells_to_rows": _ROWS + "SELECT * FROM kv",
    "kv_cells_to_maps": _ROWS + """
SELECT row_key, '{"c_acctbal":"' || c_acctbal || '","c_mktsegment":"' || c_mktsegment
       || '","c_name":"' || c_name || '","c_nationkey":"' || c_nationkey || '"}' AS info
FROM kv""",
    "kv_get": _ROWS + "SELECT * FROM kv WHERE row_key = '000000042'",
    "kv_get_many": _ROWS + "SELECT * FROM kv WHERE row_key IN (SELECT row_key FROM urgent)",
    "kv_delete": _ROWS + "SELECT * FROM kv WHERE row_key NOT IN (SELECT row_key FROM urgent)",
    "kv_scan_limit": _ROWS + "SELECT * FROM kv ORDER BY row_key LIMIT 25",
    "kv_count": 'SELECT count(*) AS "rows" FROM customer',
    "kv_put_latest": """
SELECT CAST(o_custkey AS VARCHAR) AS row_key, CAST(o_custkey AS VARCHAR) AS o_custkey,
       CAST(max(o_orderkey) AS VARCHAR) AS o_orderkey,
       arg_max(o_orderpriority, o_orderkey) AS o_orderpriority
FROM orders GROUP BY o_custkey""",
    "blacklist_semi": _WORD_SETS + """
SELECT p_partkey, word FROM words WHERE word IN (SELECT word FROM listed)""",
    "blacklist_anti": _WORD_SETS + """
SELECT p_partkey, word FROM words WHERE word NOT IN (SELECT word FROM listed)""",
    "blacklist_flag": _WORD_SETS + """
SELECT p_partkey, word, word IN (SELECT word FROM listed) AS is_member FROM words""",
    "upsert_last_wins": """
SELECT user_id, event_type, max(event_id) AS event_id,
       arg_max(CAST(value AS DECIMAL(18,2)), event_id) AS "value"
FROM events GROUP BY user_id, event_type""",
    "retention_30d": """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS pt
FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-05-31' AND l_shipdate < TIMESTAMP '1998-07-31'""",
    "camel_names": """
SELECT n_nationkey AS "nNationkey", n_name AS "nName", n_regionkey AS "nRegionkey" FROM nation""",
    "watermark_block_ts": """
SELECT event_id,
       strftime(ts + CASE WHEN event_id % 2 = 0 THEN INTERVAL 0 SECOND ELSE INTERVAL 60 SECOND END,
                '%Y-%m-%d %H:%M:%S') AS at
FROM events""",
    "watermark_list_first": """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events""",
    "watermark_text_field": """
SELECT event_id,
       CASE WHEN event_id % 5 = 0 OR event_id % 7 = 0 THEN 0 ELSE epoch_us(ts) // 1000 END AS at
FROM events""",
}

"""The streaming jobs, run over the driver's tables to their end.

A table is one file stream read in one go, so no row is late and the result is whole. Work
folders come from the session's shared folder; the returned table is read back from them.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from retailtide import schemas
from retailtide.catalog import changes as change_queries
from retailtide.catalog import derive, sales
from retailtide.catalog import logs as log_queries
from retailtide.functions.times import order_time
from retailtide.operators import metrics, parse
from retailtide.plans.logs import device_columns, page_columns, with_day
from retailtide.session import shared_folder, stream_session
from retailtide.sinks.tables import read_table, write_batch
from retailtide.sinks.topics import to_files
from retailtide.sources.topics import order_rows, table_stream, text_stream
from retailtide.streaming import keyed, logs, orders, watermarks
from retailtide.streaming.run import Running, finish, start


def _setting(spark, purpose):
    folder = shared_folder(spark, purpose)
    return stream_session(spark), folder, Running(f"{folder}/checkpoints", {"availableNow": True})


def _orders(session, sf_dir):
    events = table_stream(session, f"{sf_dir}/events.parquet")
    return derive.order_columns(events).withColumn("ts_ms", order_time(F.col("ts")))


def _logs(session, sf_dir):
    events = table_stream(session, f"{sf_dir}/events.parquet")
    return with_day(derive.log_columns(events, F.col("ts").alias("event_time")))


def _report(spark, path):
    report = read_table(spark, orders.gmv_table(spark, f"{path}/report")).drop("update_time")
    return report.select("ds", "window_start", "window_end", "win_gmv", "win_gmv_ids", "top5_product_ids")


def stream_gmv(spark, sf_dir):
    """Every window that the end of the events closes."""
    session, folder, running = _setting(spark, "stream_gmv")
    finish(
        orders.gmv_all_history(_orders(session, sf_dir), folder, running, delay=orders.ORDER_DELAY)
    )
    return _report(spark, folder)


_SPLIT, _HELD_BACK = "2024-01-10 18:00:00", "2024-01-10 12:00:00"


def stream_gmv_late(spark, sf_dir):
    """Windows as they close, when a seventh of a morning's sales arrive in the evening.

    The sales of a day long over come a second time and are dropped.
    """
    session, folder, running = _setting(spark, "stream_gmv_late")
    events = derive.table(spark, sf_dir, "events")
    at = F.col("ts")
    split, noon = (F.lit(t).cast("timestamp_ntz") for t in (_SPLIT, _HELD_BACK))
    late = (F.col("event_id") % 7 == 0) & (at.cast("date") == F.to_date(F.lit(_SPLIT))) & (at < noon)
    source = f"{folder}/in"
    for part in (
        events.filter((at < split) & ~late),
        events.filter((at >= split) | late | (at.cast("date") == F.lit(_LATE_DAY).cast("date"))),
    ):
        part.write.mode("append").parquet(source)
        stream = derive.order_columns(session.readStream.schema(events.schema).parquet(source))
        timed = stream.withColumn("ts_ms", order_time(F.col("ts")))
        finish(orders.gmv_all_history(timed, folder, running, delay=orders.ORDER_DELAY))
    return _report(spark, folder)


def stream_gmv_changed(spark, sf_dir):
    """Every window up to the newest sale, reported as sales arrive."""
    session, folder, running = _setting(spark, "stream_gmv_changed")
    finish(orders.gmv_all_history(_orders(session, sf_dir), folder, running))
    return _report(spark, folder)


def stream_changes_to_gmv(spark, sf_dir):
    """From change records over the order topic to the sales report: two jobs in a row."""
    session, folder, running = _setting(spark, "stream_changes_to_gmv")
    rows = derive.order_columns(table_stream(session, f"{sf_dir}/events.parquet"))
    topic = f"{folder}/topic"
    texts = parse.snapshot_changes(rows, "oms", "dbo", "orders")
    finish(orders.sync_changes(texts, to_files(topic), to_files(f"{folder}/dead"), running))
    sales_rows = order_rows(text_stream(session, topic), schemas.SALE)
    finish(orders.gmv_all_history(sales_rows, folder, running, delay=orders.ORDER_DELAY))
    return _report(spark, folder)


def stream_gmv_today(spark, sf_dir):
    session, folder, running = _setting(spark, "stream_gmv_today")
    finish(
        orders.gmv_since_today(_orders(session, sf_dir), folder, running, as_of=sales.AS_OF)
    )
    return _report(spark, folder)


def stream_pages(spark, sf_dir):
    session, folder, running = _setting(spark, "stream_pages")
    finish(logs.page_stream(_logs(session, sf_dir), folder, running, emit=False))
    return page_columns(logs.page_lists(spark, folder))


def stream_device(spark, sf_dir):
    session, folder, running = _setting(spark, "stream_device")
    finish(logs.device_stream(_logs(session, sf_dir), folder, running, log_queries.AS_OF))
    return read_table(spark, logs.device_table(folder)).drop("update_time")


def stream_device_expiring(spark, sf_dir):
    """The device report from counts that expire two days after their last write."""
    session, folder, running = _setting(spark, "stream_device_expiring")
    session.conf.set(keyed.NO_DATA_BATCHES, "false")
    rows = _logs(session, sf_dir).select("day", *metrics.device_columns())
    table = logs.device_table(folder)

    def each_batch(df, batch_id):
        changed = df.filter("not periodic").select("day", "os", "brand", "platv", "count")
        write_batch(device_columns(changed, log_queries.AS_OF), batch_id, table, unique=True)

    counts = keyed.keyed_counts(rows, ["day", "os", "brand", "platv"])
    finish(start(counts, "device", "update", each_batch, running))
    return read_table(spark, table).drop("update_time")


def stream_pages_timed(spark, sf_dir):
    """The page report as each page's own timer emits it, once a page's first rows are counted."""
    session, folder, running = _setting(spark, "stream_pages_timed")
    session.conf.set(keyed.NO_DATA_BATCHES, "false")
    rows = _logs(session, sf_dir).withColumnRenamed("log_type", "page")
    counts = keyed.keyed_counts(
        rows, ["day", "page"], "user_id", on_change=False, every=timedelta(0), chunks=4
    )
    finish(start(counts, "pages", "update", _to_parquet(f"{folder}/rows"), running))
    emitted = spark.read.parquet(f"{folder}/rows").filter("periodic").groupBy("day", "page").agg(
        F.sum("count").alias("pv"),
        F.sum(F.size("members")).alias("users"),
        F.array_sort(F.flatten(F.collect_list("members"))).alias("user_ids"),
    )
    return page_columns(emitted.withColumns({"chunk": F.lit(0), "chunks": F.lit(1)}))


def stream_staged_logs(spark, sf_dir):
    """Log texts, some of them broken, to a log table and on to the device report."""
    session, folder, running = _setting(spark, "stream_staged_logs")
    texts = change_queries.log_texts(table_stream(session, f"{sf_dir}/events.parquet"))
    finish(logs.stage_logs(texts.select("value"), f"{folder}/rows", running))
    staged = logs.staged_logs(session, f"{folder}/rows")
    finish(logs.device_stream(staged, folder, running, log_queries.AS_OF))
    return read_table(spark, logs.device_table(folder)).drop("update_time")


def stream_log_job(spark, sf_dir):
    """The log job as a whole: one read of the texts, four reports and the dead letters.

    Per report and day the rows it has counted; dead letters have no day.
    """
    session, folder, running = _setting(spark, "stream_log_job")
    events = table_stream(session, f"{sf_dir}/events.parquet")
    stamp = F.unix_millis(F.col("ts").cast("timestamp")).alias("ts")
    rows = derive.log_columns(events, stamp).withColumn("keywords", F.array("log_type"))
    text = F.to_json(F.struct(*rows.columns))
    damaged = F.col("log_id").cast("bigint") % 10 == 0
    texts = rows.select(F.when(damaged, F.concat(F.lit("{"), text)).otherwise(text).alias("value"))
    ranges, dead = derive.ip_ranges(session, sf_dir), f"{folder}/dead"
    finish(*logs.log_job(texts, ranges, folder, running, to_files(dead), log_queries.AS_OF))
    counts = {
        "device": (logs.device_table(folder), "count"),
        "region": (logs.region_table(folder), "count"),
        "search": (logs.word_table(spark, folder), "cnt"),
        "page": (logs.user_table(spark, folder), "views"),
    }
    whole = spark.read.text(dead).select(F.lit("broken").alias("report"), F.lit(None).cast("date").alias("pt"), F.lit(1).alias("n"))
    for name, (table, counted) in counts.items():
        whole = whole.unionByName(read_table(spark, table).select(F.lit(name).alias("report"), "pt", F.col(counted).alias("n")))
    return whole.groupBy("report", "pt").agg(F.sum("n").alias("n"))


def stream_region(spark, sf_dir):
    session, folder, running = _setting(spark, "stream_region")
    ranges = derive.ip_ranges(session, sf_dir)
    finish(
        logs.region_stream(_logs(session, sf_dir), ranges, folder, running, log_queries.AS_OF)
    )
    return read_table(spark, logs.region_table(folder)).drop("update_time")


def stream_search_top10(spark, sf_dir):
    session, folder, running = _setting(spark, "stream_search")
    events = table_stream(session, f"{sf_dir}/events.parquet")
    word = F.concat(F.lit("w"), F.get_json_object("props", "$.k"))
    searches = events.select(
        F.col("ts").alias("event_time"), F.array(F.col("event_type"), word).alias("keywords")
    )
    finish(logs.search_stream(searches, folder, running, keep=None))
    return logs.top_words(spark, folder)


def stream_cdc(spark, sf_dir):
    session, folder, running = _setting(spark, "stream_cdc")
    texts = derive.changes(table_stream(session, f"{sf_dir}/orders.parquet"))
    finish(
        orders.sync_changes(texts, to_files(f"{folder}/topic"), to_files(f"{folder}/dead"), running)
    )
    return spark.read.text(f"{folder}/topic").select("value")


def stream_pages_emitted(spark, sf_dir):
    """The page rows that a batch emits."""
    session, folder, running = _setting(spark, "stream_pages_emitted")
    finish(logs.page_stream(_logs(session, sf_dir), folder, running))
    emitted = read_table(spark, logs.page_table(folder)).filter("emit_time is not null")
    return emitted.select("pt", "page", "pv", "users", "user_ids", "chunk", "chunks")


def stream_search_emitted(spark, sf_dir):
    """The word rows that a batch emits; some records have no words, or none that count."""
    session, folder, running = _setting(spark, "stream_search_emitted")
    events = table_stream(session, f"{sf_dir}/events.parquet")
    word = F.concat(F.lit("w"), F.get_json_object("props", "$.k"))
    words = F.when(F.col("event_id") % 3 == 0, F.array(F.col("event_type"), word, F.lit(None)))
    searches = events.select(
        F.col("ts").alias("event_time"),
        F.when(F.col("event_id") % 5 == 0, F.array().cast("array<string>")).otherwise(words).alias("keywords"),
    )
    finish(logs.search_stream(searches, folder, running))
    emitted = read_table(spark, logs.search_table(spark, folder)).filter("emit_time is not null")
    return emitted.select("pt", "search_item")


def stream_processing_time(spark, sf_dir):
    """Order rows of a stream have the time they were processed at."""
    session, folder, running = _setting(spark, "stream_processing_time")
    texts = parse.as_json(derive.order_columns(table_stream(session, f"{sf_dir}/events.parquet")))
    rows = order_rows(texts).select("id", (F.col("proc_time") > F.col("ts_ms")).alias("later"))
    finish(start(rows, "rows", "append", _to_parquet(f"{folder}/rows"), running))
    return spark.read.parquet(f"{folder}/rows").select("id", "later")


def _to_parquet(path):
    return lambda df, batch_id: df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}") and None


_LATE_DAY = "2024-01-05"


def _days_by_watermark(spark, sf_dir, purpose, records, timed):
    """Events per day as their days close, when those of one day come a second time, too late.

    ``records`` makes a record of its kind of the event's instant, ``timed`` its event time.
    """
    session, folder, running = _setting(spark, purpose)
    events = derive.table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("at"))
    split = F.lit("2024-01-20").cast("timestamp")
    source, counts = f"{folder}/in", {}
    for part in (
        events.filter(F.col("at") < split),
        events.filter((F.col("at") >= split) | (F.col("at").cast("date") == F.lit(_LATE_DAY))),
    ):
        frame = part.select(*records(F.col("at")))
        frame.write.mode("append").parquet(source)
        stream = session.readStream.schema(frame.schema).parquet(source)
        per_day = timed(stream).groupBy(F.window("event_time", "1 day")).agg(F.count(F.lit(1)).alias("events"))
        rows = per_day.select(F.col("window.start").cast("date").alias("day"), "events")
        finish(start(rows, "days", "append", _to_parquet(f"{folder}/days"), running))
    return spark.read.parquet(f"{folder}/days").select("day", "events")


def stream_watermark_text_field(spark, sf_dir):
    record = lambda at: [F.to_json(F.struct(F.unix_millis(at).alias("t"))).alias("value")]
    timed = lambda df: watermarks.by_text_field(df, "t", "5 seconds")
    return _days_by_watermark(spark, sf_dir, "stream_watermark_text_field", record, timed)


def stream_watermark_block_time(spark, sf_dir):
    def record(at):
        seconds = F.unix_seconds(at)
        own = F.when(seconds % 2 == 0, seconds)
        return [own.alias("block_timestamp"), F.when(own.isNull(), seconds).otherwise(1).alias("timestamp")]

    timed = lambda df: watermarks.by_block_time(df, "5 seconds")
    return _days_by_watermark(spark, sf_dir, "stream_watermark_block_time", record, timed)


def stream_watermark_first_item(spark, sf_dir):
    def record(at):
        item = lambda t: F.struct(t.alias("window_start_time"))
        return [F.array(item(F.unix_millis(at)), item(F.lit(1).cast("bigint"))).alias("items")]

    timed = lambda df: watermarks.by_first_item(df, "5 seconds")
    return _days_by_watermark(spark, sf_dir, "stream_watermark_first_item", record, timed)


QUERIES = {
    "stream_gmv_late": stream_gmv_late,
    "stream_pages_emitted": stream_pages_emitted,
    "stream_search_emitted": stream_search_emitted,
    "stream_processing_time": stream_processing_time,
    "stream_watermark_text_field": stream_watermark_text_field,
    "stream_watermark_block_time": stream_watermark_block_time,
    "stream_watermark_first_item": stream_watermark_first_item,
    "stream_gmv": stream_gmv,
    "stream_gmv_changed": stream_gmv_changed,
    "stream_changes_to_gmv": stream_changes_to_gmv,
    "stream_gmv_today": stream_gmv_today,
    "stream_pages": stream_pages,
    "stream_device": stream_device,
    "stream_device_expiring": stream_device_expiring,
    "stream_pages_timed": stream_pages_timed,
    "stream_staged_logs": stream_staged_logs,
    "stream_log_job": stream_log_job,
    "stream_region": stream_region,
    "stream_search_top10": stream_search_top10,
    "stream_cdc": stream_cdc,
}

# windows that the newest event less five seconds has passed
_CLOSED = "WHERE {a}.window_end <= (SELECT max(ts) FROM events) - INTERVAL 5 SECOND"

# the sales held back, and the windows that were closed without them
_LATE = f"event_id % 7 = 0 AND CAST(ts AS DATE) = DATE '{_SPLIT[:10]}' AND ts < TIMESTAMP '{_HELD_BACK}'"
_ALL_LATE = (
    sales.ORDER_BY_ARRIVAL.replace("{late}", _LATE).replace(
        "{open}",
        f"window_end > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '{_SPLIT}') - INTERVAL 5 SECOND",
    )
)

# days that the newest event less five seconds has closed; the repeated day was closed before
_DAYS = """
SELECT CAST(ts AS DATE) AS day, count(*) AS events FROM events
GROUP BY 1 HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 5 SECOND"""

ORACLE = {
    "stream_log_job": """
SELECT report, CAST(ts AS DATE) AS pt, count(*) AS n
FROM events, (VALUES ('device'), ('region'), ('search'), ('page')) AS reports(report)
WHERE event_id % 10 <> 0 GROUP BY ALL
UNION ALL SELECT 'broken', NULL, count(*) FROM events WHERE event_id % 10 = 0""",
    "stream_pages_emitted": log_queries.ORACLE["page_view_users"],
    "stream_search_emitted": """WITH searches AS (
    SELECT CAST(ts AS DATE) AS pt,
           unnest([event_type, 'w' || json_extract_string(props, '$.k')]) AS keyword
    FROM events WHERE event_id % 3 = 0 AND event_id % 5 <> 0
)
SELECT pt, '[{"word":"' || keyword || '","cnt":' || count(*) || '}]' AS search_item
FROM searches GROUP BY pt, keyword""",
    "stream_processing_time": "SELECT event_id AS id, true AS later FROM events",
    "stream_watermark_text_field": _DAYS,
    "stream_watermark_block_time": _DAYS,
    "stream_watermark_first_item": _DAYS,
    "stream_gmv_late": _ALL_LATE + "\n" + _CLOSED.format(a="t"),
    "stream_gmv": sales.ORACLE["gmv_cumulate_all"] + "\n" + _CLOSED.format(a="t"),
    "stream_gmv_changed": sales.ORACLE["gmv_cumulate_all"]
    + """
WHERE t.window_end <= (SELECT max(time_bucket(INTERVAL 10 MINUTE, ts)) FROM events)
                      + INTERVAL 10 MINUTE""",
    "stream_changes_to_gmv": sales.ORACLE["gmv_cumulate_all"] + "\n" + _CLOSED.format(a="t"),
    "stream_gmv_today": sales.ORACLE["gmv_cumulate_today_top5"] + "\n" + _CLOSED.format(a="r"),
    "stream_pages": log_queries.ORACLE["page_view_users"],
    "stream_device": log_queries.ORACLE["device_stats"],
    "stream_device_expiring": log_queries.ORACLE["device_stats"],
    "stream_pages_timed": log_queries.ORACLE["page_view_users"],
    "stream_staged_logs": log_queries.DEVICE.replace(
        "FROM logs GROUP", "FROM logs WHERE event_id % 10 <> 0 GROUP"
    )
    + "\nSELECT * FROM report",
    "stream_region": log_queries.ORACLE["region_heat_merged"],
    "stream_search_top10": """WITH searches AS (
    SELECT CAST(ts AS DATE) AS pt,
           unnest([event_type, 'w' || json_extract_string(props, '$.k')]) AS keyword
    FROM events
),
counts AS (SELECT pt, keyword, count(*) AS cnt FROM searches GROUP BY ALL),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY pt ORDER BY cnt DESC, keyword) AS rn FROM counts
)
SELECT pt,
       '[' || string_agg('{"word":"' || keyword || '","cnt":' || cnt || '}', ',' ORDER BY rn) || ']'
           AS search_item
FROM ranked WHERE rn <= 10 GROUP BY pt""",
    "stream_cdc": change_queries.ORACLE["cdc_topic_text"],
}

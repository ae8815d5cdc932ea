"""Streams over several files equal the batch result; restarts and late rows change nothing else."""

import json
import random
import time
from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from retailtide import schemas
from retailtide.functions.times import order_time
from retailtide.operators import parse
from retailtide.plans import gmv
from retailtide.plans import logs as reports
from retailtide.session import shared_folder, stream_session
from retailtide.sinks.tables import read_batches, read_table
from retailtide.sinks.topics import to_files
from retailtide.sources.topics import log_rows, order_rows, text_stream
from retailtide.streaming import logs, orders, watermarks, windows
from retailtide.streaming.run import LateRows, Running, finish, start

ORDER_SCHEMA = "id long, product_id string, total_amount string, ts long"
START = datetime(2024, 3, 1)


@pytest.fixture
def session(spark):
    return stream_session(spark)


def sales(n=400, seed=5):
    """Two days of sales in time order, a third of them of one product."""
    rng = random.Random(seed)
    at = sorted(rng.randrange(2 * 86_400) for _ in range(n))
    epoch = 1709251200  # 2024-03-01 00:00 UTC
    return [
        (i, "p0" if rng.random() < 1 / 3 else f"p{rng.randrange(8)}", f"{rng.randrange(1, 9999) / 100:.2f}", epoch + t)
        for i, t in enumerate(at)
    ]


def put_file(spark, folder, rows):
    spark.createDataFrame(rows, ORDER_SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def order_stream(session, folder):
    stream = session.readStream.schema(ORDER_SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))
    return stream.withColumn("ts_ms", order_time(F.col("ts")))


def batch_report(spark, rows, **more):
    frame = spark.createDataFrame(rows, ORDER_SCHEMA).withColumn("ts_ms", order_time(F.col("ts")))
    columns = ["window_start", "window_end", "win_gmv", "win_gmv_ids", "top5_product_ids"]
    return {r[1]: r for r in map(tuple, gmv.gmv_all(frame, **more).select(columns).collect())}


def stream_report(spark, folder):
    table = orders.gmv_table(spark, f"{folder}/report")
    columns = ["window_start", "window_end", "win_gmv", "win_gmv_ids", "top5_product_ids"]
    return {r[1]: r for r in map(tuple, read_table(spark, table).select(columns).collect())}


def last_closed(rows, delay=5):
    """The latest end of a window that the newest sale has closed."""
    return str(START + timedelta(seconds=max(r[3] for r in rows) - 1709251200 - delay))


def once(folder):
    return Running(f"{folder}/checkpoints", {"availableNow": True})


def test_windows_are_reported_once_as_they_close(spark, session, tmp_path):
    rows = sales()
    source, out = tmp_path / "in", str(tmp_path / "out")
    for part in range(4):
        put_file(spark, source, rows[part * 100 : part * 100 + 100])
        # a restart from the checkpoint after every file
        finish(orders.gmv_all_history(order_stream(session, source), out, once(out), delay=orders.ORDER_DELAY))
    got, want = stream_report(spark, out), batch_report(spark, rows)
    assert got == {e: r for e, r in want.items() if e <= last_closed(rows)}
    written = read_batches(spark, orders.gmv_table(spark, f"{out}/report"))
    assert written.count() == len(got)
    assert written.select("batch_id").distinct().count() > 3


def test_late_sale_is_dropped_and_counted(spark, session, tmp_path):
    rows = sales(200)
    source, out = tmp_path / "in", str(tmp_path / "out")
    put_file(spark, source, rows)
    finish(orders.gmv_all_history(order_stream(session, source), out, once(out), delay=orders.ORDER_DELAY))
    late = (999, "late", "1000.00", rows[10][3])
    put_file(spark, source, [late, (1000, "p1", "1.00", rows[-1][3] + 86_400)])
    assert orders.late_sales(spark, out) == 0
    finish(orders.gmv_all_history(order_stream(session, source), out, once(out), delay=orders.ORDER_DELAY))
    assert orders.late_sales(spark, out) == 1
    assert not any("late" in (r[3] or "") for r in stream_report(spark, out).values())


def test_a_late_sale_counts_in_every_window_still_open(spark, session, tmp_path):
    """A sale of 00:09:59 comes when the first window is out: the later ones have it, the first stays."""
    epoch = 1709251200
    source, out = tmp_path / "in", str(tmp_path / "out")
    parts = [
        [(0, "a", "1.00", epoch + 60), (1, "b", "2.00", epoch + 700)],
        [(2, "c", "100.00", epoch + 599), (3, None, None, epoch + 300)],
        [(4, "a", "4.00", epoch + 86_400 + 700)],
    ]
    for part in parts:
        put_file(spark, source, part)
        finish(orders.gmv_all_history(order_stream(session, source), out, once(out), delay=orders.ORDER_DELAY))
    got = stream_report(spark, out)
    first = got.pop("2024-03-01 00:10:00")
    assert [str(x) for x in first[2:]] == ["1.00", "a", "a"]
    next_day = {e for e in got if e > "2024-03-02 00:00:00"}
    assert len(got) == 143 and not next_day
    assert {tuple(map(str, r[2:])) for r in got.values()} == {("103.00", "a,b,c", "c,b,a")}
    assert orders.late_sales(spark, out) == 0


def test_late_sales_of_a_day_that_is_out_are_counted_one_by_one(spark, session, tmp_path):
    epoch = 1709251200
    source, out = tmp_path / "in", str(tmp_path / "out")
    for part in (
        [(0, "a", "1.00", epoch + 60), (1, "b", "2.00", epoch + 86_400 + 700)],
        [(2, "a", "5.00", epoch + 60)] * 3 + [(3, "z", "6.00", epoch + 61), (4, "b", "1.00", epoch + 86_400 + 3000)],
        [(5, "b", "1.00", epoch + 3 * 86_400)],
    ):
        put_file(spark, source, part)
        finish(orders.gmv_all_history(order_stream(session, source), out, once(out), delay=orders.ORDER_DELAY))
    got = stream_report(spark, out)
    assert {str(r[2]) for e, r in got.items() if e <= "2024-03-02 00:00:00"} == {"1.00"}
    assert orders.late_sales(spark, out) == 4


def test_windows_of_shards_and_without_lists(spark, session, tmp_path):
    """Parts of the products come together, whatever their number; without ids there is no list."""
    rows = sales(150, 8)
    source = tmp_path / "in"
    put_file(spark, source, rows)
    want = {e: r for e, r in batch_report(spark, rows).items() if e <= last_closed(rows)}
    for parts, with_ids in ((1, True), (7, False)):
        out = str(tmp_path / f"out{parts}")
        stream = windows.closed_windows(order_stream(session, source), timedelta(seconds=5), parts=parts, with_ids=with_ids)
        write = lambda df, _: windows.all_products_report(df).write.mode("append").parquet(f"{out}/rows")  # noqa: B023, E731
        finish(start(stream, "rows", "append", write, once(out)))
        columns = ["window_start", "window_end", "win_gmv", "win_gmv_ids", "top5_product_ids"]
        got = {r[1]: r for r in map(tuple, spark.read.parquet(f"{out}/rows").select(columns).collect())}
        assert got == {e: r if with_ids else (*r[:3], None, r[4]) for e, r in want.items()}


def test_windows_close_without_sales_in_their_slots(spark, session, tmp_path):
    """Sales at 00:05 and 00:45:30 close four windows, the next day's first sale all the others."""
    epoch = 1709251200
    rows = [(0, "a", "1.00", epoch + 300), (1, "b", "2.00", epoch + 45 * 60 + 30)]
    source, out = tmp_path / "in", str(tmp_path / "out")
    put_file(spark, source, rows)
    finish(orders.gmv_all_history(order_stream(session, source), out, once(out), delay=orders.ORDER_DELAY))
    ends = sorted(stream_report(spark, out))
    assert ends == [f"2024-03-01 00:{m}0:00" for m in (1, 2, 3, 4)]
    rows.append((2, "c", "4.00", epoch + 86_400 + 20 * 60 + 4))
    put_file(spark, source, rows[2:])
    finish(orders.gmv_all_history(order_stream(session, source), out, once(out), delay=orders.ORDER_DELAY))
    want = batch_report(spark, rows)
    assert stream_report(spark, out) == {e: r for e, r in want.items() if e <= last_closed(rows)}
    assert len(stream_report(spark, out)) == 144


def test_a_batch_lists_only_the_days_it_reports(spark, session, tmp_path):
    rows = sales(200)
    source, out = tmp_path / "in", str(tmp_path / "out")
    put_file(spark, source, rows)
    finish(orders.gmv_all_history(order_stream(session, source), out, once(out)))
    from retailtide.sinks.tables import read_days

    table = orders.slot_table(spark, f"{out}/slots")
    second = read_days(spark, table, [datetime(2024, 3, 2).date(), datetime(2031, 1, 1).date()])
    assert {f.split("/pt=")[1][:10] for f in second.inputFiles()} == {"2024-03-02"}
    assert read_days(spark, table, [datetime(2031, 1, 1).date()]).count() == 0


def test_partitions_days_apart_lose_nothing(spark, session, tmp_path):
    rows = sales(120, 3)
    source, out = tmp_path / "in", str(tmp_path / "out")
    for part in (rows[60:], rows[:60]):
        put_file(spark, source, part)
    finish(orders.gmv_all_history(order_stream(session, source), out, once(out)))
    newest = START + timedelta(seconds=(rows[-1][3] - 1709251200) // 600 * 600 + 600)
    want = {e: r for e, r in batch_report(spark, rows).items() if e <= str(newest)}
    assert stream_report(spark, out) == want


def test_no_sale_is_late_when_windows_follow_changes(spark, session, tmp_path):
    """Batches in any order of time give the batch report, up to the newest sale."""
    rows = sales(300, 12)
    source, out = tmp_path / "in", str(tmp_path / "out")
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    for part in (rows[100:150], shuffled[:120], rows[:1], shuffled[120:]):
        put_file(spark, source, part)
        finish(orders.gmv_all_history(order_stream(session, source), out, once(out)))
    seen = rows[100:150] + shuffled + rows[:1]
    newest = START + timedelta(seconds=(max(r[3] for r in seen) - 1709251200) // 600 * 600 + 600)
    want = {e: r for e, r in batch_report(spark, seen).items() if e <= str(newest)}
    assert stream_report(spark, out) == want


def test_replayed_batch_changes_nothing(spark, session, tmp_path):
    """A batch whose tables were written but whose commit was lost runs again."""
    rows = sales(200)
    source, out = tmp_path / "in", str(tmp_path / "out")
    put_file(spark, source, rows[:100])
    finish(orders.gmv_all_history(order_stream(session, source), out, once(out)))
    put_file(spark, source, rows[100:])
    finish(orders.gmv_all_history(order_stream(session, source), out, once(out)))
    before = stream_report(spark, out)
    commits = tmp_path / "out" / "checkpoints" / "gmv_all" / "commits"
    newest = max((p for p in commits.iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    newest.unlink()
    newest.with_name(f".{newest.name}.crc").unlink()
    finish(orders.gmv_all_history(order_stream(session, source), out, once(out)))
    assert stream_report(spark, out) == before


def test_today_only(spark, session, tmp_path):
    rows = sales()
    source, out = tmp_path / "in", str(tmp_path / "out")
    put_file(spark, source, rows)
    finish(orders.gmv_since_today(order_stream(session, source), out, once(out), as_of="2024-03-02"))
    frame = spark.createDataFrame(rows, ORDER_SCHEMA).withColumn("ts_ms", order_time(F.col("ts")))
    want = {r.window_end: r for r in gmv.gmv_today_top(frame, "2024-03-02").collect()}
    got = stream_report(spark, out)
    assert set(got) == {e for e in want if e <= last_closed(rows)}
    assert all(r[2] == want[e].win_gmv and r[4] == want[e].top5_product_ids for e, r in got.items())


def test_slots_of_a_zone_off_the_step(spark, tmp_path):
    session = stream_session(spark)
    session.conf.set("spark.sql.session.timeZone", "Asia/Kathmandu")
    rows = sales(150, 8)
    source, out = tmp_path / "in", str(tmp_path / "out")
    put_file(spark, source, rows)
    finish(orders.gmv_all_history(order_stream(session, source), out, once(out)))
    got = stream_report(session, out)
    want = batch_report(session, rows)
    assert len(got) > 50 and all(want[e] == r for e, r in got.items())


def change_texts():
    good = [
        json.dumps({"after": {"id": i, "order_id": f"o{i}"}, "source": {"db": "d", "schema": "s", "table": "t"}, "op": "c"})
        for i in range(20)
    ]
    deletes = [json.dumps({"after": None, "source": {}, "op": "d"})] * 3
    return good, deletes, ["{broken", "[]", '{"after":1} tail']


def test_change_sync(spark, session, tmp_path):
    good, deletes, broken = change_texts()
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for n, lines in enumerate([good[:10] + broken[:1], good[10:] + deletes + broken[1:]]):
        (source / f"{n}.txt").write_text("\n".join(lines))
        finish(
            orders.sync_changes(
                text_stream(session, str(source)), to_files(f"{out}/topic"), to_files(f"{out}/dead"), once(out)
            )
        )
    topic = [json.loads(r.value) for r in spark.read.text(f"{out}/topic").collect()]
    assert sorted(int(t["id"]) for t in topic) == list(range(20))
    assert {t["table_name"] for t in topic} == {"d.s.t"}
    assert sorted(r.value for r in spark.read.text(f"{out}/dead").collect()) == sorted(broken)
    # the order topic is what the sales reports read
    assert order_rows(spark.read.text(f"{out}/topic")).count() == 20
    narrow = order_rows(spark.read.text(f"{out}/topic"), schemas.SALE)
    assert narrow.columns == ["product_id", "total_amount", "ts", "ts_ms", "proc_time"]


def log_texts(n=300, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        record = {
            "log_id": str(i),
            "device": {"plat": rng.choice(["iOS", "Android"]), "brand": rng.choice(["A", "B"])},
            "gis": {"ip": f"10.{rng.randrange(3)}.{rng.randrange(9)}.1"},
            "log_type": "hot" if rng.random() < 0.5 else rng.choice(["home", "cart"]),
            "ts": 1709251200 + 360 * i,
            "user_id": rng.choice(["", *[f"u{rng.randrange(40)}"] * 5]),
        }
        if i % 3 == 0:
            record["keywords"] = [f"w{rng.randrange(15):02d}", "all"]
        rows.append(json.dumps(record))
    return rows


def test_log_job_equals_batch(spark, session, tmp_path):
    texts = log_texts()
    broken = ["{broken", json.dumps({"log_type": "x"})]
    ranges = spark.createDataFrame(
        [(10 * 2**24, 10 * 2**24 + 65_535, "C|P|Q|R"), (10 * 2**24 + 65_536, 10 * 2**24 + 131_071, "C|0|Q|R")],
        "ip_lo long, ip_hi long, region string",
    )
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for n, lines in enumerate([texts[:100] + broken[:1], texts[100:200], texts[200:] + broken[1:]]):
        (source / f"{n}.txt").write_text("\n".join(lines))
        stream = text_stream(session, str(source))
        queries = logs.log_job(stream, ranges, out, once(out), to_files(f"{out}/dead"), "2024-03-02")
        finish(*queries)
        read = [q.lastProgress["sources"][0]["description"] for q in queries if q.lastProgress]
        assert sum(str(source) in d for d in read) == 1

    rows = reports.with_day(log_rows(spark.createDataFrame([(t,) for t in texts], "value string")))

    def same(got, want):
        got = got.select(want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))

    same(read_table(spark, logs.device_table(out)), reports.device_report(rows, "2024-03-02"))
    same(read_table(spark, logs.region_table(out)), reports.region_label_report(rows, ranges, "2024-03-02"))
    same(reports.page_columns(logs.page_lists(spark, out)), reports.page_report(rows))
    same(logs.top_words(spark, out), reports.search_top_report(rows))
    assert sorted(r.value for r in spark.read.text(f"{out}/dead").collect()) == sorted(broken)

    # the append tables hold what each batch emitted; their newest rows are the present state
    pages = read_batches(spark, logs.page_table(out))
    newest = pages.groupBy("pt", "page").agg(F.max_by("pv", "batch_id").alias("pv"))
    same(newest, reports.page_report(rows).select("pt", "page", "pv"))
    assert pages.count() > newest.count() and "emit_time" in pages.columns
    searches = read_batches(spark, logs.search_table(spark, out))
    want = reports.search_word_report(rows)
    assert {(r.pt, r.search_item) for r in want.collect()} <= {(r.pt, r.search_item) for r in searches.collect()}


def test_staged_logs_give_the_same_reports(spark, session, tmp_path):
    texts = log_texts(120)
    ranges = spark.createDataFrame([(10 * 2**24, 10 * 2**24 + 65_535, "C|P|Q|R")], "ip_lo long, ip_hi long, region string")
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    for n, lines in enumerate([texts[:50], [*texts[50:], "{broken"]]):
        (source / f"{n}.txt").write_text("\n".join(lines))
        finish(logs.stage_logs(text_stream(session, str(source)), f"{out}/rows", once(out)))
        staged = logs.staged_logs(session, f"{out}/rows")
        finish(logs.staged_dead_letters(session, f"{out}/rows", to_files(f"{out}/dead"), once(out)))
        finish(*logs.log_reports(staged, ranges, out, once(out), "2024-03-01"))
    assert [r.value for r in spark.read.text(f"{out}/dead").collect()] == ["{broken"]
    rows = reports.with_day(log_rows(spark.createDataFrame([(t,) for t in texts], "value string")))
    for table, want in (
        (logs.device_table(out), reports.device_report(rows, "2024-03-01")),
        (logs.region_table(out), reports.region_label_report(rows, ranges, "2024-03-01")),
    ):
        got = read_table(spark, table).select(want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    want = reports.page_report(rows)
    got = reports.page_columns(logs.page_lists(spark, out)).select(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_region_stream_with_a_large_range_table(spark, session, tmp_path):
    texts = log_texts(60)
    ranges = spark.createDataFrame([(10 * 2**24, 10 * 2**24 + 65_535, "C|P|Q|R")], "ip_lo long, ip_hi long, region string")
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "0.txt").write_text("\n".join(texts))
    stream = log_rows(text_stream(session, str(source)))
    finish(logs.region_stream(stream, ranges, out, once(out), "2024-03-01", limit=0))
    got = read_table(spark, logs.region_table(out)).drop("update_time")
    rows = reports.with_day(log_rows(spark.createDataFrame([(t,) for t in texts], "value string")))
    want = reports.region_label_report(rows, ranges, "2024-03-01")
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_page_lists_are_spread_over_the_files_of_large_tables(spark, session, tmp_path, monkeypatch):
    files = {}
    write = logs.write_batch

    def seen(df, batch_id, table, **how):
        files[table.path.rpartition("/")[2]] = table.files
        write(df, batch_id, table, **how)

    monkeypatch.setattr(logs, "write_batch", seen)
    monkeypatch.setattr(logs, "day_files", lambda spark: 7)
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "0.txt").write_text("\n".join(log_texts(40)))
    finish(logs.page_stream(log_rows(text_stream(session, str(source))), out, once(out)))
    assert files == {"page_users": 7, "page": 7}


def test_counts_of_old_days_expire(spark, session, tmp_path):
    """With ``keep``, a day's counts end once a day that much later has been seen."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()

    def record(day, user):
        at = 1709251200 + (day - 1) * 86_400 + 43_200
        return json.dumps({"device": {}, "gis": {"ip": "1.1.1.1"}, "log_type": "p", "ts": at, "user_id": user})

    for n, lines in enumerate([[record(1, "a")], [record(9, "a")], [record(1, "b"), record(8, "b")]]):
        (source / f"{n}.txt").write_text("\n".join(lines))
        stream = log_rows(text_stream(session, str(source)))
        finish(logs.page_stream(stream, out, once(out), keep="2 days", emit=False))
    got = {(r.day.day, r.pv, tuple(r.user_ids)) for r in logs.page_lists(spark, out).collect()}
    assert got == {(1, 1, ("a",)), (8, 1, ("b",)), (9, 1, ("a",))}


@pytest.mark.parametrize("kind", ["text", "block", "items"])
def test_watermarks_drop_late_rows(spark, session, tmp_path, kind):
    """The event time of each record kind drives the watermark of a stream."""
    make = {
        "text": lambda s: json.dumps({"t": s * 1000}),
        "block": lambda s: json.dumps({"timestamp": s} if s % 2 else {"block_timestamp": s, "timestamp": 1}),
        "items": lambda s: json.dumps({"items": [{"window_start_time": s * 1000}, {"window_start_time": 1}]}),
    }[kind]
    schema = "block_timestamp long, timestamp long, items array<struct<window_start_time:long>>"
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    got, late = [], LateRows()
    session.streams.addListener(late)
    for n, seconds in enumerate([[100, 101], [1000], [150, 995, 1301]]):
        (source / f"{n}.txt").write_text("\n".join(map(make, seconds)))
        texts = text_stream(session, str(source))
        if kind == "text":
            timed = watermarks.by_text_field(texts, "t", "10 seconds")
        else:
            fields = texts.select(F.from_json("value", schema).alias("r")).select("r.*")
            timed = {"block": watermarks.by_block_time, "items": watermarks.by_first_item}[kind](fields, "10 seconds")
        counts = timed.groupBy(F.window("event_time", "60 seconds")).count()
        query = start(
            counts.select(F.unix_seconds("window.start").alias("s"), "count"),
            kind,
            "append",
            lambda df, _: got.extend(map(tuple, df.collect())),
            once(out),
        )
        finish(query)
    deadline = time.time() + 20
    while not late.by_query.get(kind) and time.time() < deadline:
        time.sleep(0.1)  # the listener hears of the last batch a moment later
    session.streams.removeListener(late)
    assert late.by_query[kind] == 1
    assert sorted(got) == [(60, 2), (960, 2)]


def cluster(master, setting=None):
    """What ``shared_folder`` asks of a session."""
    conf = SimpleNamespace(get=lambda key, default=None: setting or default)
    context = SimpleNamespace(master=master, getConf=lambda: conf)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_shared_folder():
    assert shared_folder(cluster("yarn", "hdfs:/w/"), "x").startswith("hdfs:/w/x-")
    assert "retailtide-" in shared_folder(cluster("local[4]"), "x")
    with pytest.raises(ValueError):
        shared_folder(cluster("yarn"), "x")


def test_stream_records_equal_batch_records(spark, session, tmp_path):
    texts = [json.dumps({"id": i, "ts": 1709251200 + i, "total_amount": str(i), "product_id": "p"}) for i in range(9)]
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    (source / "0.txt").write_text("\n".join([*texts, "broken"]))
    stream = order_rows(text_stream(session, str(source)))
    finish(start(parse.as_json(stream.drop("proc_time")), "orders", "append", to_files(str(out)), once(tmp_path)))
    want = parse.as_json(order_rows(spark.read.text(str(source))).drop("proc_time"))
    assert sorted(r.value for r in spark.read.text(str(out)).collect()) == sorted(r.value for r in want.collect())


def test_a_page_tick_lists_only_the_days_it_changes(spark, tmp_path):
    folder = str(tmp_path / "out")
    rows = spark.range(40).select(
        F.date_add(F.lit("2024-03-01").cast("date"), (F.col("id") % 4).cast("int")).alias("pt"),
        F.lit("home").alias("page"),
        F.col("id").cast("string").alias("user_id"),
        F.lit(1).cast("bigint").alias("views"),
    )
    from retailtide.sinks.tables import write_batch

    write_batch(rows, 0, logs.user_table(spark, folder), unique=True)
    days = [datetime(2024, 3, 2).date()]
    lists = logs.page_lists(spark, folder, rows.filter("pt = '2024-03-02'").select("pt", "page").distinct(), days)
    assert {f.split("/pt=")[1][:10] for f in lists.inputFiles()} == {"2024-03-02"}
    assert [(r.pv, r.users, len(r.user_ids)) for r in lists.collect()] == [(10, 10, 10)]

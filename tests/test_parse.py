"""Texts of every kind: what is a record, what is a dead letter, what each field becomes."""

import json

import pytest
from pyspark.sql import functions as F

from retailtide import schemas
from retailtide.functions import texts, times
from retailtide.operators import parse
from retailtide.sources.topics import broken_logs, log_rows, order_rows

GOOD = {
    "log_id": "a1",
    "device": {"brand": "Apple", "plat": "iOS", "platv": "17.1"},
    "gis": {"ip": "10.1.2.3"},
    "log_type": "home",
    "ts": 1761878400,
    "user_id": "u1",
}


def texts_frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def without(*names, **changes):
    return json.dumps({k: v for k, v in {**GOOD, **changes}.items() if k not in names})


BROKEN = ["", "  ", "bad", "null", "[1]", "5", '"x"', '{"a":1} tail', '{"a":1}{"a":2}', '{"a":1},{"a":2}', '{"a":"x",}']


@pytest.mark.parametrize("text", BROKEN)
def test_not_an_object(spark, text):
    row = parse.with_record(texts_frame(spark, [text]), schemas.LOG).first()
    assert row.record is None and row.value == text


def test_objects(spark):
    values = ["{}", ' {"ts": 1} ', "{ts: 1}", "{'ts': '1'}"]
    rows = parse.with_record(texts_frame(spark, values), schemas.LOG).collect()
    assert [r.record.ts for r in rows] == [None, "1", "1", "1"]


def test_nothing_is_lost_between_records_and_dead_letters(spark):
    values = BROKEN + [json.dumps(GOOD)] * 3
    frame = parse.with_record(texts_frame(spark, values), schemas.LOG)
    assert parse.parsed(frame).count() == 3
    assert sorted(r.value for r in parse.dead_letters(frame).collect()) == sorted(BROKEN)


def test_log_rows_and_broken_logs_split_the_topic(spark):
    incomplete = [
        without("log_type"),
        without("gis"),
        without("device"),
        without("ts"),
        without(gis={}),
        without(ts=123456789),
        without(ts=12345678901),
        without(ts="soon"),
    ]
    complete = [
        json.dumps(GOOD),
        without(ts=1761878400123),
        without(ts="1761878400"),
        without("user_id"),
    ]
    frame = texts_frame(spark, complete + incomplete + BROKEN)
    rows = log_rows(frame).collect()
    assert len(rows) == 4
    assert {r.event_time.strftime("%Y%m%d") for r in rows} == {"20251031"}
    assert sorted(r.value for r in broken_logs(frame).collect()) == sorted(incomplete + BROKEN)


def test_keywords(spark):
    values = [
        without(keywords=["b", "a", "b"]),
        without(keywords=["x|y", 7, None]),
        without(keywords=[]),
        without(keywords="a"),
        without(keywords={"a": 1}),
        without(),
    ]
    words = parse.keyword_rows(log_rows(texts_frame(spark, values)))
    assert sorted(r.keyword for r in words.collect()) == ["7", "a", "b", "b", "x|y"]


def test_change_records(spark):
    after = {"id": 1, "order_id": "o1", "total_amount": "3.50"}
    values = [
        json.dumps({"after": after, "source": {"db": "d", "schema": "s", "table": "t"}, "op": "c"}),
        json.dumps({"after": after, "source": {"db": "d", "table": "t"}}),
        json.dumps({"after": after}),
        json.dumps({"after": None, "source": {}, "op": "d"}),
        json.dumps({"source": {}, "op": "d"}),
    ]
    flat = parse.flatten_changes(parse.parsed(parse.order_changes(texts_frame(spark, values))))
    got = [(r.id, r.total_amount, r.table_name, r.op) for r in flat.collect()]
    assert got == [("1", "3.50", "d.s.t", "c"), ("1", "3.50", "d..t", ""), ("1", "3.50", "..", "")]


def test_the_whole_after_image_is_carried(spark):
    images = [
        '{"extra":{"a":[1,null]},"id":98765432109876543210,"none":null,"price":12345678901234567.891}',
        "{}",
        '{"op":"own","x":1,"none":null}',
    ]
    values = ['{"after":%s,"source":{"db":"d","schema":"s","table":"t"},"op":"u"}' % i for i in images]
    values += ['{"after":"text","op":"c"}', '{"after":null,"op":"d"}']
    got = parse.change_texts(parse.parsed(parse.order_changes(texts_frame(spark, values)))).collect()
    added = {"table_name": "d.s.t", "op": "u"}
    assert [json.loads(r.value) for r in got] == [{**json.loads(i), **added} for i in images]
    assert got[0].value.startswith(images[0][:-1])


@pytest.mark.parametrize(
    "text, good",
    [
        ('{"op":"c","after":{"id":9}}] junk }', False),
        ('{"op":"c"}],[{"op":"c"}', False),
        ('{"op":"c","list":[{"a":1} ]}', True),
        ('{"op":"c","text":"}] x"}', True),
    ],
)
def test_text_after_an_object_that_closes_the_list(spark, text, good):
    row = parse.order_changes(texts_frame(spark, [text])).first()
    assert (row.record is not None) == good


def test_order_rows(spark):
    values = [
        json.dumps({"id": 1, "ts": 1761878400, "total_amount": "12.345", "product_id": " p\\n"}),
        json.dumps({"id": "2", "ts": 1761878400999, "total_amount": "n/a", "product_id": "p\n"}),
        json.dumps({"id": "x", "total_amount": 5}),
        "broken",
    ]
    rows = order_rows(texts_frame(spark, values)).select(
        "id",
        F.unix_millis("ts_ms").alias("at"),
        texts.money(F.col("total_amount")).cast("string").alias("amount"),
        texts.clean_product_id(F.col("product_id")).alias("product"),
    )
    assert [tuple(r) for r in rows.collect()] == [
        (1, 1761878400000, "12.35", "p"),
        (2, 1761878400999, None, "p"),
        (None, None, "5.00", None),
    ]


def test_record_is_parsed_once(spark):
    frame = log_rows(texts_frame(spark, [json.dumps(GOOD)]))
    plan = frame.select("log_type", "gis.ip", "device.plat")._jdf.queryExecution().optimizedPlan().toString()
    # the other one only looks at texts that may hide something after a closed list
    assert plan.count("from_json") == 2 and plan.count("RLIKE") == 1


def test_time_rules(spark):
    epochs = [1761878400, 1761878400123, 123456789, 12345678901, 99_999_999_999, 100_000_000_000, None]
    frame = spark.createDataFrame([(e,) for e in epochs], "ts long")
    got = frame.select(
        F.unix_millis(times.log_time(F.col("ts"))).alias("log"),
        F.unix_millis(times.order_time(F.col("ts"))).alias("order"),
    ).collect()
    assert [r.log for r in got] == [1761878400000, 1761878400123, None, None, None, None, None]
    assert [r.order for r in got] == [
        1761878400000,
        1761878400123,
        123456789000,
        12345678901000,
        99_999_999_999_000,
        100_000_000_000,
        None,
    ]


def test_day_follows_the_session_zone(shanghai):
    frame = shanghai.createDataFrame([(1761926400,)], "ts long")  # 2025-10-31 16:00 UTC
    assert frame.select(times.day_text(times.log_time(F.col("ts")))).first()[0] == "20251101"


def test_small_time_functions(spark):
    row = spark.range(1).select(
        times.floor_to_step(F.lit(1761878699)).alias("tick"),
        times.pt_of_day_text(F.lit("20251031")).cast("string").alias("pt"),
        times.start_of_day_millis("2024-03-15").alias("midnight"),
        times.second_text(times.start_of_day("2024-03-15")).alias("text"),
    ).first()
    assert tuple(row) == (1761878400, "2025-10-31", 1710460800000, "2024-03-15 00:00:00")


@pytest.mark.parametrize(
    "name, want",
    [("ORDER_ID", "orderId"), ("order_id", "orderId"), ("ID", "id"), ("A_B_C", "aBC")],
)
def test_camel(name, want):
    assert texts.camel(name) == want

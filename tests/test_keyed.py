"""Keyed counts that expire by their last write, and timers of their own."""

import time
from datetime import timedelta

import pytest

from retailtide.session import stream_session
from retailtide.streaming import keyed
from retailtide.streaming.run import Running, start

SCHEMA = "day string, page string, user_id string"


@pytest.fixture
def session(spark):
    session = stream_session(spark)
    session.conf.set("spark.sql.shuffle.partitions", "2")
    session.conf.set(keyed.NO_DATA_BATCHES, "false")
    return session


def run(spark, session, folder, rows, **more):
    """Rows that one run emits, and how many rows its state has."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = session.readStream.schema(SCHEMA).parquet(f"{folder}/in")
    counts = keyed.keyed_counts(stream, ["day", "page"], "user_id", chunks=1, **more)
    emitted = []

    def each_batch(df, batch_id):
        emitted.extend(tuple(r) for r in df.drop("chunk").collect())

    query = start(counts, "pages", "update", each_batch, Running(f"{folder}/checkpoints", {"availableNow": True}))
    query.awaitTermination()
    state = sum(o["numRowsTotal"] for o in query.lastProgress["stateOperators"])
    return sorted(emitted, key=repr), state


def test_a_count_expires_and_starts_anew_without_refusing_its_day(spark, session, tmp_path):
    life = {"count_life": timedelta(seconds=30), "member_life": timedelta(seconds=30), "every": None}
    many = [("2024-01-01", f"p{i}", "u") for i in range(6)]
    first, full = run(spark, session, tmp_path, [("2024-01-01", "a", "u1"), ("2024-01-01", "a", ""), *many], **life)
    assert ("2024-01-01", "a", 2, ["u1"], False) in first and len(first) == 7
    again, _ = run(spark, session, tmp_path, [("2024-01-01", "a", "u2")], **life)
    assert again == [("2024-01-01", "a", 3, ["u1", "u2"], False)]
    time.sleep(31)
    anew, left = run(spark, session, tmp_path, [("2024-01-01", "a", None), ("2024-01-02", "b", "u1")], **life)
    assert anew == [("2024-01-01", "a", 1, [], False), ("2024-01-02", "b", 1, ["u1"], False)]
    assert left < full


def test_a_key_emits_by_its_timer_once_until_it_is_seen_again(spark, session, tmp_path):
    timed = {"on_change": False, "every": timedelta(seconds=3)}
    nothing, _ = run(spark, session, tmp_path, [("d", "a", "u1"), ("d", "a", "u1")], **timed)
    assert nothing == []
    time.sleep(3)
    due, _ = run(spark, session, tmp_path, [("d", "b", "u2")], **timed)
    assert due == [("d", "a", 2, ["u1"], True)]
    time.sleep(3)
    others, _ = run(spark, session, tmp_path, [("d", "a", "u3")], **timed)
    assert others == [("d", "b", 1, ["u2"], True)]


def test_a_key_holds_its_members_as_one_value_and_forgets_each_by_its_own_last_write(spark, session, tmp_path):
    life = {"count_life": timedelta(hours=1), "member_life": timedelta(seconds=40), "every": None}
    _, few = run(spark, session, tmp_path, [("d", "a", "u0")], **life)
    users = [f"u{i}" for i in range(5000)]
    whole, many = run(spark, session, tmp_path, [("d", "a", u) for u in users], **life)
    assert whole == [("d", "a", 5001, sorted(users), False)]
    assert many == few
    time.sleep(30)
    run(spark, session, tmp_path, [("d", "a", "u7"), ("d", "a", "é")], **life)
    time.sleep(12)
    later, _ = run(spark, session, tmp_path, [("d", "a", None)], **life)
    assert later == [("d", "a", 5004, ["u7", "é"], False)]

"""Snapshot and changes as one feed, and puts and deletes of stored keys, against plain Python."""

import random

from pyspark.sql import functions as F

from retailtide.operators import handover, kv
from retailtide.sinks.entries import EntryTable, fold, get_stored, read_entries, read_present, store_by_key, write_entries


def test_feed_has_the_newest_state_wherever_a_chunk_is_read(spark):
    rng = random.Random(11)
    log, state = [], {k: f"v{k}" for k in range(60)}
    history = [dict(state)]
    for seq in range(1, 301):
        key = 7 if rng.random() < 1 / 3 else rng.randrange(80)
        op = "d" if key in state and rng.random() < 0.3 else "u" if key in state else "c"
        image = None if op == "d" else f"v{key}.{seq}"
        if op == "d":
            del state[key]
        else:
            state[key] = image
        log.append((key, op, image, seq))
        history.append(dict(state))
    rows, low = [], 0
    for chunk in range(8):
        high = low + rng.randrange(1, 40)
        at = rng.randrange(low, high + 1)  # nobody knows when, between the marks
        rows += [(k, v, low, high) for k, v in history[at].items() if k % 8 == chunk]
        low = high + rng.randrange(3)
    snapshot = spark.createDataFrame(rows, "id long, image string, low long, high long")
    changes = spark.createDataFrame(log, "id long, op string, image string, seq long")
    feed = handover.joined_feed(snapshot, changes, "id")
    assert dict(map(tuple, handover.newest_state(feed, "id").collect())) == state
    # a reader that follows the feed in order never sees a key go back to an older image
    seen = {}
    for r in feed.orderBy("position", "from_snapshot").collect():
        written = history[r.position].get(r.id)
        assert r.image == written or r.op == "d"
        seen[r.id] = r.image
    assert {k: v for k, v in seen.items() if v is not None} == state


def test_chunks_are_read_between_two_marks(spark, tmp_path):
    table = spark.range(100).withColumn("image", F.col("id") * 2)
    marks = iter(range(10, 100, 10))
    chunks = [F.col("id") < 30, (F.col("id") >= 30) & (F.col("id") < 80), F.col("id") >= 80]
    rows = handover.read_in_chunks(table.filter, chunks, lambda: next(marks), str(tmp_path / "snapshot"))
    found = rows.groupBy("low", "high").agg(F.count("*"), F.min("id"), F.max("id")).orderBy("low").collect()
    assert [tuple(r) for r in found] == [(10, 20, 30, 0, 29), (30, 40, 50, 30, 79), (50, 60, 20, 80, 99)]


def test_the_newest_of_put_and_delete_wins_in_any_order_of_batches(spark, tmp_path):
    rng = random.Random(2)
    frame = lambda keys, tag: spark.createDataFrame([(k, tag, None) for k in keys], "k string, v string, w string")
    table, state, batches = EntryTable(str(tmp_path / "t"), files=2), {}, []
    assert read_present(spark, table).collect() == []
    for seq in range(6):
        keys = rng.sample([f"k{i}" for i in range(12)], 6)
        put, gone = keys[:4], keys[3:]  # k3 is put and deleted at once: the tombstone wins
        entries = kv.put_entries(frame(put, f"s{seq}"), F.col("k"), F.lit(seq)).unionByName(
            kv.delete_entries(spark.createDataFrame([(k,) for k in gone], "row_key string"), F.lit(seq))
        )
        batches.append(entries)
        state.update({k: {"k": k, "v": f"s{seq}"} for k in put})
        for k in gone:
            state.pop(k, None)
    for seq in (3, 0, 5, 1, 4, 2, 3, 1):
        write_entries(batches[seq], seq, table)
    assert {r.row_key: r.info for r in read_present(spark, table).collect()} == state
    part, whole = EntryTable(str(tmp_path / "part"), 2), EntryTable(str(tmp_path / "whole"), 2)
    fold(spark, table, part, 3)
    fold(spark, table, whole, 5)
    for folded in (part, whole):
        assert {r.row_key: r.info for r in read_present(spark, folded).collect()} == state
    assert read_entries(spark, part).filter("deleted").count() > 0
    assert read_entries(spark, whole).count() == len(state)
    write_entries(batches[5], 5, part)  # a replay after the fold
    assert {r.row_key: r.info for r in read_present(spark, part).collect()} == state


def test_a_read_by_key_opens_one_file(spark, tmp_path):
    rows = spark.range(3000).select(F.format_string("k%05d", "id").alias("row_key"), F.col("id").cast("string").alias("v"))
    store_by_key(rows, str(tmp_path / "t"), 12)
    found = get_stored(spark, str(tmp_path / "t"), "k00042", 12)
    assert [tuple(r) for r in found.collect()] == [("k00042", "42")]
    plan = found._jdf.queryExecution().executedPlan()
    scans = plan.collectLeaves()
    assert scans.apply(0).metrics().apply("numFiles").value() == 1
    assert get_stored(spark, str(tmp_path / "t"), "no such key", 12).count() == 0

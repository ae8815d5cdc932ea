"""Key/value tables, word sets, report tables, retention, readers' options."""

from datetime import date, datetime
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from retailtide.functions.texts import camel_columns
from retailtide.operators import kv, membership
from retailtide.operators.bounded import broadcast_if_small, measured_bytes
from retailtide.sinks import retention, tables, topics
from retailtide.sinks.tables import LoadRejected, ReportTable, compact, read_table, write_batch
from retailtide.sources import jdbc
from retailtide.sources import topics as sources


def test_cells_and_rows(spark):
    frame = spark.createDataFrame([("k1", 1, None), ("k2", 2, 0.5)], "k string, a int, b double")
    cells = kv.to_cells(frame, F.col("k"))
    assert {tuple(r) for r in cells.collect()} == {
        ("k1", "k", "k1"),
        ("k1", "a", "1"),
        ("k2", "k", "k2"),
        ("k2", "a", "2"),
        ("k2", "b", "0.5"),
    }
    rows = kv.cells_to_rows(cells, ["a", "b"])
    assert {tuple(r) for r in rows.collect()} == {("k1", "1", None), ("k2", "2", "0.5")}
    assert kv.get(rows, "k2").first().b == "0.5"
    maps = {r.row_key: r.info for r in kv.cells_to_maps(cells).collect()}
    assert maps == {"k1": {"a": "1", "k": "k1"}, "k2": {"a": "2", "b": "0.5", "k": "k2"}}


def test_newest_version_of_a_cell(spark):
    cells = spark.createDataFrame(
        [("k", "a", "9", 1), ("k", "a", "1", 2)], "row_key string, qualifier string, value string, v long"
    )
    assert kv.cells_to_rows(cells, ["a"], "v").first().a == "1"
    assert kv.cells_to_maps(cells, "v").first().info == {"a": "1"}


def test_put_delete_scan_count(spark):
    frame = spark.createDataFrame([(2, "b", 1), (10, "a", 1), (2, "c", 5)], "k int, x string, n int")
    rows = kv.put(frame, F.col("k"), F.col("n"))
    assert [tuple(r) for r in kv.scan(rows, 9).collect()] == [("10", "10", "a", "1"), ("2", "2", "c", "5")]
    assert [r.row_key for r in kv.scan(rows, 1).collect()] == ["10"]
    keys = spark.createDataFrame([("2",), ("7",)], "row_key string")
    assert [r.row_key for r in kv.delete(rows, keys).collect()] == ["10"]
    assert [r.row_key for r in kv.get_many(rows, keys).collect()] == ["2"]
    assert kv.count_rows(rows).first()["rows"] == 2


def test_membership(spark):
    sets = spark.createDataFrame(
        [("s", "x"), ("s", "x"), ("s", None), ("t", "y")], "set_name string, word string"
    )
    words = membership.members(sets, "s")
    frame = spark.createDataFrame([(1, "x"), (2, "y"), (3, None), (4, "x")], "id int, word string")
    assert {r.id for r in membership.in_set(frame, "word", words).collect()} == {1, 4}
    assert {r.id for r in membership.not_in_set(frame, "word", words).collect()} == {2, 3}
    flags = membership.flag_in_set(frame, "word", words)
    assert {r.id: r.is_member for r in flags.collect()} == {1: True, 2: False, 3: False, 4: True}
    assert membership.members(sets).count() == 2


def test_membership_reads_each_side_once_and_measures_nothing(spark, tmp_path):
    spark.range(5000).selectExpr("cast(id as string) word").write.parquet(str(tmp_path / "rows"))
    spark.range(9).selectExpr("cast(id as string) word").write.parquet(str(tmp_path / "words"))
    rows, words = (spark.read.parquet(str(tmp_path / n)) for n in ("rows", "words"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("membership", "")
    joined = membership.in_set(rows, "word", membership.members(words))
    assert not tracker.getJobIdsForGroup("membership")
    assert joined.count() == 9
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2


def test_only_measured_sides_are_broadcast(spark):
    small = spark.createDataFrame([("x" * 100,)], "word string")
    assert 100 < measured_bytes(small) < 200
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(broadcast_if_small(small, 1000))
    assert not hinted(broadcast_if_small(small, 50))


def keyed(path, **more):
    return ReportTable(path, ("pt", "k"), **more)


def frame(spark, rows):
    return spark.createDataFrame([(date(2024, 1, d), k, v) for d, k, v in rows], "pt date, k string, v int")


def content(spark, table):
    return sorted((r.pt.day, r.k, r.v) for r in read_table(spark, table).collect())


@pytest.mark.parametrize("files", [None, 2])
def test_upsert_and_replay(spark, tmp_path, files):
    table = keyed(str(tmp_path / "t"), files=files)
    write_batch(frame(spark, [(1, "a", 1), (1, "b", 1), (2, "a", 1)]), 0, table, unique=True)
    second = frame(spark, [(1, "a", 2), (3, "c", 2)])
    for _ in range(2):  # a batch run twice counts once
        write_batch(second, 1, table, unique=True)
        assert content(spark, table) == [(1, "a", 2), (1, "b", 1), (2, "a", 1), (3, "c", 2)]
    write_batch(frame(spark, []), 2, table, unique=True)
    write_batch(frame(spark, [(1, "a", 7), (1, "a", 9), (1, "a", 8)]), 3, table, F.col("v"))
    assert content(spark, table)[0] == (1, "a", 9)


def test_compaction_keeps_the_state_and_later_batches_win(spark, tmp_path):
    old, new = keyed(str(tmp_path / "old")), keyed(str(tmp_path / "new"))
    write_batch(frame(spark, [(1, "a", 1), (2, "b", 1)]), 4, old, unique=True)
    write_batch(frame(spark, [(1, "a", 2)]), 5, old, unique=True)
    compact(spark, old, new.path)
    assert content(spark, new) == content(spark, old) == [(1, "a", 2), (2, "b", 1)]
    write_batch(frame(spark, [(2, "b", 6)]), 6, new, unique=True)
    assert content(spark, new) == [(1, "a", 2), (2, "b", 6)]


def test_compacted_table_survives_a_replay_of_its_newest_batch(spark, tmp_path):
    old, new = keyed(str(tmp_path / "old")), keyed(str(tmp_path / "new"))
    write_batch(frame(spark, [(1, "a", 1), (1, "b", 1)]), 0, old, unique=True)
    write_batch(frame(spark, [(1, "a", 2)]), 1, old, unique=True)
    compact(spark, old, new.path)
    for _ in range(2):
        write_batch(frame(spark, [(1, "a", 2)]), 1, new, unique=True)
        assert content(spark, new) == [(1, "a", 2), (1, "b", 1)]
    write_batch(frame(spark, [(1, "b", 3)]), 2, new, unique=True)
    again = keyed(str(tmp_path / "again"))
    compact(spark, new, again.path)
    assert content(spark, again) == [(1, "a", 2), (1, "b", 3)]


def test_a_keyed_write_needs_an_order(spark, tmp_path):
    with pytest.raises(ValueError):
        write_batch(frame(spark, [(1, "a", 1), (1, "a", 2)]), 0, keyed(str(tmp_path / "t")))


def test_append_table_keeps_every_row(spark, tmp_path):
    table = ReportTable(str(tmp_path / "t"), files=3)
    for batch in (0, 1, 1):
        write_batch(frame(spark, [(1, "a", 1), (1, "a", 1)]), batch, table)
    assert content(spark, table) == [(1, "a", 1)] * 4


def test_load_is_refused_above_a_tenth_of_unusable_rows(spark, tmp_path):
    table = keyed(str(tmp_path / "t"), required=("pt", "k"))
    good = [(1, f"k{i}", i) for i in range(9)]
    write_batch(frame(spark, good + [(1, None, 0)]), 0, table, unique=True)
    assert len(content(spark, table)) == 9
    assert [(r.k, r.v, r.batch_id) for r in tables.read_rejected(spark, table).collect()] == [(None, 0, 0)]
    with pytest.raises(LoadRejected):
        write_batch(frame(spark, good[:8] + [(1, None, 0)]), 1, table, unique=True)
    assert len(content(spark, table)) == 9
    tables.check_rejects(frame(spark, []), tables.unusable(("k",)))


def test_days_a_table_does_not_have_are_rejected(spark, tmp_path):
    table = keyed(str(tmp_path / "t"), back=2, ahead=1)
    rows = [(d, "k", d) for d in (8, 9, 10)] + [(10, f"k{i}", 0) for i in range(20)]
    write_batch(frame(spark, [*rows, (7, "k", 7), (12, "k", 12)]), 0, table, unique=True, as_of="2024-01-10")
    assert {d for d, *_ in content(spark, table)} == {8, 9, 10}
    assert sorted(r.v for r in tables.read_rejected(spark, table).collect()) == [7, 12]


def test_retention_and_truncate(spark, tmp_path):
    table = keyed(str(tmp_path / "t"))
    write_batch(frame(spark, [(1, "a", 1), (15, "b", 1), (31, "c", 1)]), 0, table, unique=True)
    rows = spark.read.parquet(table.path)
    assert {r.k for r in retention.kept(rows, "2024-01-31").collect()} == {"a", "b", "c"}
    assert {r.k for r in retention.kept(rows, "2024-02-01", ahead=0).collect()} == {"b", "c"}
    assert {r.k for r in retention.kept(rows, "2024-01-01", ahead=29).collect()} == {"a", "b"}
    plan = retention.kept(rows, "2024-02-01")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pt" in plan
    assert retention.drop_expired(spark, table.path, date(2024, 2, 1)) == ["pt=2024-01-01"]
    assert content(spark, table) == [(15, "b", 1), (31, "c", 1)]
    assert retention.truncate(spark, table.path) == ["pt=2024-01-15", "pt=2024-01-31"]
    empty = keyed(table.path, schema=frame(spark, []).schema)
    assert content(spark, empty) == []
    write_batch(frame(spark, [(4, "d", 1)]), 1, empty, unique=True)
    assert content(spark, empty) == [(4, "d", 1)]


def test_texts_to_files(spark, tmp_path):
    deliver = topics.to_files(str(tmp_path / "topic"))
    topics.send(spark.createDataFrame([(1, None), (2, "x")], "a int, b string"), deliver)
    texts = spark.read.text(str(tmp_path / "topic"))
    assert {r.value for r in texts.collect()} == {'{"a":1}', '{"a":2,"b":"x"}'}


def test_topic_options():
    options = sources.kafka_options("h:9092", "t", "earliest", 5000)
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "5000"
    midnight = sources.midnight_millis("Asia/Shanghai", date(2024, 5, 1))
    assert midnight == int(datetime(2024, 4, 30, 16, tzinfo=ZoneInfo("UTC")).timestamp() * 1000)
    options = sources.kafka_options("h:9092", "t", midnight)
    assert options["startingTimestamp"] == str(midnight) and "startingOffsets" not in options
    sink = topics.kafka_options("h:9092", "t")
    assert (sink["kafka.acks"], sink["kafka.enable.idempotence"]) == ("all", "true")


def test_database_options(spark):
    connection = jdbc.options("jdbc:x:y", user="u", driver="d")
    assert connection == {"url": "jdbc:x:y", "user": "u", "driver": "d"}
    assert jdbc.split_options("id", 1, 9, 4)["numPartitions"] == "4"
    named = spark.createDataFrame([(1, 2)], "ORDER_ID int, TOTAL_AMOUNT int")
    assert camel_columns(named).columns == ["orderId", "totalAmount"]


def test_a_load_reads_its_input_once_and_a_refused_one_changes_nothing(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)
    table = ReportTable(str(tmp_path / "t"), ("k",), required=("k",))

    def rows(values):
        def counted(row):
            read.add(1)
            return row

        return spark.createDataFrame(
            spark.sparkContext.parallelize([(date(2024, 1, 1), k, v) for k, v in values], 2).map(counted),
            "pt date, k string, v long",
        )

    good = [(f"k{i}", i) for i in range(30)]
    write_batch(rows([*good, (None, -1)]), 0, table, F.col("v"))
    assert read.value == 31
    before = sorted(tuple(r) for r in read_table(spark, table).select("k", "v").collect())
    assert before == sorted(good) and tables.read_rejected(spark, table).count() == 1
    with pytest.raises(LoadRejected, match="5 of 10"):
        write_batch(rows([("k1", 100)] * 5 + [(None, 0)] * 5), 1, table, F.col("v"))
    assert sorted(tuple(r) for r in read_table(spark, table).select("k", "v").collect()) == before

"""The stored state of a stream against its report."""

from datetime import date

from pyspark.sql import functions as F

from retailtide.session import stream_session
from retailtide.sinks.tables import read_table, write_batch
from retailtide.streaming import audit, logs
from retailtide.streaming.run import Running, finish

SCHEMA = "event_time timestamp, device struct<plat:string,brand:string,platv:string>"


def test_a_count_that_was_changed_by_hand_is_found(spark, tmp_path):
    session = stream_session(spark)
    session.conf.set("spark.sql.shuffle.partitions", "2")
    folder, running = str(tmp_path / "out"), Running(str(tmp_path / "checkpoints"), {"availableNow": True})
    table = logs.device_table(folder)
    for part in range(2):  # the second run goes on from the state of the first
        rows = spark.range(60).select(
            F.timestamp_seconds(F.lit(1709251200) + F.col("id") * 3000).alias("event_time"),
            F.struct(
                F.concat(F.lit("OS"), F.col("id") % 3).alias("plat"),
                F.when(F.col("id") % 4 > 0, "B").alias("brand"),
                F.lit("1").alias("platv"),
            ).alias("device"),
        )
        rows.write.mode("append").parquet(f"{tmp_path}/in")
        stream = session.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
        finish(logs.device_stream(stream, folder, running))
        assert audit.device_differences(session, running, table).collect() == []
    assert audit.stored_state(session, running, "device_stats").count() == read_table(spark, table).count()
    report = read_table(spark, table).drop("update_time")
    wrong = report.filter("pt = '2024-03-01' and os = 'os0' and brand = 'b'").withColumn("count", F.lit(7).cast("long"))
    more = wrong.withColumn("brand", F.lit("unheard of"))
    write_batch(wrong.unionByName(more), 99, table, unique=True)
    found = audit.device_differences(session, running, table).orderBy("brand").collect()
    assert [(r["pt"], r["os"], r["brand"], r["state"] and r["state"]["count"], r["report"]["count"]) for r in found] == [
        (date(2024, 3, 1), "os0", "b", 14, 7),
        (date(2024, 3, 1), "os0", "unheard of", None, 7),
    ]

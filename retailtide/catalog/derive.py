"""Orders, logs and change records in the library's layouts, derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text_variant(k: Column) -> Column:
    """Product ids as they arrive: bare, padded, or with a line break of either kind."""
    kind = F.col("event_id") % 4
    return (
        F.when(kind == 1, F.concat(F.lit(" "), k, F.lit(" ")))
        .when(kind == 2, F.concat(k, F.lit("\\n")))
        .when(kind == 3, F.concat(k, F.lit("\n")))
        .otherwise(k)
    )


def with_key(events: DataFrame) -> DataFrame:
    """Add the number inside ``props`` as a column of its own, so its text is read once a row."""
    return events.withColumn("k", F.get_json_object("props", "$.k"))


def order_columns(events: DataFrame) -> DataFrame:
    """Events as order rows; epochs in seconds and milliseconds, some amounts unreadable."""
    ts = F.col("ts").cast("timestamp")
    return with_key(events).select(
        F.col("event_id").alias("id"),
        F.col("user_id").cast("string").alias("user_id"),
        _text_variant(F.col("k")).alias("product_id"),
        F.when(F.col("event_id") % 97 == 0, F.lit("n/a"))
        .otherwise(F.col("value").cast("string"))
        .alias("total_amount"),
        F.when(F.col("event_id") % 2 == 0, F.unix_seconds(ts))
        .otherwise(F.unix_millis(ts))
        .alias("ts"),
    )


def orders(spark: SparkSession, sf_dir: str, since: str | None = None) -> DataFrame:
    """Order stream of the events table; ``since`` is the start position of the read."""
    from retailtide.functions.times import order_time

    events = table(spark, sf_dir, "events")
    if since:
        events = events.filter(F.col("ts") >= F.lit(since).cast("timestamp_ntz"))
    return order_columns(events).withColumn("ts_ms", order_time(F.col("ts")))


def log_columns(events: DataFrame, *keep: Column | str) -> DataFrame:
    """Events as log records; some rows lack the user, the brand or the version."""
    k = F.col("k").cast("int")
    number = F.col("event_id")
    device = F.struct(
        F.when(k % 10 != 3, F.concat(F.lit("B"), k % 7)).alias("brand"),
        F.upper("event_type").alias("plat"),
        F.when(k % 10 != 0, F.concat(F.lit("V"), k % 5)).alias("platv"),
    )
    ip = F.concat_ws(".", F.lit("10"), F.col("user_id") % 30, number % 256, F.lit("1"))
    return with_key(events).select(
        number.cast("string").alias("log_id"),
        device.alias("device"),
        F.struct(ip.alias("ip")).alias("gis"),
        F.col("event_type").alias("log_type"),
        F.when(number % 11 == 0, F.lit("").cast("string"))
        .otherwise(F.col("user_id").cast("string"))
        .alias("user_id"),
        *keep,
    )


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from retailtide.plans.logs import with_day

    events = table(spark, sf_dir, "events")
    return with_day(log_columns(events, F.col("ts").alias("event_time")))


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range table: nation n owns ``10.n.0.0`` to ``10.n.255.255``; some parts are unknown."""
    nation, region = (table(spark, sf_dir, n) for n in ("nation", "region"))
    n = F.col("n_nationkey")
    text = F.concat_ws(
        "|",
        F.lit("X"),
        F.when(n % 4 == 0, F.lit("0")).otherwise(F.col("r_name")),
        F.when(n % 5 == 0, F.when(n < 15, F.lit("")).otherwise("0")).otherwise(F.col("n_name")),
        F.lit("isp"),
    )
    low = (F.lit(10 * 256) + n).cast("bigint") * 65_536
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        low.alias("ip_lo"), (low + 65_535).alias("ip_hi"), text.alias("region")
    )


def searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as searches for the words of the part's name, on the ship date."""
    lineitem, part = (table(spark, sf_dir, n) for n in ("lineitem", "part"))
    return lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_shipdate").cast("date").alias("day"), F.split("p_name", " ").alias("keywords")
    )


def changes(orders: DataFrame) -> DataFrame:
    """Orders as change records: finished ones are inserts, open ones updates, pending ones deletes."""
    status = F.col("o_orderstatus")
    op = F.when(status == "F", "c").when(status == "O", "u").otherwise("d")
    after = F.struct(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("SO"), "o_orderkey").alias("order_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("total_amount"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("ds"),
        F.col("o_orderpriority").alias("priority"),
        (F.col("o_orderkey") % 7).alias("lines"),
    )
    source = F.struct(
        F.lit("oms").alias("db"),
        F.when(F.col("o_orderkey") % 3 != 0, F.lit("dbo")).alias("schema"),
        F.lit("orders").alias("table"),
    )
    envelope = F.struct(
        F.when(op != "d", after).alias("after"), source.alias("source"), op.alias("op")
    )
    return orders.select(F.to_json(envelope).alias("value"))

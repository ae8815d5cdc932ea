"""JSON text to columns, dead letters, change-record flattening, keyword rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailtide import schemas
from retailtide.functions.times import log_time, order_time

_JSON_OPTIONS = {"allowUnquotedFieldNames": "true"}


def with_record(
    df: DataFrame, schema: T.StructType, value: str = "value", name: str = "record"
) -> DataFrame:
    """Add the text as one struct, null unless it holds exactly one JSON object.

    ``from_json`` alone stops after the first object and would accept trailing rubbish, so
    the text is read as a one-element list. The generator makes the struct a column of its
    own: as a plain expression Spark would parse the text anew for every field taken from it.
    """
    text = F.col(value)
    items = F.from_json(F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(schema), _JSON_OPTIONS)
    # A list that the text itself closes would hide what follows, so such texts must also be
    # good as the one field of an object; no others are read twice.
    field = T.StructType([T.StructField("x", T.MapType(T.StringType(), T.StringType()))])
    inside = F.from_json(F.concat(F.lit('{"x":'), text, F.lit("}")), field, _JSON_OPTIONS)
    whole = F.when(text.rlike(r"\}\s*\]"), inside["x"].isNotNull()).otherwise(F.lit(True))
    closed = F.rtrim(text).endswith("}") & whole
    single = F.transform(
        F.array(items), lambda a: F.when((F.size(a) == 1) & closed, F.get(a, F.lit(0)))
    )
    return df.select("*", F.explode(single).alias(name))


def parsed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("record").isNotNull())


def dead_letters(df: DataFrame, value: str = "value") -> DataFrame:
    """Texts that did not parse, unchanged."""
    return df.filter(F.col("record").isNull()).select(F.col(value).alias("value"))


def log_records(df: DataFrame) -> DataFrame:
    """Log columns plus ``event_time`` (log rule) of a DataFrame with ``record``."""
    flat = parsed(df).select("record.*")
    ts = F.col("ts").try_cast("bigint")
    return flat.withColumn("ts", ts).withColumn("event_time", log_time(F.col("ts")))


def record_log_time() -> Column:
    return log_time(F.col("record.ts").try_cast("bigint"))


def complete_log() -> Column:
    """A log row every report can use: page, address, device and a readable time."""
    return (
        F.col("log_type").isNotNull()
        & F.col("gis.ip").isNotNull()
        & F.col("device").isNotNull()
        & F.col("event_time").isNotNull()
    )


def keyword_rows(df: DataFrame, keywords: str = "keywords") -> DataFrame:
    """One row per search word; rows without a word list give none."""
    words = F.col(keywords)
    if isinstance(df.schema[keywords].dataType, T.StringType):
        words = F.from_json(words, "array<string>")
    return (
        df.filter(F.col(keywords).isNotNull())
        .withColumn("keyword", F.explode(words))
        .filter(F.col("keyword").isNotNull())
    )


def order_records(df: DataFrame) -> DataFrame:
    """Typed order columns, ``ts_ms`` (order rule) and ``proc_time`` of rows with ``record``."""
    flat = parsed(df).select("record.*")
    longs = [c for c in ("id", "ts") if c in flat.columns]
    typed = flat.withColumns({c: F.col(c).try_cast("bigint") for c in longs})
    return typed.withColumns(
        {"ts_ms": order_time(F.col("ts")), "proc_time": F.current_timestamp()}
    )


def change_images(df: DataFrame) -> DataFrame:
    """Whole after-images as JSON, with ``table_name`` and ``op``; deletes drop out."""
    source = F.col("record.source")
    table_name = F.concat_ws(
        ".", *[F.coalesce(source.getField(f), F.lit("")) for f in ("db", "schema", "table")]
    )
    # The text is made once, behind a generator, and not anew where it is named.
    texts = df.select(
        F.explode(F.array(F.to_json("record.after"))).alias("after"),
        table_name.alias("table_name"),
        F.coalesce(F.col("record.op"), F.lit("")).alias("op"),
    )
    return texts.filter(F.col("after").startswith("{"))


def flatten_changes(df: DataFrame, schema: T.StructType = schemas.ORDER_ROW) -> DataFrame:
    """The fields of ``schema`` of each after-image as columns, and the whole of it in ``after``."""
    read = parsed(with_record(change_images(df), schema, "after"))
    own = [f"record.{n}" for n in schema.names if n not in ("after", "table_name", "op")]
    return read.select(*own, "after", "table_name", "op")


def change_texts(df: DataFrame, value: str = "value") -> DataFrame:
    """Each after-image as one JSON text, all its fields, plus ``table_name`` and ``op``.

    Numbers stay the numbers they are and nulls stay nulls, whatever the table's columns. Only an
    image that has fields of these two names is taken apart to put others in their place.
    """
    images = change_images(df)
    body = F.rtrim(F.substring(F.col("after"), F.lit(2), F.char_length("after") - 2))
    added = F.to_json(F.struct("table_name", "op"))
    names = F.json_object_keys("after")
    joined = F.concat(
        F.lit("{"), body, F.when(F.trim(body) != "", ",").otherwise(""), F.substring(added, 2, 2**31 - 1)
    )
    fields = F.try_parse_json("after").cast("map<string,variant>")
    others = F.map_filter(fields, lambda k, v: ~k.isin("table_name", "op"))
    rest = F.to_json(others, {"ignoreNullFields": "false"})
    rebuilt = F.concat(
        F.substring(rest, F.lit(1), F.char_length(rest) - 1),
        F.when(F.size(others) > 0, ",").otherwise(""),
        F.substring(added, 2, 2**31 - 1),
    )
    # Only a text that has such a name somewhere is read for its own fields.
    named = F.col("after").contains('"table_name"') | F.col("after").contains('"op"')
    taken = named & F.arrays_overlap(names, F.array(F.lit("table_name"), F.lit("op")))
    return images.select(F.when(taken, rebuilt).otherwise(joined).alias(value))


def as_json(df: DataFrame, value: str = "value") -> DataFrame:
    """Each row as one JSON text; null fields are left out."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias(value))


def snapshot_changes(
    rows: DataFrame, db: str, schema: str, table: str, op: str = "r"
) -> DataFrame:
    """A table's present rows as change-record texts, as the first phase of a change feed.

    Columns without a value are written as nulls.
    """
    return rows.select(
        F.to_json(
            F.struct(
                F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("after"),
                F.struct(
                    F.lit(db).alias("db"),
                    F.lit(schema).alias("schema"),
                    F.lit(table).alias("table"),
                ).alias("source"),
                F.lit(op).alias("op"),
            ),
            {"ignoreNullFields": "false"},
        ).alias("value")
    )


def order_changes(df: DataFrame) -> DataFrame:
    return with_record(df, schemas.ENVELOPE)

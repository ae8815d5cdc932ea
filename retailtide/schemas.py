"""Record layouts.

JSON fields are read as text and cast afterwards: a number sent as text still counts, and
one bad field does not throw its whole record away.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Field names of the incoming records.
DEVICE = _strings("brand", "plat", "platv", "softv", "uname", "userkey", "device")

LOG = (
    T.StructType()
    .add("log_id", T.StringType())
    .add("device", DEVICE)
    .add("gis", _strings("ip"))
    .add("network", _strings("net"))
    .add("opa", T.StringType())
    .add("log_type", T.StringType())
    .add("ts", T.StringType())
    .add("product_id", T.StringType())
    .add("order_id", T.StringType())
    .add("user_id", T.StringType())
    .add("keywords", T.StringType())
)

ORDER = _strings(
    "id",
    "order_id",
    "user_id",
    "user_name",
    "phone_number",
    "product_link",
    "product_id",
    "color",
    "size",
    "item_id",
    "material",
    "sale_num",
    "sale_amount",
    "total_amount",
    "product_name",
    "is_online_sales",
    "shipping_address",
    "recommendations_product_ids",
    "ds",
    "ts",
    "insert_time",
    "table_name",
    "op",
)

ORDER_ROW = T.StructType([f for f in ORDER.fields if f.name not in ("table_name", "op")])

SOURCE = _strings("db", "schema", "table")


def only(schema: T.StructType, *names: str) -> T.StructType:
    """A narrower layout, so that only the needed fields are read from a text."""
    return T.StructType([schema[n] for n in names])


# Change record around one row of any table: its after-image keeps all fields and their types.
ENVELOPE = T.StructType().add("after", T.VariantType()).add("source", SOURCE).add("op", T.StringType())

# The fields of an order text that the sales reports use.
SALE = only(ORDER, "product_id", "total_amount", "ts")

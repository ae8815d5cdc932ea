"""Order-table changes to the order topic."""

from __future__ import annotations

from pyspark.sql import DataFrame

from retailtide.operators import parse


def order_topic(changes: DataFrame) -> DataFrame:
    """Change texts to the texts of the order topic; deletes and broken texts drop out."""
    return parse.change_texts(parse.parsed(parse.order_changes(changes)))


def broken_changes(changes: DataFrame) -> DataFrame:
    return parse.dead_letters(parse.order_changes(changes))

"""Top-k per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(
    df: DataFrame, group: list[str], order: list[Column], k: int, rank: str = "rn"
) -> DataFrame:
    """First ``k`` rows of each group by ``order``, numbered from 1.

    The bound on the row number lets Spark cut each group to ``k`` rows before the shuffle,
    so a hot group never travels whole.
    """
    numbered = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn(rank, numbered).filter(F.col(rank) <= k)

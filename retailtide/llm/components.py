"""Connected components of an edge table, by alternating star contractions, and tables written on the way.

Defined cases: an edge with a null end, or from a node to itself, is left out; repeated edges count once; an
empty table has no components. Only ``a`` and ``b`` are read, so other columns may have any name; texts
are not read at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailtide.session import shared_folder


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The table, written to the shared folder and read back: computed once, safe from lost executors."""
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def unused(df: DataFrame, name: str) -> str:
    """A column name that the table does not have, in no letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its smallest neighbour to its larger ones."""
    both = edges.union(edges.select("b", "a")).toDF("a", "b")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands its smallest neighbour to its smaller ones and keeps it itself."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", "least")).toDF("a", "b").distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)``; the component is its smallest node.

    Each round is a few aggregates and equi-joins over the edges; hot nodes are summed before the
    shuffle or split by adaptive execution. Rounds grow with the logarithm of the longest path. The
    edges are written to the shared folder after each half of a round: a star reads its edges several
    times, and one plan of both would hold the first for each reading of the second. Roots are not listed.
    """
    edges = written(edges.filter("a <> b").select("a", "b"), "edges")
    while True:
        edges = written(_small_star(written(_large_star(edges), "edges")), "edges")
        # Done when every node but the roots has one edge, and that to a root.
        several = edges.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1").select("a")
        inner = edges.join(edges.select(F.col("a").alias("b")), "b", "left_semi").select("a")
        if several.union(inner).isEmpty():
            return edges.toDF("node", "component")

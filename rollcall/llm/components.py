"""Connected components by alternating large and small stars, each round a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.session import drop_path, scratch_path


class Rounds:
    """Tables written under the shared folder; all but the last are dropped when the next is stored."""

    def __init__(self, spark):
        self.spark, self.old = spark, []

    def store(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, "round")
        df.write.parquet(path)
        self.old.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def forget(self, keep: int = 1) -> None:
        while len(self.old) > keep:
            drop_path(self.spark, self.old.pop(0))


def _star(rounds: Rounds, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``pairs`` (u, v) with the least neighbour ``m`` of u, and the table (u, m).

    The least neighbours are stored first: both sides of the join are then plain
    exchanges, which adaptive execution can split where u is a hub.
    """
    least = rounds.store(pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("m")))
    return pairs.join(least.hint("shuffle_merge"), "u"), least


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node that has an edge to another; a component is named by its least node.

    Rows with a NULL end and loops add nothing. Any number of equal edges counts as one. Each
    round is two stars; rounds grow with the logarithm of the longest path, not with its length.
    """
    spark = edges.sparkSession
    rounds = Rounds(spark)
    ends = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a) != F.col(b))
    edges = rounds.store(ends.filter(ends[2]).select("u", "v").distinct())
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        joined, _ = _star(rounds, both)
        edges = rounds.store(joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        joined, least = _star(rounds, edges)
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = rounds.store(small.union(least.select("u", "m")).distinct())
        mark = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        rounds.forget()
        if mark == before or mark[0] == 0:
            break
        before = mark
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct()
    )

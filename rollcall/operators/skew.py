"""Joins that spread a hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 10_000_000
#: Equal rows of a hot key that are unfolded together, as one array.
COPIES = 100_000


def hot_keys(counts: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(hot, fan)``: hash of every key with more than ``hot_rows`` rows, and how many ways to split it.

    There are at most (all rows / ``hot_rows``) of them, 16 bytes each: a trillion rows give
    a hundred thousand, so this side of a join may always be broadcast. Two keys with one
    hash share the larger fan, which changes no result.
    """
    return (
        counts.filter(F.col("n") > hot_rows)
        .groupBy(F.xxhash64(key).alias("hot"))
        .agg(F.max(F.ceil(F.col("n") / hot_rows)).cast("int").alias("fan"))
    )


def join_lookup(
    rows: DataFrame, lookup: DataFrame, counts: DataFrame, key: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Inner join of ``rows`` to ``lookup`` (unique on ``key``); rows of a hot key go to many tasks.

    ``counts`` is ``(key, n)`` over ``rows``. Rows of cold keys are joined as usual. Of hot keys, equal rows are counted
    where they are read, and each count is cut into runs of ``hot_rows`` rows, and those into some of ``COPIES``, dealt out one by one
    and joined to the answers of hot keys. So even rows that are alike in all columns, which no salt
    made of them could tell apart, spread over many tasks; a task that runs again gives the same rows.
    """
    spark = rows.sparkSession
    hot = F.broadcast(hot_keys(counts, key, hot_rows))
    marked = rows.join(hot, F.xxhash64(key) == F.col("hot"), "left")
    columns = [F.col(f"`{c}`") for c in rows.columns]
    cold = marked.filter(F.col("hot").isNull()).select(*columns).join(lookup, key)
    alike = marked.filter(F.col("hot").isNotNull()).groupBy(*columns).agg(F.count(F.lit(1)).alias("_times"))
    runs = alike.withColumn("_run", F.explode(F.sequence(F.lit(0), F.floor((F.col("_times") - 1) / hot_rows))))
    runs = runs.withColumn("_times", F.least(F.lit(hot_rows), F.col("_times") - F.col("_run") * hot_rows))
    runs = runs.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.floor((F.col("_times") - 1) / COPIES))))
    runs = runs.withColumn("_times", F.least(F.lit(COPIES), F.col("_times") - F.col("_copy") * COPIES))
    # Runs are few bytes but many rows: a fixed number of partitions keeps them apart.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = runs.repartition(tasks, F.xxhash64(*columns, "_run", "_copy"))
    answers = lookup.join(hot, F.xxhash64(key) == F.col("hot"), "left_semi")  # one row per hot key
    found = dealt.join(F.broadcast(answers), key).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return cold.unionByName(found.drop("_times", "_run", "_copy"))

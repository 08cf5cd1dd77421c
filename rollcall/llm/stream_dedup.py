"""Exact deduplication of a stream: keyed state on disk, without expiry, and a comparison of full texts on hits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.joins import sized
from rollcall.session import cut_lineage, scratch_path

#: State lives in RocksDB on each executor's disk, with its changes under the checkpoint.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else each partition reserves disk ahead
}
#: Landed bytes that one micro-batch takes in.
BATCH_BYTES = 16 << 30


def normalised(text: Column) -> Column:
    """Every run of ASCII white space as one space; NULL as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def land(docs: DataFrame, path: str, id: str, text: str, digest: Callable[[Column], Column] = sha256) -> None:
    """Store ``docs`` as a landed feed at ``path``: the id, its digest, a locator and the row itself.

    The locator is made when the row is stored and never again, so it names one row even where ids repeat.
    """
    docs.select(
        F.col(id).alias("id"),
        F.monotonically_increasing_id().alias("locator"),
        digest(normalised(F.col(text))).alias("digest"),
        F.struct(*docs.columns).alias("row"),
    ).write.parquet(path)


def first_seen(stream: DataFrame) -> DataFrame:
    """Streaming state of a feed ``(id, locator, digest)``: per digest the first (least) id with its locator, and the rows."""
    at = F.struct(F.col("id").isNull().alias("none"), "id", "locator")
    return stream.groupBy("digest").agg(F.min(at).alias("keep"), F.count(F.lit(1)).alias("n"))


def update_state(spark: SparkSession, feed: str, state: str, schema) -> DataFrame:
    """Run the stream over all that has landed since ``state`` was last brought up to date; the state as rows.

    A query that is started again with the same ``state`` goes on from its checkpoint and takes in new files only.
    """
    before = {k: spark.conf.get(k, None) for k in STATE}
    for key, value in STATE.items():
        spark.conf.set(key, value)
    try:
        stream = spark.readStream.schema(schema).option("maxBytesPerTrigger", str(BATCH_BYTES)).parquet(feed)
        query = (
            first_seen(stream.select("id", "locator", "digest"))
            .writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", state)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return cut_lineage(spark.read.format("statestore").load(state).select("key.digest", "value.*").toDF("digest", "keep", "n"))
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def exact_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """``(id, locator, digest, row, keep_id, group_size, kept)``: ``docs`` as a feed through the stream.

    Texts are equal when their normalised forms are (NULL is empty). Of equal texts the row with the least id
    stays, of repeated ids the first that landed; a NULL id gives way to any other. Rows whose digest another row
    has are compared by their full text: texts that only share a digest are kept apart.
    """
    spark = docs.sparkSession
    feed = scratch_path(spark, "feed")
    land(docs, feed, id, text, digest)
    landed = spark.read.parquet(feed)
    state = update_state(spark, feed, scratch_path(spark, "state"), landed.schema)

    hits = sized(cut_lineage(state.filter("n > 1").select("digest")), 200_000)
    at = F.struct(F.col("id").isNull().alias("none"), "id", "locator")
    full = normalised(F.col(f"row.`{text}`")).alias("full")
    texts = landed.select("id", "locator", "digest", full).join(hits, "digest")
    classes = texts.groupBy("digest", "full").agg(F.min(at).alias("keep"), F.count(F.lit(1)).alias("n"))
    several = classes.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("digest")
    several = cut_lineage(several)
    if not several.isEmpty():
        own = texts.join(classes.join(several, "digest"), ["digest", "full"]).select("locator", "keep", "n")
        apart = cut_lineage(own)
        state = state.join(several, "digest", "left_anti")
        rows = landed.join(state, "digest").select(landed["*"], "keep", "n").unionByName(
            landed.join(apart, "locator").select(landed["*"], "keep", "n")
        )
    else:
        rows = landed.join(sized(cut_lineage(state.filter("n > 1")), 200_000), "digest", "left").select(landed["*"], "keep", "n")
    keep = F.coalesce("keep", F.struct(F.col("id").isNull().alias("none"), "id", "locator"))
    return rows.select(
        "id",
        "locator",
        "digest",
        "row",
        keep["id"].alias("keep_id"),
        F.coalesce("n", F.lit(1)).alias("group_size"),
        (keep["locator"] == F.col("locator")).alias("kept"),
    )


def keep_first(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each text, with the columns of ``docs``."""
    return exact_duplicates(docs, id, text).filter("kept").select("row.*")

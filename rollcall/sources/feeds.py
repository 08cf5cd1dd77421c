"""JSON feeds (group -> list of names), their bad documents, and feeds tagged by address."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from rollcall.functions import feed_json
from rollcall.sources.inline import inline_table

cloudpickle.register_pickle_by_value(feed_json)  # executors need no copy of this package

GROUP = StructType().add("league", StringType()).add("names", ArrayType(StringType()))
READ = StructType().add("reason", StringType()).add("groups", ArrayType(GROUP))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(doc, body)``: each landed file, whole. A document is one row, so one task holds all of it."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("doc"), F.col("value").alias("body")
    )


@F.pandas_udf(READ)
def _read(body: pd.Series) -> pd.DataFrame:
    return pd.DataFrame(list(body.map(feed_json.read_feed)), columns=["reason", "groups"])


def _documents(docs: DataFrame, body: str) -> DataFrame:
    """All columns, and ``_read``; the one-element explode keeps the optimizer from reading a document twice."""
    return docs.select("*", F.explode(F.array(_read(F.col(body)))).alias("_read"))


def explode_feed(docs: DataFrame, body: str = "body") -> DataFrame:
    """``(.., league_ord, league, name_ord, name)`` of every readable document; empty lists give no rows."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c != body]
    groups = _documents(docs, body).select(*kept, F.posexplode("_read.groups").alias("league_ord", "_entry"))
    names = groups.select(
        *kept,
        F.col("league_ord").cast("long").alias("league_ord"),
        F.col("_entry.league").alias("league"),
        F.posexplode("_entry.names").alias("name_ord", "name"),
    )
    return names.withColumn("name_ord", F.col("name_ord").cast("long"))


def quarantine(docs: DataFrame, body: str = "body") -> DataFrame:
    """Documents that cannot be read, with the ``reason``; all others go on without them."""
    read = _documents(docs, body).withColumn("reason", F.col("_read.reason"))
    return read.filter(F.col("reason").isNotNull()).drop("_read")


def slug_of(url: Column) -> Column:
    """First part of the path of an address."""
    return F.regexp_extract(url, r"^[a-z]+://[^/]+/([^/?#]+)", 1)


#: Groups that may be broadcast; more of them are joined by a shuffle.
SMALL_GROUPS = 100_000


def tag_groups(feeds: DataFrame, slugs: dict[str, str] | DataFrame, url: str = "url", small: int = SMALL_GROUPS) -> DataFrame:
    """Add ``slug`` and ``formal_name``; feeds of no listed group go. One frame holds all groups' feeds.

    ``slugs`` is a dict, or a table ``(slug, formal_name)`` with one row per slug, which is counted before it is broadcast.
    """
    if isinstance(slugs, dict):
        columns = {"slug": pa.string(), "formal_name": pa.string()}
        slugs = inline_table(feeds.sparkSession, columns, list(slugs.items()))
    listed = slugs.select("slug", "formal_name")
    if listed.limit(small + 1).count() <= small:
        listed = F.broadcast(listed)
    return feeds.withColumn("slug", slug_of(F.col(url))).join(listed, "slug")


def feed_documents(lists: DataFrame, group: str, keep: list[str], ascii_only: bool = False) -> DataFrame:
    """``(keep, names_json)``: one JSON object ``{group: [names]}`` per row of ``lists``.

    ``ascii_only`` writes other characters as ``\\uXXXX``.
    """
    options = {"writeNonAsciiCharacterAsCodePoint": "true"} if ascii_only else {}
    body = F.to_json(F.create_map(F.col(group), F.col("names")), options)
    return lists.select(*keep, body.alias("names_json"))

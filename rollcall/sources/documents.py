"""One JSON document from many tasks, and a long JSON document read by many tasks.

A document is an object of lists of texts, ``{group: [names]}``. It is never whole in one task: writers put pieces in
order behind each other, and readers take it apart at its commas.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructType

from rollcall.functions import feed_json
from rollcall.operators.ranking import arrival_rank
from rollcall.session import cut_lineage

cloudpickle.register_pickle_by_value(feed_json)  # executors need no copy of this package

#: Commas that one text may hold; a document in which a quote is never closed has more, and is set aside.
MOST_COMMAS = 100_000
#: Elements of a document whose groups are found in one window.
RANGE_BITS = 17
#: Rows that one task sorts or gathers: they are few bytes when shuffled, so adaptive execution would merge them into few tasks.
TASK_ROWS = 100_000
ELEMENT = (
    StructType().add("bad", BooleanType()).add("key", StringType()).add("value", StringType()).add("opens", BooleanType())
    .add("closes", BooleanType()).add("ends", BooleanType())
)


def _inner(column, options) -> F.Column:
    """The JSON of an array without its brackets."""
    text = F.to_json(column, options)
    return F.substring(text, F.lit(2), F.length(text) - 2)


def write_document(lists: DataFrame, path: str, group: str = "league", ascii_only: bool = False) -> None:
    """One JSON document of all ``lists`` (``ordered_lists``; stored), as a folder of part files.

    The files put behind each other in the order of their names are the document, valid as a whole: groups in order, each
    with all its names. A line is a part of a list, so a group of any length is written by many tasks. Files become visible
    when all are written; ``_SUCCESS`` is last. Lists without a group are left out. ``ascii_only`` writes
    other characters as ``\\uXXXX``.
    """
    options = {"writeNonAsciiCharacterAsCodePoint": "true"} if ascii_only else {}
    lists = lists.filter(F.col(group).isNotNull())
    low, high = lists.agg(F.min(group), F.max(group)).first()
    if low is None:
        return lists.sparkSession.range(1).select(F.lit("{}").alias("value")).write.mode("overwrite").text(path)
    last = lists.groupBy(F.col(group).alias("_group")).agg(F.max("part").alias("_last"))
    pieces = lists.join(last, F.col(group) == F.col("_group"))
    first, over = F.col("part") == 0, F.col("part") == F.col("_last")
    text = F.concat(
        F.when(first & (F.col(group) == low), "{").otherwise(""),
        F.when(first, F.concat(_inner(F.array(group), options), F.lit(":["))).otherwise(""),
        _inner(F.col("names"), options),
        F.when(~over, ",").when(F.col(group) == high, "]}").otherwise("],"),
    )
    pieces.select(group, "part", text.alias("value")).orderBy(group, "part").select("value").write.mode("overwrite").text(path)


def dealt(df: DataFrame, rows: int, *by: str) -> DataFrame:
    """``df`` of so many ``rows`` in as many tasks as they need, by the columns ``by``."""
    return df.repartition(max(1, math.ceil(rows / TASK_ROWS)), *by)


def _chunks(spark: SparkSession, path: str, one: bool) -> tuple[DataFrame, int]:
    """``(doc, number, block, n, value, quotes, size)``: what stands between commas, numbered within its block of a file; its rows."""
    read = spark.read.option("lineSep", ",").text(path).select("value", "_metadata", F.monotonically_increasing_id().alias("at"))
    file = F.col("_metadata.file_path")
    number = F.coalesce(F.expr("try_cast(regexp_extract(_metadata.file_name, 'part-([0-9]+)', 1) AS BIGINT)"), F.lit(0).cast("long"))
    bare = F.regexp_replace("value", r"(?s)\\.", "")  # a backslash and what it escapes never lie on two sides of a comma
    chunks = read.select(
        (F.regexp_replace(file, "/[^/]*$", "") if one else file).alias("doc"),
        (number if one else F.lit(0).cast("long")).alias("number"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
        (F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))).alias("quotes"),
        F.col("_metadata.file_size").alias("size"),
        "at",
    )
    chunks = cut_lineage(chunks)
    rows = chunks.count()
    segment = Window.partitionBy("doc", "number", "block").orderBy("at")
    numbered = dealt(chunks, rows, "doc", "number", "block").withColumn("n", F.row_number().over(segment))
    return cut_lineage(numbered.drop("at")), rows


def _elements(chunks: DataFrame, rows: int) -> DataFrame:
    """``chunks`` with ``id``, from 1, of the element of their document to which they belong.

    A comma parts two elements where an even number of quotes stands in front of it. Quotes are summed up within
    a block, and blocks by document; a block's elements are counted for both states it may begin in.
    """
    segment = Window.partitionBy("doc", "number", "block").orderBy("n")
    ahead = segment.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("quotes").over(ahead), F.lit(0)) % 2
    comma = ~((F.col("block") == 0) & (F.col("n") == 1))  # nothing but a file's first chunk has no comma in front
    marked = dealt(chunks, rows, "doc", "number", "block").withColumns({"inside": inside, "comma": comma})
    count = lambda state: F.sum((F.col("comma") & (F.col("inside") == state)).cast("long"))
    blocks = marked.groupBy("doc", "number", "block").agg(F.sum("quotes").alias("q"), count(0).alias("even"), count(1).alias("odd"))
    before = Window.partitionBy("doc").orderBy("number", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = dealt(blocks, rows, "doc").withColumn("state", F.coalesce(F.sum("q").over(before), F.lit(0)) % 2)
    starts = F.when(F.col("state") == 0, F.col("even")).otherwise(F.col("odd"))
    blocks = blocks.withColumn("starts", starts).withColumn("passed", F.coalesce(F.sum("starts").over(before), F.lit(0)))
    joined = marked.join(blocks.select("doc", "number", "block", "state", "passed"), ["doc", "number", "block"])
    begins = F.col("comma") & ((F.col("inside") + F.col("state")) % 2 == 0)
    id = 1 + F.col("passed") + F.sum(begins.cast("long")).over(segment)
    return joined.select("doc", "number", "block", "n", "comma", "value", id.alias("id"))


@F.pandas_udf(ELEMENT)
def _read_element(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([feed_json.read_element(x) for x in text], columns=ELEMENT.names, dtype=object)


def read_long_documents(spark: SparkSession, path: str, one: bool = False) -> tuple[DataFrame, DataFrame]:
    """The names ``(doc, league_ord, league, name_ord, name)`` of JSON documents of any length, and the bad documents ``(doc, reason)``.

    Each file under ``path`` is a document; with ``one``, all part files of a folder together, as ``write_document`` makes
    them, and only if its write has come to its end. The file is split at commas between tasks, quotes are counted in a
    first pass, which tells the commas of the document from those in texts, and places follow from counts. Of a repeated group the
    first place and the last list count. A document that is anything but one object of lists of texts is set aside
    whole, as is one with a text of over ``MOST_COMMAS`` commas. Both frames read stored tables.
    """
    if one:
        done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
            raise FileNotFoundError(f"{path} holds no document that was written to its end")
    chunks, rows = _chunks(spark, path, one)
    # A comma at the very end of a file is in no chunk; the file's length tells it.
    files = chunks.groupBy("doc", "number").agg(F.sum(F.octet_length("value") + F.lit(1).cast("long")).alias("bytes"), F.max("size").alias("size"))
    cut_off = files.filter(F.col("bytes") != F.col("size") + 1).select("doc")
    elements = cut_lineage(_elements(chunks, rows))
    endless = elements.groupBy("doc", "id").agg(F.count("*").alias("k")).filter(F.col("k") > MOST_COMMAS).select("doc")
    early = cut_lineage(cut_off.union(endless).distinct())
    parts = F.array_sort(F.collect_list(F.struct("number", "block", "n", "comma", "value")))
    rest = F.transform(F.expr("slice(parts, 2, size(parts))"), lambda p: F.concat(F.when(p["comma"], ",").otherwise(""), p["value"]))
    whole = dealt(elements.join(early, "doc", "left_anti"), rows, "doc", "id").groupBy("doc", "id").agg(parts.alias("parts"))
    text = F.concat(F.col("parts")[0]["value"], F.array_join(rest, ""))
    read = whole.select("doc", "id", F.explode(F.array(_read_element(text))).alias("e")).select("doc", "id", "e.*")
    read = cut_lineage(read)

    keys = read.filter(F.col("key").isNotNull()).select("doc", "id", F.lit(True).alias("begun"))
    after = read.filter("closes AND NOT ends").select("doc", (F.col("id") + 1).alias("id"), F.lit(True).alias("awaited"))
    odd = keys.filter("id > 1").join(after, ["doc", "id"], "full").filter("begun IS NULL OR awaited IS NULL").select("doc")
    ends = read.groupBy("doc").agg(F.max("id").alias("n"), F.max(F.when(F.col("ends"), F.col("id"))).alias("end"), F.count_if("ends").alias("n_ends"),
        F.count_if("opens").alias("n_opens"), F.count_if(F.col("opens") & (F.col("id") == 1)).alias("opened"))
    unended = ends.filter("end IS NULL OR end <> n OR n_ends <> 1 OR n_opens <> 1 OR opened <> 1").select("doc")
    bad = cut_lineage(early.union(read.filter("bad").select("doc")).union(odd).union(unended).distinct())
    good = read.join(bad, "doc", "left_anti")

    groups = good.filter(F.col("key").isNotNull()).select("doc", "id", F.col("key").alias("league"))
    groups = cut_lineage(arrival_rank(groups, "doc", "id", "place"))
    last = groups.groupBy("doc", "league").agg(F.min("place").alias("place"), F.max("id").alias("list"))
    groups = groups.drop("place").join(last, ["doc", "league"])
    group = F.when(F.col("list").isNotNull(), F.struct("id", "league", "place", (F.col("id") == F.col("list")).alias("counts"))).alias("group")
    span = F.shiftright("id", RANGE_BITS).alias("span")
    named = dealt(good.select("doc", "id", "value"), rows, "doc", "id").join(groups, ["doc", "id"], "left").select("doc", "id", "value", span, group)
    named = cut_lineage(named)
    spans = named.groupBy("doc", "span").agg(F.max("group").alias("own"))
    earlier = Window.partitionBy("doc").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = dealt(spans, rows, "doc").select("doc", "span", F.last("own", ignorenulls=True).over(earlier).alias("carried"))
    here = Window.partitionBy("doc", "span").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    held = dealt(named, rows, "doc", "span").withColumn("here", F.last("group", ignorenulls=True).over(here)).join(spans, ["doc", "span"])
    held = held.withColumn("of", F.coalesce("here", "carried")).filter(F.col("value").isNotNull() & F.col("of.counts"))
    names = held.select(
        "doc", (F.col("of.place") - 1).alias("league_ord"), F.col("of.league").alias("league"), (F.col("id") - F.col("of.id")).alias("name_ord"), F.col("value").alias("name")
    )
    return names, bad.withColumn("reason", F.lit("not one JSON object of lists of texts"))

"""Readers and writers of the layers: Parquet inside, CSV and JSON at the edges."""

from __future__ import annotations

import uuid
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Minimal quoting, doubled quotes, spaces kept; an empty text is told from NULL by its quotes.
CSV = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}
#: Folder of a layer's commits, and versions that stay.
COMMITS, KEPT = "_commits", 2
#: Rows of one exported file; a reader's tasks are as long as that.
FILE_ROWS = 1_000_000


def _folder(spark: SparkSession, path: str):
    """The file system and the Hadoop path of ``path``."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """``(number, folder)`` of the committed versions of the layer at ``path``, oldest first."""
    fs, where = _folder(spark, f"{path}/{COMMITS}")
    if not fs.exists(where):
        return []
    found = []
    for status in fs.listStatus(where):
        stream = fs.open(status.getPath())
        folder = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        if folder:  # a writer that was killed between making the file and filling it has committed nothing
            found.append((int(status.getPath().getName()), f"{path}/{folder}"))
    return sorted(found)


def layer_path(spark: SparkSession, path: str) -> str | None:
    """The folder that holds the layer's rows now: its last committed version."""
    found = versions(spark, path)
    return found[-1][1] if found else None


def read_layer(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The layer at ``path`` as last committed."""
    folder = layer_path(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no committed version of {path}")
    return (spark.read.schema(schema) if schema else spark.read).parquet(folder)


def write_layer(df: DataFrame, path: str, if_any: bool = False, keep: int = KEPT) -> DataFrame:
    """Write the next version of the layer at ``path``, commit it and return it as stored.

    Rows are written once, to a folder of their own, which no reader looks at before its commit: a small file that names
    it, written last. The file's own name is the version's number and can be made only once, so of two writers of one
    version the second fails. A write that fails or is killed leaves the version before in place.
    With ``if_any``, an empty result is not committed if there is an earlier version: that one stays, and is returned.
    ``keep`` versions stay for readers that are under way; of older ones, first the commit goes, then the rows.
    """
    spark = df.sparkSession
    there = versions(spark, path)
    name = f"version-{uuid.uuid4().hex}"
    folder = f"{path}/{name}"
    df.write.parquet(folder)
    stored = spark.read.schema(df.schema).parquet(folder)
    if if_any and there and stored.isEmpty():
        _delete(spark, folder)
        return spark.read.schema(df.schema).parquet(there[-1][1])
    number = there[-1][0] + 1 if there else 1
    fs, mark = _folder(spark, f"{path}/{COMMITS}/{number:09d}")
    try:
        out = fs.create(mark, False)
    except Py4JJavaError as taken:
        _delete(spark, folder)
        raise RuntimeError(f"another writer has made version {number} of {path}") from taken
    out.write(bytearray(name, "ascii"))
    out.close()
    for old, rows in there[: len(there) + 1 - keep]:
        _delete(spark, f"{path}/{COMMITS}/{old:09d}")
        _delete(spark, rows)
    return stored


def write_layer_if_any(df: DataFrame, path: str) -> DataFrame:
    """Replace the layer only when there are rows; the earlier one stays otherwise, and is returned."""
    return write_layer(df, path, if_any=True)


def _delete(spark: SparkSession, path: str) -> None:
    fs, where = _folder(spark, path)
    fs.delete(where, True)


def _put(spark: SparkSession, staged: str, path: str) -> None:
    """Rename ``staged`` to ``path``; what was there is renamed first and deleted last, so rows are lost at no time."""
    fs, target = _folder(spark, path)
    aside = f"{path}.old-{uuid.uuid4().hex}"
    _, old = _folder(spark, aside)
    _, new = _folder(spark, staged)
    there = fs.exists(target)
    if there and not fs.rename(target, old):
        raise OSError(f"cannot rename {path}")
    if not fs.rename(new, target):
        if there:
            fs.rename(old, target)
        raise OSError(f"cannot rename {staged}")
    if there:
        fs.delete(old, True)


def export_csv(df: DataFrame, path: str, order: tuple[str, ...] = (), drop: tuple[str, ...] = ()) -> None:
    """Replace the CSV export at ``path``, rows in ``order``, without the ``drop`` columns.

    It is written beside the old one and takes its place when it is complete; a write that fails leaves the old one.
    """
    if order:
        df = df.orderBy(*order)
    path = path.rstrip("/")
    staged = f"{path}.new-{uuid.uuid4().hex}"
    try:
        df.drop(*drop).write.option("maxRecordsPerFile", FILE_ROWS).options(**CSV).csv(staged)
        _put(df.sparkSession, staged, path)
    finally:
        _delete(df.sparkSession, staged)


def read_csv(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame:
    """Read a CSV export. Texts may hold line breaks, so a file is not split between tasks; exports
    keep their files short. ``multi_line=False`` splits files, for texts without line breaks.
    """
    return spark.read.schema(schema).options(**CSV, multiLine=multi_line).csv(path)


def export_if_any(df: DataFrame, path: str, clear_when_empty: bool = False, **layout) -> bool:
    """Replace the export only when there are rows: an earlier one stays otherwise.

    ``clear_when_empty`` replaces it by an empty one instead.
    """
    some = not df.isEmpty()
    if some or clear_when_empty:
        export_csv(df, path, **layout)
    return some


def snapshot_path(base: str, prefix: str, as_of: datetime) -> str:
    return f"{base.rstrip('/')}/{prefix}_{as_of:%d%m%Y_%H%M}.csv"


def export_snapshot(df: DataFrame, base: str, prefix: str, as_of: datetime, **layout) -> str:
    """Write a CSV snapshot named after ``as_of``; only one of the same minute is replaced."""
    path = snapshot_path(base, prefix, as_of)
    export_csv(df, path, **layout)
    return path


def land_raw(docs: DataFrame, path: str) -> None:
    """Store documents as they came; nothing parses them."""
    docs.write.mode("overwrite").parquet(path)


def write_feed(lists: DataFrame, path: str, group: str = "league", ascii_only: bool = False) -> None:
    """One line per list: a JSON object of the group, the part, the place of its first name and the names.

    ``lists`` is what ``ordered_lists`` gives. However many parts a group has, the files are
    as many as the tasks that write them. ``ascii_only`` writes other characters as ``\\uXXXX``.
    """
    options = {"writeNonAsciiCharacterAsCodePoint": "true"} if ascii_only else {}
    line = F.to_json(F.struct(F.col(group).alias("group"), "part", "start", "names"), options)
    lists.select(line.alias("value")).write.mode("overwrite").text(path)


def read_feed(spark: SparkSession, path: str, group: str = "league") -> DataFrame:
    """``(group, name_ord, name)`` of a feed stored by ``write_feed``; ``name_ord`` counts through all parts from 0."""
    schema = "group string, part long, start long, names array<string>"
    lines = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    names = lines.select(F.col("group").alias(group), "start", F.posexplode("names").alias("pos", "name"))
    return names.select(group, (F.col("start") + F.col("pos")).alias("name_ord"), "name")

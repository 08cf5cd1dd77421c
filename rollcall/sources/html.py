"""HTML tables as arrays of rows.

A page stays one row until its cells are exploded, so taking a table apart, and choosing a column of it,
needs no shuffle. Pages reach the tokenizer in Arrow batches; everything after it is built-in expressions.
"""

from __future__ import annotations

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructType

from rollcall.functions import markup

cloudpickle.register_pickle_by_value(markup)  # executors need no copy of this package

ROWS = ArrayType(StructType().add("head", BooleanType()).add("cells", ArrayType(StringType())))


PAGE = StructType().add("reason", StringType()).add("tables", ArrayType(ROWS))


@F.pandas_udf(PAGE)
def read_page(html: pd.Series) -> pd.DataFrame:
    """``(reason, tables)`` of each page: its tables, or why it is set aside. A page that fails fails alone."""
    return pd.DataFrame([markup.read_page(x) for x in html], columns=["reason", "tables"], dtype=object)


def tables(html: Column) -> Column:
    """Every table of a page, outside comments, scripts and styles; nested ones after the table that holds them.

    NULL for a page that is set aside.
    """
    return read_page(html).getField("tables")


def first_table_rows(html: Column) -> Column:
    """Rows of the first table; NULL for a page without one."""
    return F.get(tables(html), F.lit(0))


def data_cells(rows: Column) -> Column:
    """The cells of the rows that are no header, as ``array<array<string>>``."""
    return F.transform(F.filter(rows, lambda r: ~r.head), lambda r: r.cells)


def table_cells(pages: DataFrame, doc: str, html: str, first_only: bool = False) -> DataFrame:
    """``(doc, table_idx, ro, co, head, cell)``, one row per cell, header rows included."""
    found = tables(F.col(html))
    if first_only:
        found = F.slice(found, 1, 1)
    in_tables = pages.select(doc, F.posexplode(found).alias("table_idx", "_table"))
    in_rows = in_tables.select(doc, "table_idx", F.posexplode("_table").alias("ro", "_row"))
    cells = in_rows.select(
        doc, "table_idx", "ro", F.col("_row.head").alias("head"), F.posexplode("_row.cells").alias("co", "cell")
    )
    places = {c: F.col(c).cast("long") for c in ("table_idx", "ro", "co")}
    return cells.withColumns(places).select(doc, "table_idx", "ro", "co", "head", "cell")


def probed_column(pages: DataFrame, html: str, probe, keep: list[str]) -> DataFrame:
    """``keep`` plus ``reason`` (NULL, or why the page is set aside), ``rows`` and ``col``, the probed column.

    ``rows`` are the data cells of the first table, NULL without a table. The one-element explode keeps the
    optimizer from taking the page apart again wherever it is used.
    """
    taken = pages.select(*keep, F.explode(F.array(read_page(F.col(html)))).alias("_page"))
    rows = data_cells(F.get("_page.tables", F.lit(0)))
    found = taken.select(*keep, F.col("_page.reason").alias("reason"), rows.alias("rows"))
    return found.withColumn("col", probe(F.col("rows")).cast("long"))


def column_names(probed: DataFrame, keep: list[str], out: str = "cell", ord: str = "ord") -> DataFrame:
    """Explode only the probed column: ``keep``, the row number in ``ord`` and the cell in ``out``."""
    cells = F.transform("rows", lambda row: F.get(row, F.col("col").cast("int")))
    listed = probed.select(*keep, F.posexplode(F.when(F.col("col").isNotNull(), cells)).alias(ord, out))
    return listed.withColumn(ord, F.col(ord).cast("long"))


def unreadable(probed: DataFrame, keep: list[str], column_needed: bool = False) -> DataFrame:
    """``keep`` and the reason, for pages that give no feed at all; the others go on without them.

    A table without a fitting column is an empty feed, unless ``column_needed``.
    """
    why = F.when(F.col("reason").isNotNull(), F.col("reason")).when(F.col("rows").isNull(), "no table")
    if column_needed:
        why = why.when(F.col("col").isNull(), "no such column")
    return probed.withColumn("reason", why).filter(F.col("reason").isNotNull()).select(*keep, "reason")

"""Joins of whole documents with small results about them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.session import cut_lineage

#: Rows of one or two fixed-width columns that may be broadcast: some 32 MB in an executor.
BROADCAST_ROWS = 1_000_000


def sized(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``table`` (narrow, stored), marked for broadcast if it is counted to hold ``rows`` rows or fewer."""
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


def drop_ids(docs: DataFrame, gone: DataFrame, id: str) -> DataFrame:
    """``docs`` without the rows whose ``id`` is in ``gone``; rows without an id stay."""
    return docs.join(sized(cut_lineage(gone.select(id).distinct())), id, "left_anti").select(*docs.columns)

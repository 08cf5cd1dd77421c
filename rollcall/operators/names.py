"""From table cells to clean, de-duplicated names, and the counts of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions.text import clean_cell, usable_name
from rollcall.operators.ranking import first_k


def clean_names(
    cells: DataFrame,
    cell: str = "cell",
    marker: str = "Form:",
    longer_than: int = 2,
    stop: tuple[str, ...] = ("Team", "nan"),
    out: str = "name",
) -> DataFrame:
    """Replace ``cell`` by the bare name; rows without a usable name go.

    Name and test share one pass: as a filter over a computed column, Spark would
    work the name out once for each mention in the test and again for the output.
    """
    usable = F.filter(
        F.array(clean_cell(F.col(cell), marker)), lambda name: usable_name(name, longer_than, stop)
    )
    kept = [F.col(f"`{c}`") for c in cells.columns if c not in (cell, out)]
    return cells.select(*kept, F.explode(usable).alias(out))


def dedup_ordered(
    names: DataFrame, group: str = "league", name: str = "name", ord: str = "ord", within: str | None = None
) -> DataFrame:
    """One row per name and group, with the place of its first occurrence.

    Places may have two parts, ``ord`` and then ``within``: a page, and a row of it. They stay two
    columns, ``first_ord`` and ``first_within``, so neither has to fit beside the other.
    """
    if within is None:
        return names.groupBy(group, name).agg(F.min(ord).alias("first_ord"))
    first = F.min(F.struct(F.col(ord).alias("o"), F.col(within).alias("w"))).alias("first")
    found = names.groupBy(group, name).agg(first)
    return found.select(group, name, F.col("first.o").alias("first_ord"), F.col("first.w").alias("first_within"))


def clean_feed(
    cells: DataFrame, group: str = "league", ord: str = "ord", limit: int | None = None, within: str | None = None, **cleaning
) -> DataFrame:
    """``(group, name, first_ord[, first_within])``: cleaned and de-duplicated; ``limit`` keeps the first of each group."""
    names = dedup_ordered(clean_names(cells, **cleaning), group, ord=ord, within=within)
    if limit is None:
        return names
    return first_k(names, group, "first_ord", limit, within="first_within" if within else None).drop("rn")


def first_column_where(rows: Column, found) -> Column:
    """Index of the leftmost column of ``rows`` (array of cell arrays) with a cell for which ``found`` holds."""
    width = F.array_max(F.transform(rows, F.size))
    columns = F.when(width > 0, F.sequence(F.lit(0), width - 1))
    hit = F.filter(columns, lambda i: F.exists(rows, lambda row: F.coalesce(found(F.get(row, i)), F.lit(False))))
    return F.get(hit, F.lit(0)).cast("long")


def probe_longer(rows: Column, longer_than: int = 3) -> Column:
    """Leftmost column with any text longer than ``longer_than``; NULL when there is none."""
    return first_column_where(rows, lambda cell: F.length(cell) > longer_than)


def probe_contains(rows: Column, needles: list[str]) -> Column:
    """Leftmost column with any cell that contains a needle; else the third, else the second column.

    NULL when the table has no second column to fall back on.
    """

    def found(cell: Column) -> Column:
        hit = F.lit(False)
        for needle in needles:
            hit = hit | cell.contains(needle)
        return hit

    width = F.array_max(F.transform(rows, F.size))
    fallback = F.when(width > 2, F.lit(2)).when(width > 1, F.lit(1)).cast("long")
    return F.coalesce(first_column_where(rows, found), fallback)


def run_metrics(
    cleaned: DataFrame, deduped: DataFrame, review: DataFrame, group: str = "league", groups: DataFrame | None = None
) -> DataFrame:
    """Rows per group before and after de-duplication, and rows to review.

    ``groups`` are all groups that were read: those without a usable name count 0. Without it, groups are those of ``cleaned``.
    """

    def counted(df: DataFrame, column: str) -> DataFrame:
        return df.groupBy(group).agg(F.count(F.lit(1)).alias(column))

    joined = counted(cleaned, "n_before")
    if groups is not None:
        joined = groups.select(group).filter(F.col(group).isNotNull()).distinct().join(joined, group, "left")
    for table, column in ((deduped, "n_after"), (review, "n_review")):
        joined = joined.join(counted(table, column), group, "left")
    return joined.select(group, *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_before", "n_after", "n_review")))

"""Order of arrival: ranks, first-k and ordered lists that never gather a whole group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGE_BITS = 21
LIST_ROWS = 100_000
WINDOW_ROWS = 100


def _before(*by: str):
    return Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)


def _starts(counted: DataFrame, group: str, bits: int) -> DataFrame:
    """``(group, _far, _near, _start)`` from ``(group, _far, _near, _n)``: rows of the group in front of each range."""
    far = counted.groupBy(group, "_far").agg(F.sum("_n").alias("_n"))
    far = far.select(group, "_far", F.coalesce(F.sum("_n").over(_before(group, "_far")), F.lit(0)).alias("_before_far"))
    near = counted.withColumn("_before_near", F.coalesce(F.sum("_n").over(_before(group, "_far", "_near")), F.lit(0)))
    start = F.col("_before_far") + F.col("_before_near")
    return near.join(far, [group, "_far"]).select(group, "_far", "_near", start.alias("_start"))


def arrival_rank(
    df: DataFrame, group: str, ord: str, out: str = "rank", bits: int = RANGE_BITS, within: str | None = None
) -> DataFrame:
    """``df`` plus the 1-based position of each row in its group, by ``ord`` (bigint) and then ``within``.

    A plain ``row_number`` would sort a group that holds a third of all rows in one task. Here ``ord`` is cut into
    ranges of 2^bits values, and those again: ranges are counted, the counts summed up in front of each
    range, and rows numbered within their range only. Without ``within``, ``ord`` is unique in a group and
    no window sees more than 2^bits rows. With it, rows are numbered within one value of ``ord`` (a page), and
    the windows in front see a row per value. Ties are broken by the other columns, so a task that runs again numbers rows alike.
    """
    ranged = df.filter(F.col(group).isNotNull()).withColumns(
        {"_far": F.shiftright(ord, 2 * bits), "_near": F.shiftright(ord, bits)}
    )
    by = [group, "_far", "_near"]
    rest = [F.col(f"`{c}`") for c in df.columns if c not in (group, ord, within)]
    if within is None:
        start = _starts(ranged.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")), group, bits)
        place = F.row_number().over(Window.partitionBy(*by).orderBy(ord, *rest))
    else:
        each = ranged.groupBy(*by, ord).agg(F.count(F.lit(1)).alias("_n"))
        start = _starts(each.groupBy(*by).agg(F.sum("_n").alias("_n")), group, bits)
        ahead = F.coalesce(F.sum("_n").over(_before(*by, ord)), F.lit(0))
        start = each.withColumn("_ahead", ahead).join(start, by)
        by = [*by, ord]
        start = start.select(*by, (F.col("_start") + F.col("_ahead")).alias("_start"))
        place = F.row_number().over(Window.partitionBy(*by).orderBy(within, *rest))
    numbered = ranged.withColumn("_within", place).join(start, by)
    return numbered.select(*df.columns, (F.col("_start") + F.col("_within")).cast("long").alias(out))


def gold_ranking(
    resolved: DataFrame, season: int, group: str = "league", ord: str = "name_ord", within: str | None = None
) -> DataFrame:
    """Ranking by arrival per group. UNKNOWN rows and repeated names are ranked like all others."""
    columns = ["standard_name", group, ord, *([within] if within else [])]
    ranked = arrival_rank(resolved.select(*columns), group, ord, "Positions", within=within)
    return ranked.select(
        F.col("standard_name").alias("ClubName"),
        F.col(group).alias("League"),
        F.lit(season).cast("int").alias("Season Year"),
        "Positions",
    )


def first_k(
    df: DataFrame, group: str, ord: str, k: int = 20, out: str = "rn", within: str | None = None
) -> DataFrame:
    """The first ``k`` rows of each group.

    For a small ``k`` Spark keeps ``k`` rows per group and task before it shuffles. Many
    tasks times a large ``k`` would be too many for the one task that ends the group.
    """
    if k > WINDOW_ROWS:
        return arrival_rank(df, group, ord, out, within=within).filter(F.col(out) <= k)
    rest = [F.col(f"`{c}`") for c in df.columns if c not in (group, ord, within)]
    place = F.row_number().over(Window.partitionBy(group).orderBy(ord, *([within] if within else []), *rest))
    return df.withColumn(out, place).filter(F.col(out) <= k).withColumn(out, F.col(out).cast("long"))


def ordered_lists(
    df: DataFrame, group: str, name: str, ord: str, list_rows: int = LIST_ROWS, groups: DataFrame | None = None
) -> DataFrame:
    """``(group, part, start, names)``: names in order; a longer list goes on in parts 1, 2, .. of ``list_rows`` names.

    ``start`` is the place, from 0, of a part's first name in the whole list.

    ``groups`` are all groups that were read: those without a name get an empty list.
    """
    ranked = arrival_rank(df.select(group, name, ord), group, ord, "_rank")
    part = F.floor((F.col("_rank") - 1) / list_rows).cast("long")
    listed = ranked.groupBy(F.col(group), part.alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("_rank", F.col(name).alias("_name")))).alias("listed")
    )
    names = F.col("listed._name").alias("names")
    lists = listed.select(group, "part", (F.col("part") * list_rows).alias("start"), names)
    if groups is None:
        return lists
    without = groups.select(group).distinct().join(df.select(group).distinct(), group, "left_anti")
    zero = F.lit(0).cast("long")
    empty = without.select(group, zero.alias("part"), zero.alias("start"), F.array().cast("array<string>").alias("names"))
    return lists.unionByName(empty)

"""The whole flow: landed pages -> names -> resolved master -> review log and ranking."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.operators.dictionary import unnamed
from rollcall.operators.names import clean_names, dedup_ordered, probe_longer, run_metrics
from rollcall.operators.ranking import first_k, gold_ranking
from rollcall.operators.resolve import master, resolve, review
from rollcall.session import cut_lineage, drop_path, scratch_path
from rollcall.sources.html import column_names, probed_column, unreadable
from rollcall.sources.sinks import export_csv, export_if_any, export_snapshot, layer_path, write_layer, write_layer_if_any

ARRIVAL = ("first_ord", "first_within")


def page_names(probed: DataFrame, group: str, ord: str) -> DataFrame:
    """Cleaned names of the probed columns, with the page in ``ord`` and the row of its table in ``_row``."""
    cells = column_names(probed, [group, ord], "cell", "_row")
    return clean_names(cells.withColumn(ord, F.col(ord).cast("long")))


def bronze(pages: DataFrame, group: str, ord: str, html: str = "html", probe=probe_longer, limit=None) -> DataFrame:
    """Names of the probed column of each page's first table, cleaned and de-duplicated.

    ``ord`` numbers the pages of a group, by any bigint; a name's place is (page, row of its table).
    """
    names = page_names(probed_column(pages, html, probe, [group, ord]), group, ord)
    first = dedup_ordered(names, group, ord=ord, within="_row")
    return first if limit is None else first_k(first, group, "first_ord", limit, within="first_within").drop("rn")


def medallion(pages: DataFrame, dictionary: DataFrame, group: str, ord: str, season: int, **options) -> DataFrame:
    """The ranking; the layers in between are stored once in the shared scratch folder."""
    names = cut_lineage(bronze(pages, group, ord))
    silver = cut_lineage(resolve(names, dictionary, **options))
    return gold_ranking(silver, season, group, *ARRIVAL)


def run(
    pages: DataFrame,
    dictionary: DataFrame,
    base: str,
    as_of: datetime,
    season: int,
    group: str,
    ord: str,
    keep_answers: bool = False,
    **options,
) -> dict[str, str]:
    """Run and store every stage under ``base``; a failing stage raises and the later ones do not run.

    Pages are taken apart once and kept in the shared folder until the run ends. Pages without a table and dictionary
    entries without a name are stored beside their layer. When no page gives a name, the
    names of the run before stay, and the later stages work on them. ``metrics`` holds the counts of the run by group.
    ``keep_answers`` keeps the best matches under ``base`` for the next run, which compares only what is new to it.
    Each layer changes by a commit, so whenever a run is broken off, every layer can be read as one run left it. The
    paths returned are those of the versions committed; ``read_layer`` finds the last one under ``base``.
    """
    spark = pages.sparkSession
    scratch = scratch_path(spark, "probed")
    at = {k: f"{base}/{k}" for k in ("bronze/names", "bronze/quarantine", "silver/master", "silver/unnamed", "metrics")}
    if keep_answers:
        options["answers"] = f"{base}/silver/answers"
    try:
        probed_column(pages, "html", probe_longer, [group, ord]).write.parquet(scratch)
        probed = spark.read.parquet(scratch)
        write_layer(unreadable(probed, [group, ord]), at["bronze/quarantine"])
        write_layer(unnamed(dictionary), at["silver/unnamed"])
        cleaned = page_names(probed, group, ord)
        names = write_layer_if_any(dedup_ordered(cleaned, group, ord=ord, within="_row"), at["bronze/names"])
        silver = write_layer(resolve(names, dictionary, **options), at["silver/master"])
        arrival = {"order": (group, *ARRIVAL), "drop": ARRIVAL}
        export_csv(master(silver, group=group, keep=ARRIVAL), f"{base}/silver/master_csv", **arrival)
        export_if_any(review(silver, group=group, keep=ARRIVAL), f"{base}/silver/review_csv", **arrival)
        write_layer(run_metrics(cleaned, names, review(silver, group=group), group, groups=probed), at["metrics"])
        gold = gold_ranking(silver, season, group, *ARRIVAL)
        snapshot = export_snapshot(gold, f"{base}/gold", "ranking", as_of, order=("League", "Positions"))
    finally:
        drop_path(spark, scratch)
    now = {name: layer_path(spark, path) for name, path in at.items()}
    return {
        "bronze": now["bronze/names"],
        "quarantine": now["bronze/quarantine"],
        "silver": now["silver/master"],
        "unnamed": now["silver/unnamed"],
        "metrics": now["metrics"],
        "gold": snapshot,
    }

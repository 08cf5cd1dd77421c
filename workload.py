"""Inputs derived from the given tables, and the registered queries over them."""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.functions.text import normalise, snapshot_stamp, token_key
from rollcall.operators.dictionary import flatten_aliases
from rollcall.operators.fuzzy import best_match, gate, score, similarity
from rollcall.operators.names import (
    clean_names,
    dedup_ordered,
    probe_contains,
    probe_longer,
    run_metrics,
)
from rollcall.operators.ranking import first_k, gold_ranking, ordered_lists
from rollcall.operators.resolve import master, match_exact, missed_keys, resolve, review
from rollcall.plans.medallion import medallion, run
from rollcall.session import cut_lineage, scratch_path
from rollcall.sources.documents import dealt, read_long_documents, write_document
from rollcall.sources.feeds import (
    explode_feed,
    feed_documents,
    quarantine,
    tag_groups,
)
from rollcall.sources.html import first_table_rows, probed_column, table_cells, unreadable
from rollcall.sources.inline import inline_table
from rollcall.sources.sinks import (
    export_csv,
    export_if_any,
    export_snapshot,
    land_raw,
    read_csv,
    read_feed,
    write_feed,
)

SEASON = 2025
AS_OF = datetime(2026, 1, 2, 3, 4)
LIST_ROWS = 100
SLUGS = {"en": "English pages", "fr": "French pages", "de": "German pages", "es": "Spanish pages"}

# Eight kinds of noise on the part names; the same text runs in both engines.
NOISE = """CASE p_partkey % 8
  WHEN 0 THEN p_name
  WHEN 1 THEN concat(CAST(p_partkey % 24 + 1 AS STRING), p_name)
  WHEN 2 THEN concat(p_name, 'Form:WWDLW')
  WHEN 3 THEN concat(chr(160), ' ', p_name, ' ')
  WHEN 4 THEN upper(p_name)
  WHEN 5 THEN substr(p_name, 2)
  WHEN 6 THEN concat(p_brand, ' ', p_name)
  ELSE CASE WHEN p_partkey % 16 = 7 THEN 'Team' END
END"""


# Customers' texts in the manner of the parts': words, a brand and the number.
CUSTOMER_TEXT = """concat(
  CASE c_custkey % 5 WHEN 0 THEN 'small' WHEN 1 THEN 'red' WHEN 2 THEN 'blue' WHEN 3 THEN 'old' ELSE 'green' END, ' ',
  CASE c_custkey % 4 WHEN 0 THEN 'gizmo' WHEN 1 THEN 'widget' WHEN 2 THEN 'bolt' ELSE 'gear' END,
  ' Brand#', CAST(c_custkey % 25 + 10 AS STRING), ' ', CAST(c_custkey AS STRING))"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- derived inputs -------------------------------------------------------


def feed(spark, sf_dir):
    """Noisy names: ``(league, ord, cell)``."""
    return table(spark, sf_dir, "part").selectExpr("p_type AS league", "p_partkey AS ord", f"{NOISE} AS cell")


def club(spark, sf_dir):
    """Dictionary: one entry per part name; names ending in gizmo have no alias."""
    names = table(spark, sf_dir, "part").groupBy("p_name").agg(F.min("p_partkey").alias("ord"))
    return names.selectExpr(
        "ord",
        "concat(p_name, ' co') AS standard_name",
        "CASE WHEN p_name LIKE '%gizmo' THEN CAST(array() AS ARRAY<STRING>) "
        "ELSE array(p_name, upper(p_name), p_name) END AS aliases",
    )


def html_docs(spark, sf_dir):
    """Pages with a generated table, about fifty rows each, in three layouts."""
    cell = F.replace(F.replace(F.coalesce(F.expr(NOISE), F.lit("")), F.lit("#"), F.lit("&#35;")), F.lit("\xa0"), F.lit("&nbsp;"))
    parts = table(spark, sf_dir, "part").select(
        F.col("p_type").alias("league"),
        F.expr("p_partkey div 300").alias("doc"),
        "p_partkey",
        (F.col("p_partkey") % 1000).cast("string").alias("pos"),
        cell.alias("cell"),
    )
    # Layout 0: name, position. 1: position, name, form. 2: as 0 the other way round, end tags left out.
    layout = F.expr("doc % 3")
    row = (
        F.when(layout == 0, F.concat(F.lit("<tr><td>"), "cell", F.lit("</td><td>"), "pos", F.lit("</td></tr>")))
        .when(
            layout == 1,
            F.concat(F.lit("<TR class='r'><TD>"), "pos", F.lit("</TD><td><b>"), "cell", F.lit("</b></td><td>WDL</td></TR>\n")),
        )
        .otherwise(F.concat(F.lit("<tr><td>"), "pos", F.lit("<td>"), "cell"))
    )
    body = F.array_sort(F.collect_list(F.struct("p_partkey", row.alias("tr"))))
    pages = parts.groupBy("league", "doc").agg(body.alias("body"))
    return pages.select(
        "league",
        "doc",
        F.concat(
            F.lit("<html><!-- <table><tr><td>old names</td></tr></table> --><table id='x'><tr><th>Pos</th><th>Team</th></tr>"),
            F.array_join("body.tr", ""),
            F.lit("</table><table><tr><td>another table</td></tr></table></html>"),
        ).alias("html"),
    )


def pages_tables(spark, sf_dir):
    """The given pages with their lists rewritten as tables."""
    html = F.col("html")
    for old, new in (("<ul>", "<table>"), ("</ul>", "</table>"), ("<li>", "<tr><td>"), ("</li>", "</td></tr>")):
        html = F.replace(html, F.lit(old), F.lit(new))
    return table(spark, sf_dir, "pages").select("page_id", html.alias("html"))


def cleaned(spark, sf_dir):
    return clean_names(feed(spark, sf_dir))


def deduped(spark, sf_dir):
    return dedup_ordered(cleaned(spark, sf_dir))


def misses(spark, sf_dir):
    tagged = match_exact(deduped(spark, sf_dir), club(spark, sf_dir))
    return tagged.filter(F.col("score").isNull())


def best_of_misses(spark, sf_dir):
    """Each missed name with its best match and that match's integer score."""
    names = cut_lineage(misses(spark, sf_dir).select("name").distinct())
    keys = missed_keys(names).select("key")
    best = best_match(keys, club(spark, sf_dir))
    keyed = names.withColumn("key", token_key(F.col("name")))
    return keyed.join(best, "key").select("name", "best", score(F.col("sim")).alias("score"))


def silver(spark, sf_dir):
    return resolve(cut_lineage(deduped(spark, sf_dir)), club(spark, sf_dir))


# ---- registered queries ---------------------------------------------------


def json_feed_explode(spark, sf_dir):
    """Landed JSON documents, one per hundred parts, back to ordered names."""
    names = cleaned(spark, sf_dir).withColumn("doc", F.expr("ord div 100"))
    lists = names.groupBy("doc", "league").agg(F.array_sort(F.collect_list(F.struct("ord", "name"))).alias("l"))
    entries = F.array_sort(F.collect_list(F.struct("league", F.col("l.name").alias("names"))))
    docs = lists.groupBy("doc").agg(F.to_json(F.map_from_entries(entries)).alias("body"))
    return explode_feed(docs)


def names_to_json(spark, sf_dir):
    """One document per league and hundred names; a league of stop words only keeps an empty list."""
    read = feed(spark, sf_dir).withColumn("league", F.expr("CASE WHEN cell = 'Team' THEN 'BLANK' ELSE league END"))
    names = cut_lineage(dedup_ordered(clean_names(read)))
    lists = ordered_lists(names, "league", "name", "first_ord", LIST_ROWS, groups=read)
    return feed_documents(lists, "league", ["league", "part"])


def json_feed_roundtrip(spark, sf_dir):
    """Write the feed with escaped characters and read it back, each name in its place."""
    lists = ordered_lists(cut_lineage(deduped(spark, sf_dir)), "league", "name", "first_ord", LIST_ROWS)
    path = scratch_path(spark, "feed")
    write_feed(lists, path, "league", ascii_only=True)
    return read_feed(spark, path)


def json_documents_read(spark, sf_dir):
    """All leagues as one JSON document, written by many tasks in parts of a hundred names and read by many."""
    lists = ordered_lists(cut_lineage(deduped(spark, sf_dir)), "league", "name", "first_ord", LIST_ROWS)
    path = scratch_path(spark, "document")
    write_document(cut_lineage(lists), path)
    names, _ = read_long_documents(spark, path, one=True)
    return names.select("league", "name_ord", "name")


def json_long_quarantine(spark, sf_dir):
    """Landed files, one per hundred parts, taken apart at their commas; one in five is cut off or goes on behind its end."""
    names = dealt(cleaned(spark, sf_dir).withColumn("doc", F.expr("ord div 100")), table(spark, sf_dir, "part").count(), "doc")
    lists = names.groupBy("doc", "league").agg(F.array_sort(F.collect_list(F.struct("ord", "name"))).alias("l"))
    entries = F.array_sort(F.collect_list(F.struct("league", F.col("l.name").alias("names"))))
    body = F.to_json(F.map_from_entries(entries))
    way = F.col("doc") % 10
    docs = lists.groupBy("doc").agg(body.alias("body")).withColumn(
        "body", F.when(way == 3, F.expr("left(body, length(body) - 2)")).when(way == 7, F.concat("body", F.lit("[]"))).otherwise(F.col("body"))
    )
    path = scratch_path(spark, "documents")
    docs.write.partitionBy("doc").text(path)
    names, bad = read_long_documents(spark, path)
    of = F.regexp_extract("doc", "doc=([0-9]+)", 1).cast("long").alias("doc")
    read = names.groupBy(of).agg(F.count(F.lit(1)).alias("n_names"), F.max("league_ord").alias("last_league"))
    none = F.lit(None).cast("long")
    aside = bad.select(of, none.alias("n_names"), none.alias("last_league"), "reason")
    return read.withColumn("reason", F.lit(None).cast("string")).unionByName(aside)


def feed_tag_league(spark, sf_dir):
    tagged = tag_groups(table(spark, sf_dir, "pages").select("url"), SLUGS)
    key = F.format_string("raw/%s/table", "slug").alias("landing_key")
    return tagged.groupBy("slug", "formal_name", key).agg(F.count(F.lit(1)).alias("n"))


def alias_exact(spark, sf_dir):
    return match_exact(deduped(spark, sf_dir), club(spark, sf_dir)).drop("first_ord")


def alias_beyond_broadcast(spark, sf_dir):
    """As ``alias_exact``, with aliases that are taken to be too many for a broadcast."""
    found = match_exact(cut_lineage(deduped(spark, sf_dir)), club(spark, sf_dir), broadcast_bytes=0)
    return found.drop("first_ord")


def resolve_hot(spark, sf_dir):
    """Every cleaned name resolved by shuffles; rows are alike but for league and name, and a name is hot from six on."""
    names = cut_lineage(cleaned(spark, sf_dir).select("league", "name"))
    return resolve(names, club(spark, sf_dir), broadcast_bytes=0, hot_rows=5)


def fuzzy_blocks(spark, sf_dir):
    """Every customer's name and address-book entry against all parts' texts, by blocks."""
    parts = table(spark, sf_dir, "part").groupBy(F.concat_ws(" ", "p_name", "p_brand", "p_partkey").alias("standard_name"))
    dictionary = parts.agg(F.min("p_partkey").alias("ord")).withColumn("aliases", F.array().cast("array<string>"))
    names = table(spark, sf_dir, "customer").selectExpr("c_custkey", f"{CUSTOMER_TEXT} AS name")
    found = resolve(cut_lineage(names), cut_lineage(dictionary), broadcast_bytes=0, small_rows=0)
    return found.select("c_custkey", "name", "standard_name", "match_confidence")


def alias_miss(spark, sf_dir):
    return misses(spark, sf_dir).select("name").distinct()


def normalise_names(spark, sf_dir):
    """Cleaned feed names and the titles of all pages."""
    title = F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)
    titles = table(spark, sf_dir, "pages").select(title.alias("name"))
    names = cleaned(spark, sf_dir).select("name").unionByName(titles).distinct()
    return names.select("name", normalise(F.col("name")).alias("norm"), token_key(F.col("name")).alias("token_key"))


def token_sort_ratio(spark, sf_dir):
    """Each cleaned name against the canonical name of its own part."""
    own = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS ord", "concat(p_name, ' co') AS standard_name", f"{NOISE} AS cell"
    )
    named = clean_names(own)
    return named.select("ord", "name", "standard_name", score(similarity(F.col("name"), F.col("standard_name"))).alias("score"))


def fuzzy_best(spark, sf_dir):
    return best_of_misses(spark, sf_dir)


def fuzzy_entities(spark, sf_dir):
    """Every customer resolved against the suppliers' names, written as customers' are."""
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS ord",
        "replace(s_name, 'Supplier', 'Customer') AS standard_name",
        "CAST(array() AS ARRAY<STRING>) AS aliases",
    )
    names = table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_name AS name")
    found = resolve(names, suppliers)
    return found.select("c_custkey", "name", "standard_name", "match_confidence")


def match_gate(spark, sf_dir):
    best = best_of_misses(spark, sf_dir)
    return best.select("name", gate(F.col("best"), F.col("score")).alias("standard_name"), "score")


def kept_answers(spark, sf_dir):
    """The master table of a second run, after a first one with a dictionary that lacked a third of the entries and had others."""
    path, names, whole = scratch_path(spark, "answers"), cut_lineage(deduped(spark, sf_dir)), cut_lineage(club(spark, sf_dir))
    others = whole.filter("ord % 3 = 0").selectExpr("ord + 1 AS ord", "concat('old ', standard_name) AS standard_name", "aliases")
    resolve(names.filter("first_ord % 4 <> 0"), whole.filter("ord % 3 <> 0").unionByName(others), answers=path)
    return master(resolve(names, whole, answers=path))


def gold(spark, sf_dir):
    return gold_ranking(cut_lineage(silver(spark, sf_dir)), SEASON, ord="first_ord")


def gold_snapshot(spark, sf_dir):
    """Write the ranking as a stamped snapshot and count what was stored."""
    path = export_snapshot(
        gold(spark, sf_dir), scratch_path(spark, "gold"), "ranking", AS_OF, order=("League", "Positions")
    )
    stored = read_csv(spark, path, "ClubName string, League string, `Season Year` int, Positions long")
    stamp = snapshot_stamp(F.lit(AS_OF.isoformat(" ")).cast("timestamp_ntz"))
    return stored.groupBy(F.concat(F.lit("ranking_"), stamp, F.lit(".csv")).alias("snapshot"), "League").agg(
        F.count(F.lit(1)).alias("n"), F.max("Positions").alias("last_position")
    )


def metrics(spark, sf_dir):
    names = cut_lineage(deduped(spark, sf_dir))
    return run_metrics(cleaned(spark, sf_dir), names, review(resolve(names, club(spark, sf_dir))))


def html_table_cells(spark, sf_dir):
    keyed = html_docs(spark, sf_dir).withColumn("key", F.struct("league", "doc"))
    cells = table_cells(keyed, "key", "html", first_only=True)
    return cells.select("key.league", "key.doc", "ro", "co", "head", "cell")


def pages_list_cells(spark, sf_dir):
    return table_cells(pages_tables(spark, sf_dir), "page_id", "html").drop("head")


HARD = (
    # Each of these around the row's cell must give the cell back, or what stands beside it.
    ("<td title='a>b'>{}</td>", "{}"),
    ('<td data-colspan="3" title="x > y">{}</td>', "{}"),
    ("<td colspan='0002'>{}</td>", "{}|{}"),
    ("<td>Queen&apos;s {} &amp Co&nbsp</td>", "Queen's {} & Co"),
    ("<td>&#0000000233;&#146;&lsqb;&cacute; {}</td>", "é’[ć {}"),
    ("<td>{} <table><tr><td>inner</td></tr></table> end</td>", "{} inner end"),
    ("<td><script>if (a < b) x = '<td>no</td>'</script>{}<!-- <td>no</td> --></td>", "{}"),
)


def html_hard_cells(spark, sf_dir):
    """First tables of generated pages whose cells use the harder parts of HTML."""
    part = table(spark, sf_dir, "part").select("p_type", "p_partkey", F.regexp_replace("p_name", "[^a-z ]", "").alias("cell"))
    row = F.lit(None).cast("string")
    for i, (markup, _) in enumerate(HARD):
        before, after = markup.split("{}")
        row = F.when(F.col("p_partkey") % len(HARD) == i, F.concat(F.lit(f"<tr>{before}"), "cell", F.lit(f"{after}<td>"), "p_partkey")).otherwise(row)
    rows = part.withColumn("doc", F.expr("p_partkey div 50")).groupBy("doc").agg(
        F.array_sort(F.collect_list(F.struct("p_partkey", row.alias("tr")))).alias("body")
    )
    html = F.concat(F.lit("<table>"), F.array_join("body.tr", ""), F.lit("</table><table><tr><td>other</table>"))
    taken = rows.select("doc", F.posexplode(first_table_rows(html)).alias("ro", "r"))
    return taken.select("doc", F.col("ro").cast("long").alias("ro"), F.array_join("r.cells", "|").alias("cells"))


def probe_column_len(spark, sf_dir):
    return probed_column(html_docs(spark, sf_dir), "html", probe_longer, ["league", "doc"]).drop("rows", "reason")


def probe_column_contains(spark, sf_dir):
    """Pages whose table mentions neither needle use the fallback column."""
    probe = lambda rows: probe_contains(rows, ["Brand#11 ", "Brand#2 "])
    return probed_column(html_docs(spark, sf_dir), "html", probe, ["league", "doc"]).drop("rows", "reason")


def bad_feed_quarantine(spark, sf_dir):
    """Events' properties as feeds; of ten documents five are damaged, each in its own way."""
    feed = F.to_json(F.create_map(F.lit("A"), F.array("props", F.col("event_id").cast("string"))))
    way = F.col("event_id") % 10
    body = (
        F.when(way == 0, F.substring(feed, 1, 9))
        .when(way == 1, F.concat(feed, F.lit(" trailing")))
        .when(way == 2, F.concat(feed, F.lit("\n"), feed))
        .when(way == 3, F.lit("{'A': ['x']}"))
        .when(way == 4, F.concat(F.lit('{"A": ["x", '), F.col("props"), F.lit("]}")))
        .when(way == 5, F.concat(F.lit("["), feed, F.lit("]")))
        .otherwise(feed)
    )
    return quarantine(table(spark, sf_dir, "events").select("event_id", body.alias("body"))).drop("body")


def pages_quarantine(spark, sf_dir):
    """Pages whose first list holds five entries or fewer lose it: they have no table then. Of the others, one in ten asks
    for a span of 5,000 digits, which is bounded, and one in ten nests its tables too deep, which sets it aside alone.
    """
    few = F.size(F.split(F.substring_index("html", "</tr></table>", 1), "<tr>")) <= 6
    way = F.col("page_id") % 10
    html = (
        F.when(few, F.replace("html", F.lit("<table>")))
        .when(way == 3, F.replace("html", F.lit("<table>"), F.lit(f"<table><tr><td colspan='{'9' * 5000}'>wide</td></tr>")))
        .when(way == 4, F.concat(F.repeat(F.lit("<table><tr><td>"), 300), "html"))
        .otherwise(F.col("html"))
    )
    pages = pages_tables(spark, sf_dir).withColumn("html", html)
    probed = probed_column(pages, "html", probe_longer, ["page_id"])
    return unreadable(probed, ["page_id"])


def inline_counts(spark, sf_dir):
    """An inline table of five typed columns, joined to the part counts of its names."""
    rows = [
        ("ECONOMY", "2030/31", 1, 40, 7.5),
        ("SMALL", "2030/31", 2, 35, 6.25),
        ("PROMO", "2030/31", 3, 31, 5.5),
        ("STANDARD", "2030/31", 4, 28, 5.125),
    ]
    columns = {
        "team_name": pa.string(),
        "season": pa.string(),
        "league_pos": pa.int32(),
        "goals_scored": pa.int32(),
        "success_score_preview": pa.float64(),
    }
    inline = inline_table(spark, columns, rows)
    parts = table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("team_name")).agg(F.count(F.lit(1)).alias("n"))
    return inline.join(parts, "team_name")


def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "csv")
    awkward = feed(spark, sf_dir).withColumn(
        "cell", F.expr("CASE WHEN ord % 3 = 0 THEN concat(cell, ',\"q\"\\\\NA', chr(10), 'next') ELSE cell END")
    )
    export_csv(awkward, path)
    return read_csv(spark, path, "league string, ord long, cell string")


def master_export(spark, sf_dir):
    """The master table as CSV, read back."""
    path = scratch_path(spark, "master")
    stored = cut_lineage(silver(spark, sf_dir))
    export_csv(master(stored, keep=("first_ord",)), path, order=("league", "first_ord"), drop=("first_ord",))
    return read_csv(spark, path, "raw_name string, standard_name string, league string, match_confidence long")


def review_export(spark, sf_dir):
    """The review log of a run stays when the next run has nothing to review, unless it is to be cleared."""
    kept, cleared = scratch_path(spark, "review"), scratch_path(spark, "review")
    log = cut_lineage(review(silver(spark, sf_dir)))
    for path, clear in ((kept, False), (cleared, True)):
        export_if_any(log, path, order=("league", "raw_input"))
        export_if_any(log.limit(0), path, clear_when_empty=clear)
    schema = "raw_input string, guessed_name string, confidence_score long, league string"
    logs = [read_csv(spark, path, schema).withColumn("log", F.lit(name)) for path, name in ((kept, "kept"), (cleared, "cleared"))]
    return logs[0].unionByName(logs[1])


def inline_export(spark, sf_dir):
    """The inline table joined to its counts, as CSV, read back."""
    path = scratch_path(spark, "inline")
    counts = inline_counts(spark, sf_dir)
    export_csv(counts, path, order=("league_pos",))
    return read_csv(spark, path, ", ".join(f"{name} {kind}" for name, kind in counts.dtypes))


def raw_landing(spark, sf_dir):
    path = scratch_path(spark, "raw")
    land_raw(table(spark, sf_dir, "events").select("event_id", F.col("props").alias("body")), path)
    return spark.read.schema("event_id long, body string").parquet(path)


def far_pages(spark, sf_dir):
    """The generated pages under numbers as far apart as ``monotonically_increasing_id`` puts them."""
    return html_docs(spark, sf_dir).withColumn("doc", F.expr("shiftleft(CAST(doc AS BIGINT), 33)"))


def medallion_end_to_end(spark, sf_dir):
    """Pages -> names -> resolved -> ranked per league."""
    return medallion(far_pages(spark, sf_dir), club(spark, sf_dir), "league", "doc", SEASON)


def bronze_guard(spark, sf_dir):
    """Two runs of the flow; the second finds pages without tables only, and the names of the first stay."""
    base = scratch_path(spark, "flow")
    pages, dictionary = cut_lineage(far_pages(spark, sf_dir)), cut_lineage(club(spark, sf_dir))
    run(pages, dictionary, base, AS_OF, SEASON, "league", "doc")
    bare = pages.withColumn("html", F.lit("<p>under repair</p>"))
    paths = run(bare, dictionary, base, AS_OF, SEASON, "league", "doc")
    names = spark.read.parquet(paths["bronze"]).groupBy("league").agg(F.count(F.lit(1)).alias("n_names"))
    aside = spark.read.parquet(paths["quarantine"]).groupBy("league").agg(F.count(F.lit(1)).alias("n_aside"))
    return names.join(aside, "league")


def flow_metrics(spark, sf_dir):
    """The counts that a run of the flow stores."""
    base = scratch_path(spark, "flow")
    paths = run(cut_lineage(far_pages(spark, sf_dir)), cut_lineage(club(spark, sf_dir)), base, AS_OF, SEASON, "league", "doc")
    return spark.read.parquet(paths["metrics"])


QUERIES = {
    "json_feed_explode": json_feed_explode,
    "clean_names": cleaned,
    "dedup_ordered": deduped,
    "first_k_names": lambda spark, sf_dir: first_k(deduped(spark, sf_dir), "league", "first_ord", 20),
    "names_to_json": names_to_json,
    "json_feed_roundtrip": json_feed_roundtrip,
    "json_documents_read": json_documents_read,
    "json_long_quarantine": json_long_quarantine,
    "feed_tag_league": feed_tag_league,
    "alias_flatten": lambda spark, sf_dir: flatten_aliases(club(spark, sf_dir)),
    "alias_exact": alias_exact,
    "alias_beyond_broadcast": alias_beyond_broadcast,
    "alias_miss": alias_miss,
    "normalise_names": normalise_names,
    "token_sort_ratio": token_sort_ratio,
    "fuzzy_best": fuzzy_best,
    "fuzzy_entities": fuzzy_entities,
    "fuzzy_blocks": fuzzy_blocks,
    "match_gate": match_gate,
    "resolve_hot": resolve_hot,
    "silver_master": lambda spark, sf_dir: master(silver(spark, sf_dir)),
    "kept_answers": kept_answers,
    "review_log": lambda spark, sf_dir: review(silver(spark, sf_dir)),
    "gold_ranking": gold,
    "gold_snapshot": gold_snapshot,
    "run_metrics": metrics,
    "html_table_cells": html_table_cells,
    "html_hard_cells": html_hard_cells,
    "pages_list_cells": pages_list_cells,
    "probe_column_len": probe_column_len,
    "probe_column_contains": probe_column_contains,
    "bad_feed_quarantine": bad_feed_quarantine,
    "pages_quarantine": pages_quarantine,
    "inline_table": inline_counts,
    "csv_roundtrip": csv_roundtrip,
    "raw_landing": raw_landing,
    "master_export": master_export,
    "review_export": review_export,
    "inline_export": inline_export,
    "medallion_end_to_end": medallion_end_to_end,
    "bronze_guard": bronze_guard,
    "flow_metrics": flow_metrics,
}

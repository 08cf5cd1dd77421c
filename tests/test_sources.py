import json
from datetime import datetime

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rollcall.operators.names import probe_contains, probe_longer
from rollcall.operators.ranking import ordered_lists
from rollcall.sources import feeds, sinks
from rollcall.sources.html import column_names, first_table_rows, probed_column, table_cells, unreadable
from rollcall.sources.inline import inline_table

PAGES = {
    "plain": (
        "<table><tr><th>Pos</th><th>Team</th></tr><tr><td>1</td><td>Foxes</td></tr></table>",
        [[True, ["Pos", "Team"]], [False, ["1", "Foxes"]]],
    ),
    "thead": (
        "<TABLE class=x><thead><tr><td>Pos</td></tr></thead><tbody><tr><th>1</th></tr><tr><td>2</td></tr></tbody></table>",
        [[True, ["Pos"]], [False, ["1"]], [False, ["2"]]],
    ),
    "th in the body": (
        "<table><tr><th>a</th></tr><tr><th>b</th></tr><tr><td>c</td></tr><tr><th>d</th></tr></table>",
        [[True, ["a"]], [True, ["b"]], [False, ["c"]], [False, ["d"]]],
    ),
    "row header": ("<table><tr><th>1</th><td>x</td></tr></table>", [[False, ["1", "x"]]]),
    "no end tags": ("<table><tr><td>a<td>b<tr><td>c<td>d", [[False, ["a", "b"]], [False, ["c", "d"]]]),
    "colspan": (
        "<table><tr><td colspan='2'>a</td><td>b</td></tr><tr><td COLSPAN=0>c</td></tr></table>",
        [[False, ["a", "a", "b"]], [False, ["c"]]],
    ),
    "rowspan": (
        "<table><tr><td rowspan=3>a</td><td>b</td><td rowspan='2'>c</td></tr><tr><td>d</td></tr>"
        "<tr><td>e</td><td>f</td></tr><tr><td>g</td></tr></table>",
        [[False, ["a", "b", "c"]], [False, ["a", "d", "c"]], [False, ["a", "e", "f"]], [False, ["g"]]],
    ),
    "rowspan and colspan": (
        "<table><tr><th rowspan=2>h</th><th>i</th></tr><tr><td colspan=2 rowspan=2>j</td><td>k</td></tr><tr><td>l</td></tr></table>",
        [[True, ["h", "i"]], [False, ["h", "j", "j", "k"]], [False, ["l", "j", "j"]]],
    ),
    "rowspan past the end": ("<table><tr><td rowspan=9>a</td></tr><tr></tr></table>", [[False, ["a"]], [False, ["a"]]]),
    "references": (
        "<table><tr><td>A &amp; B</td><td>&eacute;&#233;&#xE9;&nbsp;</td><td>&amp;lt; &unknown; &#0; 5 & 6;</td></tr></table>",
        [[False, ["A & B", "ééé", "&lt; &unknown; � 5 & 6;"]]],
    ),
    "markup and space": (
        "<table>\n<tr>\n<td>\n <b>Red</b>\n  <i>Foxes</i><br/>FC </td>\n<td></td></tr>\n</table>",
        [[False, ["Red  Foxes FC", ""]]],  # a line break and a run of spaces are two matches
    ),
    "hidden": (
        "<!-- <table><tr><td>old</td></tr></table> --><script>'<table><tr><td>js</td>'</script><table><tr><td>new</td></tr></table>",
        [[False, ["new"]]],
    ),
    "quoted and look-alike attributes": (
        "<table><tr><td title='a>b'>Foxes</td><td data-colspan='3' title=\"colspan='2'\">a</td><td>b</td></tr></table>",
        [[False, ["Foxes", "a", "b"]]],
    ),
    "spans as the standard reads them": (
        "<table><tr><td colspan=0002>a</td><td colspan=' 2x'>b</td><td colspan='x'>c</td><td colspan='-3'>d</td></tr>"
        "<tr><td rowspan=0>e</td><td>f</td></tr><tr><td>g</td></tr></table>",
        [[False, ["a", "a", "b", "b", "c", "d"]], [False, ["e", "f"]], [False, ["e", "g"]]],
    ),
    "more references": (
        "<table><tr><td>Queen&apos;s &lsqb;&cacute;&NotEqualTilde;</td><td>a &ampb&nbsp</td><td>&#0000000233;&#146;&#x1F600;&notit;</td></tr></table>",
        [[False, ["Queen's [ć≂̸", "a &b", "é’😀¬it;"]]],
    ),
    "nested": (
        "<table><tr><td>Outer one</td><td><table><tr><td>in</td></tr></table></td></tr><tr><td>Outer two</td></tr></table>",
        [[False, ["Outer one", "in"]], [False, ["Outer two"]]],
    ),
    "broken": ("<table><tr><td>a</td></tr><tr><td>b<![foo[ x]]>c</td>", [[False, ["a"]], [False, ["bc"]]]),
    "track and thing": ("<table><tr><td><track><thing>x</thing></td></tr></table>", [[False, ["x"]]]),
    "first of two": ("<p><table><tr><td>1</td></tr></table><table><tr><td>2</td></tr></table>", [[False, ["1"]]]),
    "none": ("<ul><li>x</li></ul>", None),
    "null": (None, None),
}


@pytest.mark.parametrize("page", PAGES)
def test_first_table(spark, page):
    html, want = PAGES[page]
    df = spark.createDataFrame([(html,)], "html string")
    rows = df.select(first_table_rows(F.col("html")).alias("rows")).first().rows
    assert (rows and [[r.head, r.cells] for r in rows]) == want


def test_table_cells_covers_all_tables(spark):
    df = spark.createDataFrame([(7, PAGES["first of two"][0]), (8, "no table")], "doc long, html string")
    got = sorted(map(tuple, table_cells(df, "doc", "html").collect()))
    assert got == [(7, 0, 0, 0, False, "1"), (7, 1, 0, 0, False, "2")]
    assert table_cells(df, "doc", "html", first_only=True).count() == 1


def test_wide_spans_are_bounded_as_the_standard_says(spark):
    html = "<table><tr><td colspan='12345'>a</td></tr></table>"
    rows = spark.createDataFrame([(html,)], "html string").select(first_table_rows(F.col("html")).alias("rows")).first().rows
    assert len(rows[0].cells) == 1000


def test_nested_tables_are_tables_of_their_own(spark):
    df = spark.createDataFrame([(1, PAGES["nested"][0])], "doc long, html string")
    got = sorted(map(tuple, table_cells(df, "doc", "html").collect()))
    assert [x for x in got if x[1] == 1] == [(1, 1, 0, 0, False, "in")]


def grid(rows):
    return "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in row) + "</tr>" for row in rows) + "</table>"


@pytest.mark.parametrize(
    "rows,longer,contains",
    [
        ([["1", "abcd", "efghi"]], 1, 2),
        ([["1", "abc", "efg"]], None, 2),
        ([["1", "abc"], ["2", "City X", "y"]], 1, 1),
        ([["1", "abc"]], None, 1),
        ([["abc"]], None, None),
        ([["1", "abc", "d"], ["1000"]], 0, 2),
        ([["city", "b", "c"]], 0, 2),
        ([["1", "a", "b", "x City"]], 3, 3),
    ],
)
def test_probes(spark, rows, longer, contains):
    df = spark.createDataFrame([("d", grid(rows))], "doc string, html string")
    assert probed_column(df, "html", probe_longer, ["doc"]).first().col == longer
    found = probed_column(df, "html", lambda r: probe_contains(r, ["City", "Foxes"]), ["doc"])
    assert found.first().col == contains


def test_pages_without_table_or_column_give_no_names(spark):
    pages = [("a", grid([["1", "Foxes"], ["2"], ["3", "Owls"]])), ("b", "no table"), ("c", grid([["x"]])), ("d", None)]
    df = spark.createDataFrame(pages, "doc string, html string")
    probed = probed_column(df, "html", probe_longer, ["doc"])
    got = sorted(map(tuple, column_names(probed, ["doc"]).collect()), key=str)
    assert got == [("a", 0, "Foxes"), ("a", 1, None), ("a", 2, "Owls")]
    assert {r.doc: r.rows is None for r in probed.collect()} == {"a": False, "b": True, "c": False, "d": True}


def test_pages_that_give_no_feed_are_set_aside(spark):
    pages = [("a", grid([["1", "Foxes"]])), ("b", "no table"), ("c", grid([["x"]])), ("d", None)]
    probed = probed_column(spark.createDataFrame(pages, "doc string, html string"), "html", probe_longer, ["doc"])
    assert sorted(map(tuple, unreadable(probed, ["doc"]).collect())) == [("b", "no table"), ("d", "no table")]
    needed = {r.doc: r.reason for r in unreadable(probed, ["doc"], column_needed=True).collect()}
    assert needed == {"b": "no table", "c": "no such column", "d": "no table"}


def test_page_is_parsed_once(spark):
    df = spark.createDataFrame([("a", grid([["1", "Foxes"]]))], "doc string, html string")
    names = column_names(probed_column(df, "html", probe_longer, ["doc"]), ["doc"])
    plan = names._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert "Exchange" not in names._jdf.queryExecution().executedPlan().toString()


FEED = [
    ('{"A": ["x", "y"], "B": [], "C": ["é"]}', [(0, "A", 0, "x"), (0, "A", 1, "y"), (2, "C", 0, "é")]),
    ('{"A": ["x"], "B": ["b"], "A": ["z", "w"]}', [(0, "A", 0, "z"), (0, "A", 1, "w"), (1, "B", 0, "b")]),
    ('{"A": ["\\u00e9"]}', [(0, "A", 0, "é")]),
    ('{"A": [', []),
    ("[]", []),
    (None, []),
    ('{"A":["x"]} trailing', []),
    ('{"A":["x"]}\n{"B":["y"]}', []),
    ("{'A': ['x']}", []),
    ('{"A": ["x", {"k": 1}]}', []),
    ('{"A": "x"}', []),
    ('{"A": ["x", null]}', []),
    ('{"A": ["\\ud800"]}', []),
]


@pytest.mark.parametrize("body,want", FEED)
def test_feed_keeps_document_order(spark, body, want):
    df = spark.createDataFrame([("doc", body)], "doc string, body string")
    got = [tuple(r)[1:] for r in feeds.explode_feed(df).collect()]
    assert got == want


def test_bad_documents_are_set_aside(spark):
    df = spark.createDataFrame(list(enumerate(b for b, _ in FEED)), "doc long, body string")
    got = sorted((r.doc, r.reason) for r in feeds.quarantine(df, "body").collect())
    bad, shape, text = "invalid json", "not an object of lists", "a name that is no text"
    reasons = {3: bad, 4: shape, 5: bad, 6: bad, 7: bad, 8: bad, 9: text, 10: shape, 11: text, 12: "half a character"}
    assert dict(got) == reasons


def test_whole_files_are_documents(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"A":\n ["x",\n "ō"]}', encoding="utf-8")
    (tmp_path / "two.json").write_text('{"B": ["y"]}', encoding="utf-8")
    docs = feeds.read_documents(spark, str(tmp_path))
    got = sorted((r.doc.rsplit("/", 1)[1], r.league, r.name_ord, r.name) for r in feeds.explode_feed(docs).collect())
    assert got == [("one.json", "A", 0, "x"), ("one.json", "A", 1, "ō"), ("two.json", "B", 0, "y")]


@pytest.mark.parametrize("ascii_only", [False, True])
def test_feed_documents_parse_back(spark, ascii_only):
    lists = spark.createDataFrame([("Ō", 0, ["a\"b", "é", "x\\y"])], "league string, part long, names array<string>")
    body = feeds.feed_documents(lists, "league", ["part"], ascii_only).first().names_json
    assert json.loads(body) == {"Ō": ["a\"b", "é", "x\\y"]}
    assert body.isascii() == ascii_only


def test_one_reader_restores_the_order_of_all_parts(spark, tmp_path):
    names = [(g, o, f"{g}é{o}") for g in ("a", "b") for o in range(25)]
    df = spark.createDataFrame(names, "league string, ord long, name string").repartition(4)
    for list_rows in (100, 2):
        path = tmp_path / f"feed{list_rows}"
        sinks.write_feed(ordered_lists(df, "league", "name", "ord", list_rows).coalesce(2), str(path), ascii_only=True)
        files = list(path.glob("part-*"))
        assert len(files) <= 2 and all(p.read_text().isascii() for p in files)
        assert sorted(map(tuple, sinks.read_feed(spark, str(path)).collect())) == names


def test_tagging_drops_unlisted_feeds(spark):
    urls = ["https://h.example/one/table", "https://h.example/two?x=1", "https://h.example/"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = [(r.slug, r.formal_name) for r in feeds.tag_groups(df, {"one": "First", "three": "Third"}).collect()]
    assert got == [("one", "First")]
    listed = spark.createDataFrame([("one", "First"), ("three", "Third")], "slug string, formal_name string")
    for small in (0, 10):
        assert [(r.slug, r.formal_name) for r in feeds.tag_groups(df, listed, small=small).collect()] == got


AWKWARD = [(" a ", 1), ('b,"c"', 2), ("NA", 3), ("Ō’k", 4), ("x\\y", 5), ("line\nbreak", 6), (None, 7)]


def test_csv_equals_the_pandas_dialect_and_reads_back(spark, tmp_path):
    df = spark.createDataFrame(AWKWARD, "name string, n long").coalesce(1)
    path = str(tmp_path / "out")
    sinks.export_csv(df, path, order=("n",))
    written = "".join(p.read_text(encoding="utf-8") for p in sorted((tmp_path / "out").glob("part-*")))
    assert written == pd.DataFrame(AWKWARD, columns=["name", "n"]).to_csv(index=False)
    back = sinks.read_csv(spark, path, "name string, n long").collect()
    assert sorted(map(tuple, back), key=lambda r: r[1]) == AWKWARD


def test_export_order_and_dropped_columns(spark, tmp_path):
    df = spark.range(100).select((99 - F.col("id")).alias("place"), F.col("id").alias("name")).repartition(3)
    sinks.export_csv(df, str(tmp_path / "out"), order=("place",), drop=("place",))
    lines = [l for p in sorted((tmp_path / "out").glob("part-*")) for l in p.read_text().splitlines() if l != "name"]
    assert lines == [str(i) for i in range(99, -1, -1)]


def test_empty_review_leaves_the_old_file(spark, tmp_path):
    path = str(tmp_path / "review")
    full, empty = spark.range(3), spark.range(0)
    assert sinks.export_if_any(full, path)
    assert not sinks.export_if_any(empty, path)
    assert sinks.read_csv(spark, path, "id long").count() == 3
    assert not sinks.export_if_any(empty, path, clear_when_empty=True)
    assert sinks.read_csv(spark, path, "id long").count() == 0


def test_snapshots_stay_side_by_side(spark, tmp_path):
    base = str(tmp_path)
    first = sinks.export_snapshot(spark.range(1), base, "ranking", datetime(2026, 1, 2, 3, 4))
    second = sinks.export_snapshot(spark.range(2), base, "ranking", datetime(2026, 1, 2, 3, 5))
    again = sinks.export_snapshot(spark.range(5), base, "ranking", datetime(2026, 1, 2, 3, 5, 59))
    assert first == f"{base}/ranking_02012026_0304.csv" and again == second
    assert [sinks.read_csv(spark, p, "id long").count() for p in (first, second)] == [1, 5]


def test_raw_documents_land_unchanged(spark, tmp_path):
    body = '{"b": 1,  "a": [ ]}\n'
    docs = spark.createDataFrame([("x", body)], "doc string, body string")
    sinks.land_raw(docs, str(tmp_path / "raw"))
    assert spark.read.parquet(str(tmp_path / "raw")).first().body == body


def test_inline_table_is_local(spark):
    df = inline_table(spark, {"name": pa.string(), "pos": pa.int32()}, [("a", 1), ("b", 2)])
    assert df.dtypes == [("name", "string"), ("pos", "int")]
    assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString()


def test_a_page_fails_alone(spark, monkeypatch):
    from rollcall.functions import markup

    digits = "9" * 5000
    wide = f"<table><tr><td colspan='{digits}'>a</td></tr></table>"
    deep = "<table><tr><td>" * (markup.MOST_DEEP + 1)
    many = "<table>" + "<tr><td colspan=1000 rowspan=60000>x" + "<tr>" * 3000
    good = "<table><tr><th>Team</th></tr><tr><td>Foxes</td></tr></table>"
    pages = spark.createDataFrame([(i, x) for i, x in enumerate([wide, deep, many, good, None, ""])], "doc int, html string")
    probed = probed_column(pages, "html", probe_longer, ["doc"])
    got = {r.doc: r.reason for r in unreadable(probed, ["doc"]).collect()}
    assert got == {1: "tables too deep", 2: "too many cells", 4: "no table", 5: "no table"}
    assert {r.doc: r.cell for r in column_names(probed, ["doc"]).collect()}[3] == "Foxes"
    assert markup.span({"colspan": "000" + digits}, "colspan", 1000) == 1000 and markup.span({"colspan": "000"}, "colspan", 1000) == 1
    monkeypatch.setattr(markup, "page_tables", lambda html: {}["x"])
    assert markup.read_page(good) == {"reason": "unreadable: KeyError", "tables": None}

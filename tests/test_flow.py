"""The whole flow with stored layers, and every registered query against its SQL."""

import re
from datetime import datetime
from pathlib import Path
from types import SimpleNamespace

import pytest

import workload
from __spark_entry__ import entry
from check import compare
from oracle import ORACLE
from rollcall.operators.names import clean_feed
from rollcall.plans import medallion
from rollcall.session import cut_lineage, drop_path, name_scratch, scratch_path, scratch_root
from rollcall.sources.sinks import read_csv
from workload import QUERIES

SF = "/root/testdata/sf0.001"
GOLD = "ClubName string, League string, `Season Year` int, Positions long"


@pytest.fixture(scope="module")
def compared(spark):
    return {name: (problem, rows) for name, problem, _, _, rows in compare(spark, SF, set(QUERIES))}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(compared, name):
    problem, rows = compared[name]
    assert not problem and rows


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


def test_entry_gives_the_ranking(spark):
    df = entry(spark)
    assert df.columns == ["ClubName", "League", "Season Year", "Positions"]
    assert df.count() > 0


def test_layers_are_stored_and_later_runs_replace_them(spark, tmp_path):
    pages, club = workload.far_pages(spark, SF), workload.club(spark, SF)
    want = sorted(map(tuple, workload.gold(spark, SF).collect()))
    for minute in (4, 5):
        paths = medallion.run(pages, club, str(tmp_path), datetime(2026, 1, 2, 3, minute), 2025, "league", "doc")
    assert paths["gold"].endswith("/gold/ranking_02012026_0305.csv")
    assert len(list((tmp_path / "gold").iterdir())) == 2
    assert sorted(map(tuple, read_csv(spark, paths["gold"], GOLD).collect())) == want
    silver = spark.read.parquet(paths["silver"])
    master = read_csv(
        spark, f"{tmp_path}/silver/master_csv", "raw_name string, standard_name string, league string, match_confidence long"
    )
    assert master.count() == silver.count() == len(want)
    log = read_csv(
        spark, f"{tmp_path}/silver/review_csv", "raw_input string, guessed_name string, confidence_score long, league string"
    )
    assert log.count() == silver.filter("match_confidence < 100").count() > 0
    assert spark.read.parquet(paths["quarantine"]).isEmpty() and spark.read.parquet(paths["unnamed"]).isEmpty()


def test_a_run_leaves_no_scratch_of_its_own(spark, tmp_path):
    def left():
        return [p.name for p in Path(scratch_root(spark)).iterdir() if p.name.startswith(("probed", "layer"))]

    pages = workload.far_pages(spark, SF).limit(3)
    medallion.run(pages, workload.club(spark, SF), str(tmp_path / "base"), datetime(2026, 1, 2), 2025, "league", "doc")
    assert not left()


def test_pages_far_apart_keep_their_order(spark):
    """Page numbers beyond 2^39, in both directions, and more rows in a page than one page number is apart."""
    names = [f"Club {a}{b}" for a in "abcdefgh" for b in "abcdefgh"]
    numbers = [-(2**62), -1, 0, 1, 2**39, 2**40, 2**62]
    pages, want = [], []
    for i, page in enumerate(numbers):
        own = names[i * 9 : i * 9 + 9]
        rows = "".join(f"<tr><td>{n}</td></tr>" for n in own)
        pages.append(("L", page, f"<table>{rows}</table>"))
        want += own
    df = spark.createDataFrame(pages, "league string, doc long, html string").repartition(4)
    entries = spark.createDataFrame([(i, n, [n]) for i, n in enumerate(names)], "ord long, standard_name string, aliases array<string>")
    ranked = medallion.medallion(df, entries, "league", "doc", 2025).orderBy("Positions").collect()
    assert [r.ClubName for r in ranked] == want
    assert [r.Positions for r in ranked] == list(range(1, len(want) + 1))


class Session:
    """As much of a session as naming a folder needs."""

    def __init__(self, master, folder=None):
        self.settings = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = SimpleNamespace(master=master)
        self.conf = SimpleNamespace(get=self.settings.get, set=self.settings.__setitem__)


@pytest.mark.parametrize(
    ("master", "folder", "want"),
    [("local[4]", None, "/own"), ("local", None, "/own"), ("local-cluster[2,1,900]", None, None), ("yarn", None, None), ("local[4]", "/named/", "/named")],
)
def test_scratch_must_be_named(master, folder, want):
    session = Session(master, folder)
    name_scratch(session, "/own")
    if want:
        assert scratch_root(session) == want
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_root(session)
    with pytest.raises(ValueError, match="not under|spark.checkpoint.dir"):
        drop_path(session, "/elsewhere/x")


def test_a_failing_stage_stops_the_run(spark, tmp_path):
    pages = workload.html_docs(spark, SF)
    with pytest.raises(Exception):
        medallion.run(pages, spark.range(3), str(tmp_path), datetime(2026, 1, 2), 2025, "league", "doc")
    assert (tmp_path / "bronze").exists() and not (tmp_path / "gold").exists()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_multiplies_rows_or_numbers_a_whole_table(spark, name, monkeypatch):
    """In the last plan, and in that of every table that is stored on the way."""
    texts = []

    def stored(df):
        texts.append(plan(df))
        return cut_lineage(df)

    for module in ("workload", "rollcall.operators.fuzzy", "rollcall.plans.medallion"):
        monkeypatch.setattr(f"{module}.cut_lineage", stored)
    text = "".join([*texts, plan(QUERIES[name](spark, SF)), *texts])
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    assert "SinglePartition, ENSURE_REQUIREMENTS" not in text


def test_aliases_are_broadcast_only_within_their_bound(spark):
    rows = workload.deduped(spark, SF)
    club = workload.club(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(workload.match_exact(rows, club))
        beyond = plan(workload.match_exact(rows, club, broadcast_bytes=10))
        # What is left to broadcast there is the bounded list of hot names, and the answers for those names.
        assert "SortMergeJoin" in beyond
        assert sum("hot" not in line for line in re.findall(r".*BroadcastHashJoin.*", beyond)) == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scans_read_only_what_is_asked(spark):
    text = plan(workload.cleaned(spark, SF))
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_brand:string,p_type:string>" in text
    assert "Exchange" not in text
    assert "ReadSchema: struct<url:string>" in plan(workload.feed_tag_league(spark, SF))


def test_misses_are_scored_once_each_in_as_many_tasks_as_the_work_needs(spark, monkeypatch):
    text = plan(workload.silver(spark, SF))
    assert "REPARTITION_BY_NUM" in text[text.index("MapInArrow") :]
    monkeypatch.setattr("rollcall.operators.fuzzy.TASK_PAIRS", 100)
    many = plan(workload.silver(spark, SF))
    assert re.search(r"hashpartitioning\(xxhash64\(key#\d+, 42\), [2-9]\d*\), REPARTITION_BY_NUM", many)


@pytest.mark.parametrize("name", ["silver_master", "review_log", "names_to_json", "json_feed_roundtrip"])
def test_names_are_worked_out_once(spark, name, monkeypatch):
    scans = []

    def stored(df):
        scans.extend(re.findall(r"FileScan parquet \[[^]]*\].*?part\.parquet", plan(df)))
        return cut_lineage(df)

    monkeypatch.setattr("workload.cut_lineage", stored)
    last = plan(QUERIES[name](spark, SF))
    names = [x for x in [*scans, *re.findall(r"FileScan parquet \[[^]]*\].*?part\.parquet", last)] if "p_type" in x]
    assert len(names) <= (2 if name == "names_to_json" else 1)  # its groups without a name are told from all cells


def test_scratch_is_the_folder_the_session_names(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert first != second and first.startswith(root)
    assert cut_lineage(spark.range(5)).inputFiles()[0].removeprefix("file://").startswith(root)


def test_one_group_variant_keeps_the_first_twenty(spark):
    names = clean_feed(workload.feed(spark, SF).selectExpr("'all' AS league", "ord", "cell"), limit=20)
    every = clean_feed(workload.feed(spark, SF).selectExpr("'all' AS league", "ord", "cell"))
    want = sorted(r.first_ord for r in every.collect())[:20]
    assert sorted(r.first_ord for r in names.collect()) == want

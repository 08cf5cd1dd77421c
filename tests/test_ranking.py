import random

import pytest
from pyspark.sql import functions as F

from rollcall.operators.ranking import arrival_rank, first_k, gold_ranking, ordered_lists


def groups(seed, ords):
    rnd = random.Random(seed)
    rows = []
    for group, n in (("hot", 400), ("a", 60), ("b", 1)):
        rows += [(group, o, f"{group}{o}") for o in rnd.sample(ords, n)]
    rnd.shuffle(rows)
    return rows


def places(rows):
    out = {}
    for group in {r[0] for r in rows}:
        for i, o in enumerate(sorted(r[1] for r in rows if r[0] == group)):
            out[group, o] = i + 1
    return out


ORDS = {
    "dense": list(range(500)),
    "sparse": [i * 7919 for i in range(500)],
    "partition ids": [(i % 9 << 33) + i for i in range(500)],
    "wide": [random.Random(i).randrange(2**62) for i in range(500)],
    "negative": list(range(-250, 250)),
}


@pytest.mark.parametrize("bits", [2, 5, 21])
@pytest.mark.parametrize("kind", ORDS)
def test_rank_by_arrival(spark, kind, bits):
    rows = groups(1, ORDS[kind])
    df = spark.createDataFrame(rows, "league string, ord long, name string").repartition(5)
    got = {(r.league, r.ord): r.place for r in arrival_rank(df, "league", "ord", "place", bits).collect()}
    assert got == places(rows)


@pytest.mark.parametrize("bits", [2, 21])
def test_rank_by_page_and_row(spark, bits):
    rnd = random.Random(9)
    numbers = [-(2**62), -5, 0, 3, 2**39, 2**40, (1 << 62) + 1]
    rows = [(g, p, r, f"{g}{p}-{r}") for g in ("a", "b") for p in numbers for r in rnd.sample(range(1000), 15)]
    df = spark.createDataFrame(rows, "league string, page long, row long, name string").repartition(5)
    got = {r.name: r.place for r in arrival_rank(df, "league", "page", "place", bits, within="row").collect()}
    want = {}
    for group in ("a", "b"):
        for i, x in enumerate(sorted(x[1:] for x in rows if x[0] == group)):
            want[x[2]] = i + 1
    assert got == want


def test_ties_are_broken_by_the_other_columns(spark):
    rows = [("a", 1, n) for n in "zyxwv"]
    for parts in (1, 4):
        df = spark.createDataFrame(rows, "league string, ord long, name string").repartition(parts)
        assert {r.name: r.place for r in arrival_rank(df, "league", "ord", "place").collect()} == {n: i + 1 for i, n in enumerate("vwxyz")}


def test_gold_keeps_unknown_and_repeats(spark):
    rows = [("A", 5, "x"), ("A", 7, "UNKNOWN"), ("A", 9, "x"), ("B", 1, "y"), (None, 1, "z")]
    df = spark.createDataFrame(rows, "league string, name_ord long, standard_name string")
    gold = gold_ranking(df, 2025)
    assert gold.dtypes == [("ClubName", "string"), ("League", "string"), ("Season Year", "int"), ("Positions", "bigint")]
    got = sorted(gold.collect(), key=lambda r: (r.League, r.Positions))
    assert [tuple(r) for r in got] == [("x", "A", 2025, 1), ("UNKNOWN", "A", 2025, 2), ("x", "A", 2025, 3), ("y", "B", 2025, 1)]


@pytest.mark.parametrize("k", [20, 5000])
def test_first_k(spark, k):
    rows = groups(2, ORDS["sparse"])
    df = spark.createDataFrame(rows, "league string, ord long, name string")
    got = {(r.league, r.ord): r.rn for r in first_k(df, "league", "ord", k).collect()}
    assert got == {key: p for key, p in places(rows).items() if p <= k}


def test_first_k_cuts_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("league"), F.col("id").alias("ord"))
    plan = first_k(df, "league", "ord", 20)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_long_lists_go_on_in_parts(spark):
    rows = groups(3, ORDS["sparse"])
    df = spark.createDataFrame(rows, "league string, ord long, name string")
    lists = ordered_lists(df, "league", "name", "ord", list_rows=50).collect()
    assert max(len(r.names) for r in lists) == 50
    for group in ("hot", "a", "b"):
        parts = sorted((r.part, r.names) for r in lists if r.league == group)
        assert [p for p, _ in parts] == list(range(len(parts)))
        assert all(r.start == 50 * r.part for r in lists)
        want = [n for _, n in sorted((o, n) for g, o, n in rows if g == group)]
        assert [n for _, names in parts for n in names] == want


def test_group_without_names_keeps_an_empty_list(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "league string, ord long, name string")
    groups = spark.createDataFrame([("a",), ("b",), ("b",)], "league string")
    got = sorted(map(tuple, ordered_lists(df, "league", "name", "ord", 1, groups).collect()))
    assert got == [("a", 0, 0, ["x"]), ("a", 1, 1, ["y"]), ("b", 0, 0, [])]

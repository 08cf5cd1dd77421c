import random

import pytest
from pyspark.sql import functions as F

from rollcall.operators.dictionary import dictionary_size, flatten_aliases, unnamed
from rollcall.operators.names import run_metrics
from rollcall.operators.resolve import master, match_exact, nameless, resolve, review
from rollcall.operators.skew import join_lookup

ENTRIES = [
    (1, "Red Foxes FC", ["Red Foxes", "RED FOXES", "Red Foxes"]),
    (2, "Blue Owls AFC", ["Blue Owls", "Owls"]),
    (3, "Zed FC", ["Owls"]),
    (4, "Lonely FC", None),
]
RAW = [
    ("A", 0, "Red Foxes"),
    ("A", 1, "Red Foxes FC"),
    ("A", 2, "red foxes"),
    ("A", 3, "FC Red-Foxes"),
    ("A", 4, "qqqq"),
    ("A", 5, "Owls"),
    ("B", 0, "Red Foxes"),
    ("B", 1, " Red Foxes"),
    ("B", 2, "qqqq"),
    ("B", 3, None),
]
WANT = {
    ("A", "Red Foxes"): ("Red Foxes FC", 100),
    ("A", "Red Foxes FC"): ("Red Foxes FC", 100),
    ("A", "red foxes"): ("Red Foxes FC", 86),
    ("A", "FC Red-Foxes"): ("Red Foxes FC", 100),
    ("A", "qqqq"): ("UNKNOWN", 0),
    ("A", "Owls"): ("Zed FC", 100),
    ("B", "Red Foxes"): ("Red Foxes FC", 100),
    ("B", " Red Foxes"): ("Red Foxes FC", 86),
    ("B", "qqqq"): ("UNKNOWN", 0),
}


@pytest.fixture(scope="module")
def entries(spark):
    return spark.createDataFrame(ENTRIES, "ord long, standard_name string, aliases array<string>")


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(RAW, "league string, name_ord long, name string")


def test_last_entry_owns_an_alias(entries):
    got = {r.alias: r.standard_name for r in flatten_aliases(entries).collect()}
    assert got == {"Red Foxes": "Red Foxes FC", "RED FOXES": "Red Foxes FC", "Blue Owls": "Blue Owls AFC", "Owls": "Zed FC"}


def test_dictionary_size_bounds_its_aliases(entries):
    size = dictionary_size(entries)
    assert (size.names, size.aliases) == (4, 6)
    assert size.alias_bytes >= sum(len(a) + len(s) for _, s, al in ENTRIES for a in set(al or []))
    assert size.aliases_fit() and not size.aliases_fit(10)


OPTIONS = [
    {},
    {"broadcast_bytes": 0},
    {"hot_rows": 1},
    {"hot_rows": 1, "broadcast_bytes": 0},
    {"small_rows": 1, "block_rows": 1, "group_keys": 2, "hot_rows": 1},
]


@pytest.mark.parametrize("options", OPTIONS, ids=str)
def test_hand_checked_rows(raw, entries, options):
    rows = resolve(raw, entries, **options).collect()
    assert {(r.league, r.name): (r.standard_name, r.match_confidence) for r in rows} == WANT
    assert len(rows) == len(WANT)
    assert {(r.league, r.name): r.name_ord for r in rows} == {(g, n): o for g, o, n in RAW if n}


def test_exact_match_is_null_on_a_miss(raw, entries):
    rows = match_exact(raw, entries).collect()
    assert {(r.league, r.name): r.score for r in rows if r.score} == {k: 100 for k in WANT if k[1] in ("Red Foxes", "Owls")}
    assert all((r.score is None) == (r.standard_name is None) for r in rows)


def test_review_lists_every_score_under_100(raw, entries):
    resolved = resolve(raw, entries)
    assert master(resolved).columns == ["raw_name", "standard_name", "league", "match_confidence"]
    log = review(resolved)
    assert log.columns == ["raw_input", "guessed_name", "confidence_score", "league"]
    want = sorted((n, s, p, g) for (g, n), (s, p) in WANT.items() if p < 100)
    assert sorted(map(tuple, log.collect())) == want


def test_gate_is_a_parameter(raw, entries):
    rows = resolve(raw, entries, above=90).collect()
    assert {r.standard_name for r in rows if r.name == "red foxes"} == {"UNKNOWN"}
    assert {r.match_confidence for r in rows if r.name == "red foxes"} == {86}


def test_columns_in_use_are_refused(raw, entries):
    with pytest.raises(ValueError, match="score"):
        resolve(raw.withColumn("score", F.lit(1)), entries)


def test_hot_key_is_split_and_nothing_is_lost(spark):
    rnd = random.Random(5)
    rows = [("hot" if rnd.random() < 0.6 else f"k{rnd.randrange(30)}", i) for i in range(3000)]
    df = spark.createDataFrame(rows, "key string, id long")
    lookup = df.select("key").distinct().withColumn("value", F.concat(F.lit("v-"), "key"))
    counts = df.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    joined = join_lookup(df, lookup, counts, "key", hot_rows=200)
    got = joined.collect()
    assert sorted((r.key, r.id) for r in got) == sorted(rows)
    assert all(r.value == f"v-{r.key}" for r in got)


def test_equal_rows_of_a_hot_key_spread(spark):
    rows = spark.range(20_000).select(F.lit("A").alias("league"), F.lit("hot").alias("name"))
    counts = rows.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    lookup = spark.createDataFrame([("hot", "v"), ("cold", "w")], "name string, value string")
    joined = join_lookup(rows, lookup, counts, "name", hot_rows=1000)
    per_task = joined.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 20_000
    assert len(per_task) > 1 and max(r["count"] for r in per_task) < 20_000


def test_entries_without_a_name_match_nothing(spark, raw):
    rows = [*ENTRIES, (9, None, ["qqqq"]), (10, None, None)]
    broken = spark.createDataFrame(rows, "ord long, standard_name string, aliases array<string>")
    assert [r.ord for r in unnamed(broken).orderBy("ord").collect()] == [9, 10]
    for options in ({}, {"small_rows": 0, "broadcast_bytes": 0}):
        got = resolve(raw, broken, **options).collect()
        assert {(r.league, r.name): (r.standard_name, r.match_confidence) for r in got} == WANT
    assert [tuple(r) for r in nameless(raw).collect()] == [("B", 3, None, "no name")]


def test_run_metrics_counts_before_and_after(spark):
    before = spark.createDataFrame([("a",), ("a",), ("b",)], "league string")
    after = before.distinct()
    log = before.filter("league = 'a'").limit(1)
    got = sorted(map(tuple, run_metrics(before, after, log).collect()))
    assert got == [("a", 2, 1, 1), ("b", 1, 1, 0)]


def test_run_metrics_counts_groups_without_names(spark):
    before = spark.createDataFrame([("a",), ("a",)], "league string")
    groups = spark.createDataFrame([("a", 1), ("none", 2), ("none", 3), (None, 4)], "league string, doc int")
    got = run_metrics(before, before.limit(1), before.limit(0), groups=groups)
    assert sorted(map(tuple, got.collect())) == [("a", 2, 1, 0), ("none", 0, 0, 0)]

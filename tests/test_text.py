import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollcall.functions.text import normalise, snapshot_stamp, token_key
from rollcall.operators.names import clean_feed, clean_names, dedup_ordered

CELLS = [
    ("1Red Foxes", "Red Foxes"),
    ("12Blue Owls 1889Form:WWL", "Blue Owls"),
    ("Form:WWL", None),
    ("10.0", None),
    ("Team", None),
    ("nan", None),
    (None, None),
    ("team", "team"),
    ("AB", None),
    ("\xa0Red Foxes\t", "Red Foxes"),
    ("Owls²① FC\x1f", "Owls FC"),
    ("١Zed　", "Zed"),
    ("Ō’k ForM:", "Ō’k ForM:"),
]


@pytest.mark.parametrize("cell,name", CELLS)
def test_cell_cleaning(spark, cell, name):
    df = spark.createDataFrame([(1, cell)], "ord long, cell string")
    got = [r.name for r in clean_names(df).collect()]
    assert got == ([name] if name else [])


def expected_name(cell):
    kept = "".join(c for c in cell.partition("Form:")[0] if not c.isdigit())
    return kept.strip()


TEXT = st.text(st.sampled_from("aB7² \xa0\t\x1cé٣Form:Team_-' "), max_size=20)


@settings(max_examples=5, deadline=None)
@given(st.lists(TEXT, min_size=50, max_size=200))
def test_cleaning_matches_the_definition(spark, cells):
    df = spark.createDataFrame(list(enumerate(cells)), "ord long, cell string")
    got = {r.ord: r.name for r in clean_names(df).collect()}
    want = {i: expected_name(c) for i, c in enumerate(cells)}
    assert got == {i: n for i, n in want.items() if len(n) > 2 and n not in ("Team", "nan")}


@pytest.mark.parametrize(
    "name,norm,key",
    [
        ("  FC Red-Foxes ", "fc red foxes", "fc foxes red"),
        ("Owls & Co_1 (B)", "owls co_1 b", "b co_1 owls"),
        ("ÉTOILE’s 2²", "étoile s 2²", "2² s étoile"),
        ("---", "", ""),
        ("", "", ""),
    ],
)
def test_normalise(spark, name, norm, key):
    df = spark.createDataFrame([(name,)], "name string")
    row = df.select(normalise(F.col("name")), token_key(F.col("name"))).first()
    assert tuple(row) == (norm, key)


def test_dedup_keeps_the_first_place_and_is_idempotent(spark):
    rows = [("a", 3, "x"), ("a", 1, "y"), ("a", 2, "x"), ("b", 9, "x")]
    once = dedup_ordered(spark.createDataFrame(rows, "league string, ord long, name string"))
    got = sorted(map(tuple, once.collect()))
    assert got == [("a", "x", 2), ("a", "y", 1), ("b", "x", 9)]
    again = dedup_ordered(once, ord="first_ord")
    assert sorted(map(tuple, again.collect())) == got


def test_clean_feed_limit_counts_after_dedup(spark):
    cells = [("a", i, f"{i}name {'abcdefgh'[i // 2]}") for i in range(16)]
    df = spark.createDataFrame(cells, "league string, ord long, cell string")
    got = sorted(clean_feed(df, limit=3).collect(), key=lambda r: r.first_ord)
    assert [(r.name, r.first_ord) for r in got] == [("name a", 0), ("name b", 2), ("name c", 4)]


def test_snapshot_stamp(spark):
    stamp = spark.range(1).select(snapshot_stamp(F.lit("2026-01-02 03:04:59").cast("timestamp_ntz"))).first()[0]
    assert stamp == "02012026_0304"

import random
from collections import defaultdict

import pytest

from rollcall.llm.mixing import SURE, balanced, flight, land, mixed, move, spaced
from llm_rows import ODD


def slow_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Caps are held and the excess shared again by weight, until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, held = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in held]
        left = total - sum(held.values())
        given = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if given[s] > most * sizes[s]]
        if not over:
            return {**held, **given}
        held.update((s, most * sizes[s]) for s in over)


def test_a_move_keeps_both_sums_and_decides_one():
    draw = random.Random(1)
    for _ in range(2000):
        units = [[draw.choice([0, 1, 5, 5, 70, 9000]), draw.uniform(0.001, 0.999)] for _ in range(3)]
        before = sum(a * p for a, p in units), sum(p for _, p in units)
        move(units, draw)
        assert any(p in (0.0, 1.0) for _, p in units) and all(0 <= p <= 1 for _, p in units)
        assert sum(a * p for a, p in units) == pytest.approx(before[0], abs=1e-4)
        assert sum(p for _, p in units) == pytest.approx(before[1], abs=1e-6)


def test_moves_keep_expected_values():
    draw, mean = random.Random(2), [0.0] * 3
    for _ in range(20_000):
        units = [[10, 0.3], [40, 0.6], [90, 0.5]]
        move(units, draw)
        mean = [m + u[1] / 20_000 for m, u in zip(mean, units, strict=True)]
    assert mean == pytest.approx([0.3, 0.6, 0.5], abs=0.02)


def test_the_flight_leaves_two_and_keeps_totals():
    draw = random.Random(3)
    units = [[draw.randrange(1, 5000), 0.37, i] for i in range(3000)]
    total = sum(u[0] for u in units) * 0.37
    out = list(flight(sorted((list(u) for u in units), reverse=True), draw))
    assert sorted(u[2] for u in out) == list(range(3000))
    assert sum(u[1] not in (0.0, 1.0) for u in out) <= 2
    assert sum(u[0] * u[1] for u in out) == pytest.approx(total, rel=1e-6)
    assert sum(u[1] for u in out) == pytest.approx(0.37 * 3000, rel=1e-6)


def test_landing_takes_the_closest_sample():
    draw = random.Random(4)
    for _ in range(200):
        units = [[draw.randrange(200), draw.random()] for _ in range(draw.randrange(1, 8))]
        want = sum(a * p for a, p in units)
        best = min(abs(sum(u[0] for j, u in enumerate(units) if i >> j & 1) - want) for i in range(1 << len(units)))
        land(units)
        assert all(p in (0.0, 1.0) for _, p in units)
        assert abs(sum(a * p for a, p in units) - want) == pytest.approx(best, abs=1e-5)


def test_kept_units_halve():
    kept = []
    rest = list(spaced([[s, 0.5] for s in (100, 90, 51, 50, 40, 25, 3, 2, 1)], 4, kept))
    assert [u[0] for u in kept] == [100, 50, 25, 3] and [u[0] for u in rest] == [90, 51, 40, 2, 1]


def rows(spark, docs, **how):
    return mixed(docs, **how).collect()


def documents(spark, seed, n, sources):
    draw = random.Random(seed)
    data = [(i, "w " * draw.choice([0, 1, 7, 30, 120, 900]), draw.choice(sources)) for i in range(n)]
    return data, spark.createDataFrame(data, "doc_id long, text string, source string")


def test_taken_words_reach_the_targets(spark):
    sources = ["a", "B", "é", None, "big", "big", "big", "big", "big", "big"]
    data, docs = documents(spark, 5, 1500, sources)
    got = rows(spark, docs, block=100)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for i, text, source in data:
        sizes[source] += len(text.split())
    assert sorted(r.id for r in got) == list(range(1500))
    want = slow_targets(sizes)
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.source_size == sizes[r.source] and r.taken == r.size * r.copies and 0 <= r.copies <= 2
    assert target == pytest.approx(want)
    for source in sizes:
        assert abs(taken[source] - want[source]) <= max(5, 0.002 * want[source])


def test_reruns_agree_however_the_rows_are_dealt(spark):
    _, docs = documents(spark, 6, 400, ["a", "b"])
    one = sorted((r.id, r.taken) for r in rows(spark, docs.repartition(1), block=60))
    two = sorted((r.id, r.taken) for r in rows(spark, docs.repartition(7, "text"), block=60))
    assert one == two


def test_blocks_meet_until_all_are_decided(spark):
    draw = random.Random(7)
    units = spark.createDataFrame([(p, i, draw.randrange(1, 300), 0.4) for p in (0, 1) for i in range(500)], "place long, id long, size long, chance double")
    got = balanced(units, block=40, landing=8).collect()
    assert len(got) == 1000 and {r.chance for r in got} == {0.0, 1.0}
    for p in (0, 1):
        own = [r for r in got if r.place == p]
        assert abs(sum(r.size * (r.chance - 0.4) for r in own)) < 5
        assert abs(sum(r.chance - 0.4 for r in own)) < 12


def test_odd_rows_and_empty_tables(spark, odd, none):
    got = rows(spark, odd)
    assert sorted((r.id is None, r.id or 0) for r in got) == sorted((i is None, i or 0) for i, _ in ODD)
    assert all(r.taken == 0 for r in got if r.size == 0)
    assert rows(spark, none) == []
    bare = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in rows(spark, bare)] == [(0, 0.0, 0)] * 2
    assert 0 < SURE < 1e-6


def test_names_that_clash(spark):
    docs = spark.createDataFrame([(1, "a b c", "x", 5, 0.1, "p"), (2, "a", "y", 6, 0.2, "q")], "doc_id long, text string, source string, size int, chance double, place string")
    assert {r.id: r.size for r in rows(spark, docs)} == {1: 3, 2: 1}

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.functions import lcs
from rollcall.operators import fuzzy
from rollcall.operators.fuzzy import best_match, gate, score, similarity


def plain_similarity(a, b):
    """Textbook dynamic programme."""
    row = [0] * (len(b) + 1)
    for x in a:
        built = [0]
        for j, y in enumerate(b):
            built.append(row[j] + 1 if x == y else max(row[j + 1], built[j]))
        row = built
    return 200.0 * row[-1] / (len(a) + len(b)) if a and b else 0.0


def texts(rnd, n, longest=(0, 1, 5, 20, 63, 64, 65, 130, 300), letters="abcde é😀ō"):
    return ["".join(rnd.choice(letters) for _ in range(rnd.choice(longest))) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_match_the_textbook(seed):
    rnd = random.Random(seed)
    left, right = texts(rnd, 150), texts(rnd, 150)
    want = np.array([plain_similarity(a, b) for a, b in zip(left, right)])
    assert np.array_equal(lcs.pair_similarity(left, right), want)
    assert np.array_equal(lcs.pair_similarity(right, left), want)
    assert ((want >= 0) & (want <= 100)).all()


@pytest.mark.parametrize("seed", [1, 2])
def test_best_match_is_the_arg_max(seed, monkeypatch):
    monkeypatch.setattr(lcs, "MASK_BYTES", 1 << 14)  # many small pieces
    rnd = random.Random(seed)
    names, cands = texts(rnd, 60), texts(rnd, 80) + ["abc"] * 3
    ords = list(range(len(cands)))
    rnd.shuffle(ords)
    row, sim = lcs.BestMatch(cands, ords).find(names)
    for i, name in enumerate(names):
        scored = [(-plain_similarity(name, c), o, j) for j, (c, o) in enumerate(zip(cands, ords))]
        loss, _, j = min(scored)
        assert (row[i], sim[i]) == (j, -loss)


def test_floor_hides_what_is_worse():
    row, sim = lcs.BestMatch(["abcd", "xyz"], [0, 1]).find(["abcd", "abxx", "qq"], [100.0, 90.0, -1.0])
    assert list(row) == [0, -1, 0] and sim[0] == 100.0


@pytest.mark.parametrize(
    "a,b,points",
    [
        ("Red Foxes FC", "Red Foxes FC", 100),
        ("red foxes", "Red Foxes FC", 86),
        ("FC Red-Foxes", "Red Foxes FC", 100),
        ("qqqq", "Red Foxes FC", 0),
        ("gazelle", "Gazelle FC", 82),
        ("marble stone rovers", "Marble Stone Rovers FC", 93),
        ("dutton utd", "Dutton United FC", 77),
        ("abcdexyz", "abcdeuvw", 62),  # 62.5
        ("abcdefgx", "abcdefgy", 88),  # 87.5
        ("", "", 0),
        ("--", "abc", 0),
    ],
)
def test_worked_scores(spark, a, b, points):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(score(similarity(F.col("a"), F.col("b")))).first()[0] == points
    assert df.select(score(similarity(F.col("b"), F.col("a")))).first()[0] == points


def test_similarity_of_null_is_null(spark):
    rows = [("a", "a"), (None, "a"), ("a", None), ("ab", "b")]
    df = spark.createDataFrame(rows, "a string, b string").coalesce(1)
    assert [r[0] for r in df.select(score(similarity(F.col("a"), F.col("b")))).collect()] == [100, None, None, 67]


def test_gate_is_strict(spark):
    df = spark.createDataFrame([("x", 80), ("y", 81)], "best string, score long")
    got = [r[0] for r in df.select(gate(F.col("best"), F.col("score"))).collect()]
    assert got == ["UNKNOWN", "y"]


def dictionary(spark, names):
    rows = [(i, n, []) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "ord long, standard_name string, aliases array<string>")


def words(rnd, n, letters="abcdefgh"):
    def word():
        return "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 9)))

    return [" ".join(word() for _ in range(rnd.randint(1, 4))) for _ in range(n)]


@pytest.mark.parametrize("way", ["stream", "blocks"])
def test_whole_dictionary_is_searched(spark, way):
    rnd = random.Random(7)
    names = sorted({" ".join(sorted(w.split())) for w in words(rnd, 150)}) + [""]
    cands = words(rnd, 200) + ["b a", "a b"] + ["x" * 200, "---"]
    names += sorted({" ".join(sorted(c.split())) for c in cands[:20]} - set(names))
    keys = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "key string, extra long")
    options = {} if way == "stream" else {"small_rows": 10, "block_rows": 15, "group_keys": 40}
    found = best_match(keys, dictionary(spark, cands), **options)
    assert sorted(found.columns) == ["best", "extra", "key", "sim"]
    got = {r.key: (r.best, r.sim, r.extra) for r in found.collect()}
    assert len(got) == len(names)
    for i, name in enumerate(names):
        ready = [" ".join(sorted(c.replace("-", "").split())) for c in cands]
        scored = [(-plain_similarity(name, r), j, cands[j]) for j, r in enumerate(ready)]
        loss, _, best = min(scored)
        assert got[name] == (best, -loss, i)


def test_blocks_split_on_size_of_texts(spark):
    rnd = random.Random(3)
    cands = ["".join(rnd.choice("abc") for _ in range(rnd.randint(90, 110))) for _ in range(40)]
    keys = spark.createDataFrame([(c[:-1] + "z",) for c in cands[:10]], "key string")
    options = {"small_bytes": 10, "block_chars": 500, "group_keys": 3}
    got = {r.key: r.best for r in best_match(keys, dictionary(spark, cands), **options).collect()}
    for key, best in got.items():
        assert plain_similarity(key, best) == max(plain_similarity(key, c) for c in cands)


def test_empty_dictionary_gives_no_match(spark):
    keys = spark.createDataFrame([("a",)], "key string")
    assert [tuple(r) for r in best_match(keys, dictionary(spark, []).limit(0)).collect()] == [("a", None, 0.0)]


def changed(rnd, text, letters):
    for _ in range(rnd.randint(0, 5)):
        at = rnd.randint(0, len(text))
        text = text[:at] + (rnd.choice(letters) if rnd.random() < 0.5 else "") + text[at + rnd.randint(0, 1) :]
    return text


@pytest.mark.parametrize("nodes", [1 << 20, 2000])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_tree_finds_what_comparing_all_finds(seed, nodes, monkeypatch):
    monkeypatch.setattr(lcs, "NODES", nodes)  # few nodes: many texts leave the walk
    rnd = random.Random(seed)
    base = texts(rnd, 40, (0, 1, 5, 20, 30, 63, 64, 65, 130, 300))
    cands = [changed(rnd, rnd.choice(base), "abcde") for _ in range(300)] + ["", "", "abcd", "abcd"]
    names = [changed(rnd, rnd.choice(base), "abcdez") for _ in range(120)] + texts(rnd, 10)
    ords = list(range(len(cands)))
    rnd.shuffle(ords)
    for floor in (None, np.array([rnd.choice([-1.0, 60.0, 90.0, 100.0]) for _ in names])):
        want = lcs.BestMatch(cands, ords).find(names, floor)
        found = lcs.Tree(cands, ords, rows=37, chars=1000).find(names, floor)
        assert np.array_equal(found[0], want[0]) and np.array_equal(found[1], want[1])


def test_a_tree_of_many_names_looks_at_few_of_them(monkeypatch):
    seen, walked = [], []
    real = np.repeat
    monkeypatch.setattr(lcs.Tree, "_compare", lambda self, texts, which, *_: seen.append(len(which)))
    cands = [f"{i * 7:07d} customer" for i in range(20_000)]
    names = [f"{i * 131 + 3:07d} customer" for i in range(300)]
    tree = lcs.Tree(cands, range(len(cands)))
    monkeypatch.setattr(lcs.np, "repeat", lambda a, fan: walked.append(len(a)) or real(a, fan))
    row, sim = tree.find(names)
    monkeypatch.undo()
    assert (row >= 0).all() and sum(seen) == 0
    assert sum(walked) < len(names) * len(cands) / 10
    want = lcs.BestMatch(cands, range(len(cands))).find(names[:40])
    assert np.array_equal(want[0], row[:40]) and np.array_equal(want[1], sim[:40])


def test_blocks_are_copied_no_more_than_keys_meet_them(spark, tmp_path, monkeypatch):
    log, real = str(tmp_path / "met"), fuzzy._best_in_block

    def noted(keys, block, *levels):
        with open(log, "a") as f:
            f.write(f"{len(keys)} {len(block)}\n")
        return real(keys, block, *levels)

    monkeypatch.setattr(fuzzy, "_best_in_block", noted)
    monkeypatch.setattr(fuzzy, "LEAST_KEYS", 1)
    for name in ("COPIED_ROWS", "WAVE_SHARE"):
        monkeypatch.setattr(fuzzy, name, 0, raising=False)
    monkeypatch.setattr(fuzzy, "WAVE_PAIRS", 500, raising=False)
    rnd = random.Random(5)
    cands = sorted({" ".join(sorted(w.split())) for w in words(rnd, 300)})
    names = sorted({changed(rnd, rnd.choice(cands), "abcdefgh").strip() for _ in range(400)} | {"x" * 70, "", "zzz"})
    rows = best_match(spark.createDataFrame([(n,) for n in names], "key string"), dictionary(spark, cands), small_rows=1, block_rows=30)
    got = {r.key: (r.best, r.sim) for r in rows.collect()}
    sims = {n: lcs.pair_similarity([n] * len(cands), cands) for n in names}
    assert got == {n: (cands[int(s.argmax())], s.max()) for n, s in sims.items()}
    met = [tuple(map(int, line.split())) for line in open(log)]
    pairs, copied = map(sum, zip(*met))
    assert copied <= pairs + (len(lcs.LEVELS) + 2) * len(cands)
    assert pairs < len(names) * len(cands) / 30 * 1.5


@pytest.mark.parametrize("back", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_routes_leave_out_no_block_that_holds_enough(seed, back):
    rnd = random.Random(seed)
    base = texts(rnd, 30, (0, 1, 5, 20, 30, 63, 64, 65, 130, 300))
    cands = sorted({changed(rnd, rnd.choice(base), "abcde") for _ in range(200)} | {""}, key=lambda t: t[::-1] if back else t)
    names = [changed(rnd, rnd.choice(base), "abcdez") for _ in range(60)] + texts(rnd, 10)
    blocks = {i: cands[i : i + 20] for i in range(0, len(cands), 20)}
    for most in (1, 3, 64):
        covers = [(i, *c) for i, block in blocks.items() for c in lcs.cover(block, back, most)]
        floor = np.array([rnd.choice([-1.0, 0.0, 40.0, 60.0, 80.0, 90.0, 97.0]) for _ in names])
        text, block = lcs.Routes(*zip(*covers), back).find(names, floor)
        asked = set(zip(text.tolist(), block.tolist()))
        for i, name in enumerate(names):
            for at, held in blocks.items():
                assert (i, at) in asked or lcs.pair_similarity([name] * len(held), held).max() < floor[i]


def test_routes_leave_out_blocks_of_other_names():
    cands = sorted(f"{word} {i:05d}" for word in ("amber", "birch", "cedar", "daisy") for i in range(500))
    blocks = {i: cands[i : i + 100] for i in range(0, len(cands), 100)}
    covers = [(i, *c) for i, block in blocks.items() for c in lcs.cover(block, False)]
    text, block = lcs.Routes(*zip(*covers), False).find([f"cedar {i:05d}" for i in range(7, 500, 20)], np.full(25, 97.0))
    assert len(text) <= 2 * 25 and all(cands[i].startswith("cedar") for i in block)

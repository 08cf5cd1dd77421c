import random

import xxhash

from rollcall.llm.components import components
from rollcall.llm.simhash import fingerprint, keep_one, near_duplicates, near_links
from llm_rows import ODD, prose


def slow_fingerprint(text, shingle):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    if not words:
        return 0
    runs = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def groups_by_pairs(fps, distance):
    root = {f: f for f in fps}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    fps = sorted(root)
    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= distance:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {f: top(f) for f in fps}


def test_fingerprint_equals_the_definition():
    for _, text in ODD:
        if text is None or len(text) < 10_000:
            for shingle in (1, 3):
                assert fingerprint(text, shingle) == slow_fingerprint(text, shingle)
    assert fingerprint(None, 3) == fingerprint("  ", 3) == 0


def test_spark_and_python_hash_alike(spark):
    row = spark.sql("SELECT xxhash64('one two three')").first()[0]
    assert row & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"one two three", 42)


def test_links_connect_what_all_pairs_connect(spark):
    draw = random.Random(5)
    fps = [draw.getrandbits(64) - (1 << 63) for _ in range(150)] + [0, -1]
    for f in list(fps):
        for _ in range(draw.randrange(5)):
            for _ in range(draw.randrange(1, 4)):
                f ^= 1 << draw.randrange(64)
            fps.append(f - (1 << 64) if f >= 1 << 63 else f)
    fps = [((f + (1 << 63)) % (1 << 64)) - (1 << 63) for f in fps]
    table = spark.createDataFrame([(f,) for f in sorted(set(fps))], "fp long")
    for distance in (0, 1, 2):
        links = near_links(table, distance)
        assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= distance for r in links.collect())
        found = {f: f for f in fps} | {r.node: r.component for r in components(links).collect()}
        assert found == groups_by_pairs(fps, distance)


def test_component_is_the_least_id_reachable(docs_of):
    texts = [(50, "a b c"), (7, "A  B\tc"), (9, prose(3, 80)), (8, prose(4, 80)), (3, None), (2, "")]
    got = {r.id: r.component_id for r in near_duplicates(docs_of(texts)).collect()}
    assert got == {50: 7, 7: 7, 9: 9, 8: 8, 3: 2, 2: 2}


def test_odd_rows(odd, none):
    rows = near_duplicates(odd).collect()
    assert len(rows) == len(ODD)
    assert sorted((r.id, r.fp) for r in rows if r.id is not None) == sorted(
        (i, fingerprint(t, 3)) for i, t in ODD if i is not None
    )
    want = groups_by_pairs([fingerprint(t, 3) for _, t in ODD], 2)
    least = {}
    for i, t in ODD:
        if i is not None:
            least[want[fingerprint(t, 3)]] = min(i, least.get(want[fingerprint(t, 3)], i))
    assert all(r.component_id == least[want[r.fp]] for r in rows)
    assert near_duplicates(none).collect() == []
    assert keep_one(none).collect() == []
    assert keep_one(odd).columns == odd.columns


def test_long_path_and_hub(spark):
    path = [(i, i + 1) for i in range(60)]
    hub = [(1000, i) for i in range(1001, 1300)]
    edges = spark.createDataFrame([*path, *hub, (5, 4), (7, 7), (None, 3)], "a long, b long")
    found = {r.node: r.component for r in components(edges).collect()}
    assert found == {i: 0 for i in range(61)} | {i: 1000 for i in range(1000, 1300)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_rows_decide_not_ids(spark):
    from llm_rows import prose

    near = prose(1, 300)
    other = near.replace(" ", "  ", 1)
    rows = [(1, near, "a"), (1, prose(2, 300), "b"), (None, other, "c"), (None, prose(3, 300), "d"), (2, near, "e"), (None, prose(3, 300), "f")]
    kept = keep_one(spark.createDataFrame(rows, "doc_id long, text string, mark string").coalesce(1)).collect()
    assert sorted(r.mark for r in kept) == ["a", "b", "d"]
    twice = keep_one(spark.createDataFrame([(5, near, "x")] * 3, "doc_id long, text string, at string"))
    assert [tuple(r) for r in twice.collect()] == [(5, near, "x")]

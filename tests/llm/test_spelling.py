import random
from collections import Counter, defaultdict
from zlib import crc32

from rollcall.llm.spelling import Scan, count_words, variants
from llm_rows import ODD


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    p = 0
    while p < len(a) and a[p] == b[p]:
        p += 1
    return a[p + 1 :] == b[p + 1 :] if len(a) == len(b) else a[p:] == b[p + 1 :]


def slow_variants(counts, ratio=10):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, n in counts.items():
        if near[w]:
            best = min(near[w], key=lambda v: (-counts[v], v))
            if counts[best] >= ratio * n:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items())


def found(spark, counts, **how):
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in variants(words, **how).collect())


def test_scan_finds_all_pairs_of_each_key():
    draw = random.Random(1)
    for _ in range(150):
        keys = []
        for _ in range(draw.randrange(1, 5)):
            start = "".join(draw.choice("ab") for _ in range(draw.randrange(4)))
            words = {start + "".join(draw.choice("abc") for _ in range(draw.randrange(0 if start else 1, 6))) for _ in range(20)}
            keys.append(sorted(words))
        words = [w for key in keys for w in key]
        starts = [sum(map(len, keys[:i])) for i in range(len(keys))]
        got = sorted((int(i), int(j)) for a, b in Scan(words, starts).pairs() for i, j in zip(a, b, strict=True))
        want = [(i + s, j + s) for s, key in zip(starts, keys, strict=True) for j in range(len(key)) for i in range(j) if one_edit(key[i], key[j])]
        assert got == sorted(want)


def words_of(draw, n, letters, low, high):
    counts = {}
    while len(counts) < n:
        word = "".join(draw.choice(letters) for _ in range(draw.randrange(low, high)))
        counts[word] = draw.choice([2, 2, 3, 20, 200, 5000])
    return counts


def test_variants_equal_brute_force(spark):
    counts = words_of(random.Random(2), 400, "abé", 7, 11)
    assert found(spark, counts) == slow_variants(counts)


def test_crowded_keys_are_keyed_anew_without_loss(spark):
    counts = words_of(random.Random(3), 300, "ab", 7, 10)
    assert found(spark, counts, block=60) == slow_variants(counts)


def test_short_and_very_long_words(spark):
    long = "abcdefg" * 3000
    counts = {"a": 2, "b": 30, "ab": 2, "ba": 2, long: 100, long[:5000] + long[5001:]: 3, long + "x": 4, "alone": 9}
    assert found(spark, counts) == slow_variants(counts)


def test_forms_are_followed_to_the_last(spark):
    counts = {"aaaaaaa": 100_000, "aaaaaab": 9_000, "aaaaabb": 800, "aaaabbb": 70, "aaabbbb": 6}
    roots = {r[0]: r[2] for r in found(spark, counts)}
    assert set(roots.values()) == {"aaaaaaa"}


def test_equal_counts_take_the_first_word(spark):
    got = {r[0]: r[1] for r in found(spark, {"worders": 2, "wonders": 40, "workers": 40, "worderz": 1})}
    assert got["worders"] == "wonders"


def test_counted_words_equal_the_definition(spark, odd):
    def slow(rows):
        counts = Counter()
        for id, text in rows:
            run = ""
            for c in (text or "") + " ":
                if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                    run += c.lower() if c.isascii() else c
                    continue
                if run:
                    h = crc32(f"{'' if id is None else id}:{run}".encode())
                    counts[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
                run = ""
        return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}

    draw = random.Random(4)
    rows = [(i, " ".join("".join(draw.choice("aBÉö") for _ in range(draw.randrange(5, 10))) for _ in range(900))) for i in range(6)]
    rows += rows[:2] + [(None, rows[3][1]), (9, "x" * 200_000 + " Garden-garden GARDENS gardens")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.word: r.n for r in count_words(docs).collect()} == slow(rows)
    assert {r.word: r.n for r in count_words(odd).collect()} == slow(ODD)


def test_no_words_give_no_rows(spark, none):
    assert variants(count_words(none)).collect() == []
    assert variants(count_words(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"))).collect() == []


def test_every_pair_has_one_owner(spark):
    counts = words_of(random.Random(5), 200, "ab", 7, 9)
    near = defaultdict(int)
    for r in found(spark, counts):
        near[r[0]] = r[4]
    assert sum(near.values()) == 2 * sum(one_edit(a, b) for i, a in enumerate(counts) for b in list(counts)[:i])

import random
import re
from collections import Counter, defaultdict

import numpy as np

from rollcall.llm import collocations
from rollcall.llm.collocations import Block, best, collocations as mined, frequent, merged
from llm_rows import ODD


def slow(rows, often=10, listed=2000, within=50):
    n, f, out = Counter(), defaultdict(Counter), []
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= often}
        kept = []
        for p, a in candidates.items():
            if any(100 * b >= within * a and len(q) > len(p) and p in (q[:2], q[1:]) for q, b in candidates.items()):
                continue
            cuts = [(10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:listed], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def rows_of(found):
    return sorted((r.group, r.rank, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found.collect())


def corpus(seed, docs):
    draw = random.Random(seed)
    words = [f"{draw.choice('aéB')}{i % 23}" for i in range(40)]
    ends = [" ", " ", " ", " ", "\t", ". ", ",", "\n", "  ", " - "]
    text = lambda: "".join(words[int(draw.paretovariate(0.7)) % 40] + draw.choice(ends) for _ in range(draw.randrange(300)))
    return [(draw.choice(["en", "en", "en", "fr", None]), text()) for _ in range(docs)]


def test_equals_brute_force(spark):
    rows = corpus(1, 60) + [("en", None), (None, ""), ("fr", " .,\n ")]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert rows_of(mined(docs)) == slow(rows)
    assert rows_of(mined(docs, often=3, listed=7, within=80)) == slow(rows, 3, 7, 80)


def test_blocks_and_partitions_do_not_show(spark, monkeypatch):
    rows = corpus(2, 40)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    monkeypatch.setattr(collocations, "BLOCK_WORDS", 50)
    monkeypatch.setattr(collocations, "MASS", 500)
    assert rows_of(mined(docs)) == slow(rows)


def test_a_full_table_of_bits_costs_rows_but_no_result(spark, monkeypatch):
    rows = corpus(3, 30)
    monkeypatch.setattr(collocations, "SLICE_BITS", 3)
    assert rows_of(mined(spark.createDataFrame(rows, "lang string, text string"))) == slow(rows)


def test_summaries_keep_every_frequent_key():
    draw = np.random.default_rng(4)
    for often in (2, 10, 40):
        blocks, total = [], Counter()
        for _ in range(30):
            keys, counts = np.unique(draw.zipf(1.3, 3000) % 5000, return_counts=True)
            total.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
            blocks.append((keys.astype("<u4").tobytes(), counts.astype("<u4").tobytes()))
        got = set(frequent(blocks, often).tolist())
        assert {k for k, n in total.items() if n >= often} <= got


def test_a_merge_takes_off_what_the_next_counter_has():
    keys, counts, off = merged(np.array([3, 1, 3, 2, 9], np.uint32), np.array([4, 5, 1, 2, 1]), 2)
    assert (keys.tolist(), counts.tolist(), off) == ([1, 3], [3, 3], 2)
    keys, counts, off = merged(np.array([7], np.uint32), np.array([2]), 2)
    assert (keys.tolist(), counts.tolist(), off) == ([7], [2], 0)


def test_numbers_that_pass_63_bits_are_made_anew(monkeypatch):
    def counted(block, names):
        _, two, three = block.phrases()
        return [Counter(dict(zip(zip(*([names[i] for i in p.tolist()] for p in parts), strict=True), times.tolist(), strict=True))) for parts, times in (two, three)]

    block = Block()
    block.add("en", [b"a", b"b", b"a", b"b", b"a", b".", b"b", b"a"])
    few = counted(block, block.words)
    block.words += [str(i).encode() for i in range(3_000_000)]  # as if a block had so many
    assert counted(block, block.words) == few
    assert few[0] == {(b"a", b"b"): 2, (b"b", b"a"): 3} and few[1] == {(b"a", b"b", b"a"): 2, (b"b", b"a", b"b"): 1}


def test_scores_beyond_64_bits_are_exact(spark):
    big = 3_000_000_019
    counts = [("g", 1, "x", big), ("g", 1, "y", big + 7), ("g", 2, "x y", big - 5), ("g", 0, "", 4 * big)]
    table = spark.createDataFrame(counts, "group string, k int, phrase string, n long")
    row = collocations.scored(table).first()
    assert row.score == 10**6 * (big - 5) ** 2 // (big * (big + 7)) and (row.l, row.r) == (big, big + 7)


def test_best_rows_in_parts_equal_one_sort(spark):
    draw = random.Random(6)
    rows = [("g", f"p{i}", draw.randrange(50), draw.randrange(5)) for i in range(900)]
    table = spark.createDataFrame(rows, "group string, phrase string, score long, a long")
    want = sorted(rows, key=lambda r: (-r[2], -r[3], r[1]))[:20]
    assert [(r.group, r.phrase) for r in best(table, 20, ranked=80).orderBy("rank").collect()] == [r[:2] for r in want]


def test_odd_rows_long_texts_and_empty_tables(spark, odd, none):
    want = slow([("en", t) for _, t in ODD])
    assert rows_of(mined(odd)) == want and want
    assert mined(none).collect() == []

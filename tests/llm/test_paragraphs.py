import random
import re

import numpy as np

from rollcall.llm.paragraph_minhash import (
    anchors,
    keys,
    linked,
    mixed_runs,
    repeated,
    repeated_paragraphs,
    repeated_passages,
    shingles,
    tuned,
    word_hashes,
)
from llm_rows import ODD, prose


def by_hand(rows, similar=0.8, size=5):
    lines = []
    for i, t in rows:
        for n, line in enumerate((t or "").split("\n")) if t is not None else []:
            norm = re.sub(r"\s+", " ", line.lower()).strip()
            if norm and len(norm.split(" ")) >= size:
                lines.append((i, n, norm))
    texts = sorted({x for _, _, x in lines})
    sets, root = [shingles(x, size) for x in texts], list(range(len(texts)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both / len(sets[a] | sets[b]) >= similar:
                root[top(a)] = top(b)
    groups = {}
    for i, n, x in lines:
        groups.setdefault(top(texts.index(x)), []).append((i, n))
    order = lambda x: (x[0] is None, x[0] or 0, x[1])
    return sorted(((*x, *min(g, key=order), len(g)) for g in groups.values() if len(g) > 1 for x in g), key=repr)


def corpus(n=60):
    draw, rows = random.Random(2), []
    base = [prose(100 + k, 60) for k in range(4)]
    for i in range(n):
        lines = [prose(i, 12)]
        for _ in range(draw.randrange(3)):
            words = draw.choice(base).split()
            for _ in range(draw.randrange(4)):
                words[draw.randrange(len(words))] = f"edit{draw.randrange(50)}"
            lines.append(" ".join(words))
        rows.append((i, "\n".join(lines)))
    return rows


def test_same_groups_as_all_pairs(docs_of):
    rows = corpus()
    want = by_hand(rows)
    for block in (2048, 7):
        got = repeated_paragraphs(docs_of(rows), block=block, rows=1, recall=0.999999)
        got = sorted(((r.id, r.para, r.keep_id, r.keep_para, r.group_size) for r in got.collect()), key=repr)
        assert got == want
    assert any(x[:2] != x[2:4] for x in want)


def test_bands_reach_the_recall():
    for similar, rows in ((0.8, 3), (0.8, 4), (0.5, 2)):
        bands = tuned(similar, rows, 0.999)
        assert (1 - similar**rows) ** bands <= 0.001 < (1 - similar**rows) ** (bands - 1)


def test_large_and_small_buckets_agree():
    texts = [t.split("\n")[-1] for _, t in corpus(90)]
    small = {frozenset(x) for x in linked(texts[:20], 0.8, 5)}
    big = linked(texts, 0.8, 5)

    def parts(pairs, n):
        root = list(range(n))
        for a, b in pairs:
            x, y = root[a], root[b]
            root = [x if r == y else r for r in root]
        return {frozenset(i for i in range(n) if root[i] == r) for r in root}

    whole = parts([(a, b) for a in range(90) for b in range(a) if len(shingles(texts[a]) & shingles(texts[b])) >= 0.8 * len(shingles(texts[a]) | shingles(texts[b]))], 90)
    assert parts(big, 90) == whole and len(big) == 90 - len(whole)
    assert all(len(x) == 2 for x in small)


def test_odd_rows(odd, none):
    got = repeated_paragraphs(odd)
    assert sorted(((r.id, r.para, r.keep_id, r.keep_para, r.group_size) for r in got.collect()), key=repr) == by_hand(ODD)
    assert repeated_paragraphs(none).collect() == []


def test_passages_within_lines(docs_of):
    copied = prose(900, 50)
    places = {0: (0, 90), 1: (37, 0), 2: (140, 61), 3: (11, 200)}
    rows = [(i, f"{prose(10 + i, a)} {copied} {prose(30 + i, b)}".strip()) for i, (a, b) in places.items()]
    wrapped = copied.split(" ")
    rows += [(4, prose(50, 70)), (5, f"{prose(51, 30)}\n{' '.join(wrapped[:20])}\n{' '.join(wrapped[20:])} {prose(52, 9)}")]
    assert repeated_paragraphs(docs_of(rows[:5])).collect() == []
    places[5] = (30, 9)
    got = repeated_passages(docs_of(rows)).collect()
    assert {r.id for r in got} == places.keys()
    for r in got:
        words = rows[r.id][1].split()
        assert places[r.id][0] <= r.start < r.end <= places[r.id][0] + 50 and r.end - r.start == 25
        assert words[r.start : r.end] == rows[r.keep_id][1].split()[r.keep_start : r.keep_end]
        assert r.kept == ((r.id, r.start) == (r.keep_id, r.keep_start))
    assert {r.id for r in got if r.group_size == 5 and r.keep_id == 0} == places.keys()


def test_every_shared_run_of_fifty_words_holds_a_shared_unit():
    for seed in range(200):
        copied, starts = prose(seed, 50).split(), []
        for a, b in ((seed % 70, 33), (3 * seed % 80, 0)):
            words = [*prose(1000 + seed + a, a).split(), *copied, *prose(2000 + seed + a, b).split()]
            at = anchors(mixed_runs(word_hashes(words), 5), len(words), 50, 25)
            starts.append({x - a for x in at.tolist() if 0 <= x - a <= 25})
        assert starts[0] & starts[1]


def test_passages_of_odd_rows(odd, none, docs_of):
    assert repeated_passages(docs_of([prose(k, 400) for k in range(20)])).collect() == []
    assert repeated_passages(none).collect() == []
    got = repeated_passages(odd).collect()
    assert {r.id for r in got} == {7, 8, 9} and max(r.group_size for r in got) == 30_001 // 25 - 1
    assert {(r.keep_id, r.kept) for r in got if r.id == 9} == {(8, False)}
    assert repeated_passages(docs_of([prose(1, 49), prose(1, 49)])).collect() == []


def test_numbers_tell_equal_pieces():
    draw = random.Random(5)
    words = [draw.choice("abcd") for _ in range(3000)]
    own = word_hashes(words)
    spans = np.array([(x, x + draw.randrange(1, 9)) for x in range(2900)])
    a, b = keys(own, spans)
    by_text, by_key = {}, {}
    for (x, y), k in zip(spans.tolist(), zip(a.tolist(), b.tolist(), strict=True), strict=True):
        by_text.setdefault(" ".join(words[x:y]), set()).add(k)
        by_key.setdefault(k, set()).add(" ".join(words[x:y]))
    assert all(len(x) == 1 for x in by_text.values()) and all(len(x) == 1 for x in by_key.values())


def test_both_kinds_from_one_pass(docs_of, odd):
    copied = prose(900, 60)
    rows = [*corpus(30), (70, f"{prose(71, 40)} {copied}"), (71, f"{copied} {prose(72, 25)}"), (72, prose(73, 60))]
    whole = lambda df, *names: sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)
    line, unit = ("id", "para", "keep_id", "keep_para", "group_size", "kept"), ("id", "start", "keep_id", "keep_start", "group_size", "kept")
    for docs in (docs_of(rows), odd):
        both = repeated(docs).persist()
        assert whole(both.filter("para is not null"), *line) == whole(repeated_paragraphs(docs), *line)
        assert whole(both.filter("para is null"), *unit) == whole(repeated_passages(docs), *unit)
        both.unpersist()


def test_groups_within_one_document_and_short_lines(docs_of):
    long, short, far = prose(1, 60), prose(2, 19), prose(3, 70)
    rows = [(1, f"{long}\n{short}\n{long}"), (2, f"{far}\n{short}"), (3, far), (None, prose(4, 60)), (None, prose(4, 60))]
    got = repeated(docs_of(rows), least=20, within=False).collect()
    assert {(r.id, r.para, r.keep_id, r.group_size, r.kept) for r in got if r.para is not None} == {(2, 0, 2, 2, True), (3, 0, 2, 2, False)}
    assert {r.id for r in got if r.para is None} == {2, 3}
    got = repeated(docs_of(rows), least=20).collect()
    assert {r.id for r in got if r.para is not None} == {r.id for r in got if r.para is None} == {1, 2, 3, None}

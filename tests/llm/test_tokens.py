import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from rollcall.llm import token_counts
from rollcall.llm.merges import merges
from rollcall.llm.packing import fullest, pack, packed, plan, powers
from rollcall.llm.pretokens import _library, cut, encode_texts
from llm_rows import ODD, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")


def ids_of(text):
    return _library(PATH).encode(text or "", add_special_tokens=False).ids


def test_cuts_change_no_id():
    draw = random.Random(1)
    bits = [" ", "  ", "\n", "\t", "a", "é", "日", "٣", "5", "½", "²", "_", "-", "'s", "'", ".", "!!", "|", "ª", "ß", "\u0301"]
    bits += ["😀", "\u200b", "\x1c", "\x85", "\xa0", "<|endoftext|>", "the", "İ", "×", "\x00"]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randrange(14))) for _ in range(4000)]
    for at in range(0, len(texts), 100):
        for text, ids in zip(texts[at : at + 100], encode_texts(texts[at : at + 100], PATH), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == ids_of(text)
            assert "".join(cut(text, PATH)) == text


def test_merges_equal_the_library():
    draw, table = random.Random(7), merges(PATH)
    assert table.plain
    words = ["".join(draw.choice("etaoinshrdluéßÉTHE") for _ in range(draw.randrange(1, 25))) for _ in range(3000)] + ["a", "é", "aaaaaaaaaaaaaaaa"]
    words += [" " + w for w in words]
    for word, ids in zip(words, table.encode([w.encode() for w in words]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == ids_of(word)
    assert table.encode([]) == [] and encode_texts([], PATH) == [] and encode_texts(["", "a  b"], PATH)[0] == b""


def test_counts_equal_the_library(odd, none, docs_of, monkeypatch):
    rows = token_counts.token_counts(odd, PATH).collect()
    want = sorted(((i, len((t or "").encode()), len(ids_of(t))) for i, t in ODD), key=repr)
    assert sorted(((r.id, r.n_bytes, r.n_tokens) for r in rows), key=repr) == want
    assert token_counts.token_counts(none, PATH).collect() == []


def test_a_pre_token_beyond_sixteen_bits_and_many_blocks(docs_of):
    tokens, listed, ends = token_counts.postings(["x" + " y" * 140_000, " y"], PATH)
    at = tokens.to_pylist().index(" y")
    own = listed[(ends[at - 1] if at else 0) // 1 : ends[at]]
    assert own["times"].sum() == 140_001 and own["doc"].tolist().count(1) == 1
    texts = [prose(i, 30) for i in range(50)] + ["word " * 70_000]
    rows = token_counts.token_counts(docs_of(texts).repartition(5), PATH).collect()
    assert {r.id: r.n_tokens for r in rows} == {i: len(ids_of(t)) for i, t in enumerate(texts)}


def best_sum(lengths, window):
    sums = {0}
    for x in lengths:
        sums |= {s + x for s in sums if s + x <= window}
    return max(sums)


def test_fullest_filling_by_brute_force():
    from collections import Counter

    draw = random.Random(4)
    for _ in range(300):
        window = draw.randrange(1, 40)
        lengths = [draw.randrange(1, window + 1) for _ in range(draw.randrange(1, 12))]
        taken = fullest(Counter(lengths), window)
        assert sum(x * n for x, n in taken.items()) == best_sum(lengths, window)
        assert not taken - Counter(lengths)
        used = Counter()
        for filling, times in plan(Counter(lengths), window):
            used += Counter({x: n * times for x, n in filling.items()})
        assert used == Counter(lengths)


@pytest.mark.parametrize("seed", range(8))
def test_pack_is_whole_and_unpadded(seed):
    draw = random.Random(seed)
    window = draw.choice([16, 64, 2048])
    lengths = [draw.randrange(1, 3 * window) for _ in range(draw.randrange(200))] if seed else [window // 2 + 1] * 9
    pieces, n = pack(lengths, window)
    fill = {}
    for _, _, length, sequence, offset in pieces:
        fill.setdefault(sequence, []).append((offset, length))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window and at & (at - 1) == 0
    assert sorted(fill) == list(range(n))
    for doc, length in enumerate(lengths):
        at = 0
        for _, start, k, _, _ in sorted(p for p in pieces if p[0] == doc):
            assert start == at
            at += k
        assert at == length
    assert powers(13) == [8, 4, 1] and powers(0) == []


def test_packed_documents(odd, none):
    rows = packed(odd, PATH).collect()
    assert packed(none, PATH).collect() == []
    want = sorted(zlib.crc32(np.array([*ids_of(t), 1], "<u4").tobytes()) for _, t in ODD)
    docs = {}
    for r in sorted(rows, key=lambda r: (r.id is None, r.id or 0, r.start)):
        docs.setdefault((r.id, r.doc_tokens), []).append(bytes(r.ids))
        assert len(r.ids) == 4 * r.length
    whole = [b"".join(v) for (i, n), v in docs.items()]
    assert sum(map(len, whole)) == sum(4 * len([*ids_of(t), 1]) for _, t in ODD)
    assert {zlib.crc32(x) for x in whole if len(x) > 400} <= set(want)
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)

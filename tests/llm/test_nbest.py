import random

import public_tokenizers
import pytest

from rollcall.llm.nbest import MARK, decoded, encoded, least, parts_of, pieces, shown
from llm_rows import ODD

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def all_ways(known, s):
    found = []

    def go(at, score, ids):
        if at == len(s):
            found.append((score, ids))
            return
        for end, gain in known.edges(s, at):
            go(end, score + gain, ids + known.packed(s, [at, end]))

    go(0, 0.0, b"")
    return sorted(found, key=lambda x: -x[0])


def test_n_best_of_all_segmentations():
    known, draw = pieces(MODEL), random.Random(3)
    for _ in range(150):
        text = "".join(draw.choice("thealoi ng\nés日x▁") for _ in range(draw.randrange(1, 9)))
        ways = all_ways(known, MARK + text.replace(" ", MARK))
        for n in (1, 2, 5):
            got = known.segmentations(parts_of(text), n)
            assert [s for s, _, _ in got] == [s for s, _ in ways[:n]]
            assert len({ids for _, ids, _ in got}) == len(got)
            assert {x[:2] for x in got} <= set(ways)
            assert all(known.decode(ids) == shown(raw) == text.replace(MARK, " ") for _, ids, raw in got)


def test_pieces_are_those_of_the_library():
    from sentencepiece import SentencePieceProcessor

    model, known = SentencePieceProcessor(model_file=MODEL), pieces(MODEL)
    ids = model.encode("Hello  world\n x é 日本𓀀")
    import numpy as np

    assert known.decode(np.array(ids, "<u4").tobytes()) == model.decode(ids)


def test_forgetting_changes_nothing():
    known = pieces(MODEL)
    texts = ["the river and the stone " * 5, "other words"]
    want = [known.segmentations(parts, 4) for parts in known.learn(texts)]
    for _ in range(3):
        assert [known.segmentations(parts, 4) for parts in known.learn(texts, remembered=0)] == want
    assert set(known.best.before) >= set(parts_of(texts[0]))  # the generation before


def test_many_strings_at_once_equal_one_by_one():
    known, draw = pieces(MODEL), random.Random(9)
    letters = "thealoing sm▁é日x\x00😀𓀀"
    strings = {"".join(draw.choice(letters) for _ in range(draw.randrange(1, 12))) for _ in range(3000)} | {"q" * 90}
    known.best.clear()
    known.look_many(list(strings))
    assert dict(known.best) == {s: known.look(s) for s in strings}


@pytest.mark.parametrize(("losses", "n", "want"), [([3, 1, 1, 1], 2, [1, 2]), ([float("inf"), 2], 3, [1]), ([], 2, []), ([1], 0, [])])
def test_least(losses, n, want):
    assert least(losses, n) == want


def test_odd_rows_round_trip(odd, none):
    rows = decoded(encoded(odd, MODEL, 3), MODEL, text="back").collect()
    want = sorted((i is None, i or 0, t or "") for i, t in ODD)
    assert sorted((r.id is None, r.id or 0, r.back) for r in rows if r["rank"] == 1) == want
    empty = [r for r in rows if r.id in (0, 1)]
    assert [(r["rank"], r.score, bytes(r.ids)) for r in empty] == [(1, 0.0, b"")] * 2
    assert encoded(none, MODEL, 3).collect() == []

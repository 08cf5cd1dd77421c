"""The pipeline's stages, each against brute force on its own input, and on odd tables."""

import zlib

import numpy as np
import pytest
from llm_rows import ODD
from test_simhash import groups_by_pairs
from test_stream_dedup import by_hand

import corpus_pipeline
from __spark_entry__ import queries
from rollcall.llm.bradley_terry import GOOD, features
from rollcall.llm.guess_cost import masked
from rollcall.llm.pretokens import _library
from rollcall.llm.queries import BITS, BYTE_BPE, SHINGLE, quality_model
from rollcall.llm.simhash import fingerprint

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=repr)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of each stage, run over all documents."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "out")
        stage(spark, docs, SF).write.parquet(path)
        done = spark.read.parquet(path)
        out.append((name, docs, done))
        docs = done
    return out


def test_all_but_the_last_return_documents(stages):
    assert len(stages) == 5
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns == COLUMNS


def test_quality_keeps_what_scores_well(spark, stages):
    _, before, after = stages[0]
    model = quality_model(spark, SF)
    rows = before.collect()
    score = model.score(np.array([features(r.text) for r in rows]))
    assert rows_of(after) == sorted((tuple(r) for r, s in zip(rows, score, strict=True) if s >= GOOD), key=repr)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept, known = {r.doc_id for r in after.collect()}, {r.doc_id for r in rows} & labels.keys()
    assert all(i in kept for i in known if labels[i])
    assert sum((i in kept) == bool(labels[i]) for i in known) >= 0.95 * len(known)


def test_exact_copies_go(stages):
    _, before, after = stages[1]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert {r.doc_id for r in after.collect()} == {keep for _, keep, _ in by_hand(rows)}
    assert set(rows_of(after)) <= set(rows_of(before))


def test_one_of_each_group_of_near_copies_stays(stages):
    _, before, after = stages[2]
    prints = {r.doc_id: fingerprint(r.text, SHINGLE) for r in before.collect()}
    groups = groups_by_pairs(list(prints.values()), BITS)
    least = {}
    for i in sorted(prints):
        least.setdefault(groups[prints[i]], i)
    assert {r.doc_id for r in after.collect()} == set(least.values())


def test_secrets_are_masked(stages):
    _, before, after = stages[3]
    want = []
    for r in before.collect():
        text = masked(r.text, "[SECRET]")
        want.append((r.doc_id, text, r.lang, r.source, len(text) if text != r.text else r.n_chars))
    assert rows_of(after) == sorted(want, key=repr)


def test_pieces_hold_every_id(stages):
    _, before, after = stages[4]
    pieces = {}
    for r in after.collect():
        pieces.setdefault(r.doc_id, []).append(r)
    docs = {r.doc_id: r.text for r in before.collect()}
    assert pieces.keys() == docs.keys()
    for i, text in docs.items():
        ids = np.array([*_library(BYTE_BPE).encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for r in pieces[i]:
            assert r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        assert sum(r.length for r in pieces[i]) == len(ids)


def test_run_gives_the_last_stage(spark, stages):
    got = queries()["pipeline"](spark, SF)
    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    last = stages[4][2]
    assert got.columns == last.columns
    count = lambda df: sorted((r.doc_id, r.doc_tokens) for r in df.select(*keep).collect() if not r.start)
    assert count(got) == count(last)


@pytest.mark.parametrize("at", range(5))
def test_odd_tables_pass_every_stage(spark, odd, none, at):
    _, stage = corpus_pipeline.STAGES[at]
    docs = odd.select(*COLUMNS, "id", "row", "keep")
    out = stage(spark, docs, SF)
    if at < 4:
        assert out.columns == docs.columns
    rows = out.collect()
    assert 0 < len({r.doc_id for r in rows}) <= len({i for i, _ in ODD})
    assert stage(spark, none, SF).collect() == []

import re

import pytest
from pyspark.sql import functions as F

from rollcall.llm.stream_dedup import exact_duplicates, keep_first, land, update_state
from rollcall.session import scratch_path
from llm_rows import ODD


def by_hand(rows):
    norm = [(i, re.sub("[\x20\x09-\x0d]+", " ", t or "")) for i, t in rows]
    groups = {}
    for i, t in norm:
        groups.setdefault(t, []).append(i)
    least = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, least[t], len(groups[t])) for i, t in norm), key=repr)


@pytest.mark.parametrize("digest", [F.md5, lambda t: F.substring(F.md5(t), 1, 1), lambda t: F.lit("same")])
def test_full_texts_decide_whatever_the_digest(odd, digest):
    rows = exact_duplicates(odd, digest=digest).collect()
    assert sorted(((r.id, r.keep_id, r.group_size) for r in rows), key=repr) == by_hand(ODD)
    classes = {}
    for r in rows:
        classes.setdefault((r.keep_id, re.sub("[\x20\x09-\x0d]+", " ", r.row.text or "")), []).append(r.kept)
    assert all(sum(kept) == 1 for kept in classes.values())


def test_kept_rows_have_the_columns(odd, none):
    kept = keep_first(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({re.sub("[\x20\x09-\x0d]+", " ", t or "") for _, t in ODD})
    assert keep_first(none).collect() == []


def test_state_lives_on_between_runs(spark, docs_of):
    feed, state = scratch_path(spark, "feed"), scratch_path(spark, "state")
    land(docs_of([(5, "x"), (6, "y")]), feed + "/a", "doc_id", "text")
    schema = spark.read.parquet(feed + "/a").schema
    first = update_state(spark, feed + "/*", state, schema)
    assert sorted((r.keep.id, r.n) for r in first.collect()) == [(5, 1), (6, 1)]
    land(docs_of([(2, "x"), (9, "x"), (7, "z")]), feed + "/b", "doc_id", "text")
    again = update_state(spark, feed + "/*", state, schema)
    assert sorted((r.keep.id, r.n) for r in again.collect()) == [(2, 3), (6, 1), (7, 1)]


def test_settings_are_restored(spark, docs_of):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    exact_duplicates(docs_of(["a", "b"])).collect()
    assert spark.conf.get(key) == before

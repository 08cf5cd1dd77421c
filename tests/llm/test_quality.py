import numpy as np
import pytest

from rollcall.llm import bradley_terry
from rollcall.llm.bradley_terry import GOOD, N_FEATURES, Model, features, fit, keep_good, scored, train
from llm_rows import ODD, prose


def junk(seed):
    return [f"SHOUT{seed}!! " * 40, f"a{seed} | b | c | " * 20, f"same{seed} " * 60, f"x{seed}%%% y&&& z### " * 15][seed % 4]


@pytest.fixture(scope="module")
def tables(spark):
    good = [(i, prose(i, 40 + i % 50) + ".") for i in range(120)]
    bad = [(1000 + i, junk(i)) for i in range(80)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i, _ in good[:90]] + [(i, 0) for i, _ in bad[:60]], "doc_id long, label int")
    return docs, labels


def test_held_out_documents(tables):
    docs, labels = tables
    model = train(docs, labels)
    rows = scored(docs, model).collect()
    assert all(0 <= r.score <= 1 for r in rows)
    assert all((r.score >= GOOD) == (r.id < 1000) for r in rows)
    assert sorted(r.doc_id for r in keep_good(docs, model).collect()) == list(range(120))


def test_same_model_again_and_with_fewer_rows(tables):
    docs, labels = tables
    a, b = train(docs, labels), train(docs.repartition(5), labels.repartition(3))
    assert np.allclose(a.weights, b.weights) and a.cut == pytest.approx(b.cut)
    small = train(docs, labels, rows=20)
    assert not np.allclose(a.weights, small.weights)


def test_preferences_order_the_strengths():
    draw = np.random.default_rng(1)
    x = draw.normal(size=(400, 3))
    y = (x @ [2.0, -1.0, 0.0] + draw.normal(size=400) > 0).astype(int)
    model = fit(x, y, 1 - y.mean())
    assert model.weights[0] > 0 > model.weights[1]
    assert abs((model.score(x) >= GOOD).mean() - y.mean()) < 0.01
    order = np.argsort(model.strength(x))
    assert (np.diff(model.score(x)[order]) >= 0).all()


def test_one_label_or_none(spark, tables, none):
    docs, labels = tables
    model = train(docs, labels.filter("label = 1"))
    assert all(r.score == pytest.approx(GOOD) for r in scored(docs, model).collect())
    empty = spark.createDataFrame([], "doc_id long, label int")
    assert all(r.score >= GOOD for r in scored(docs, train(docs, empty)).collect())
    odd_labels = spark.createDataFrame([(1, None), (None, 1), (99_999, 0), (2, 5)], "doc_id long, label int")
    assert isinstance(train(docs, odd_labels), Model)
    assert scored(none, model).collect() == []


def test_odd_rows(odd, tables):
    model = train(*tables)
    rows = scored(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.id in (0, 1, 2)}) == 1
    assert features(None) == features(" \n") == [0.0] * N_FEATURES
    assert keep_good(odd, model).columns == odd.columns


def test_rows_decide_not_ids(spark):
    import numpy as np

    model = Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.arange(N_FEATURES) % 3 - 1.0)
    texts = ["", "some plain words stand here.", "!!! ??? $$$", "A line.\nAnother line.", None]
    want = model.score(np.array([features(t) for t in texts])) >= GOOD
    rows = [(i, t) for t in texts for i in (1, None)]
    kept = keep_good(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert sorted((r.text or "", r.doc_id is None) for r in kept) == sorted((t or "", n) for t, w in zip(texts, want, strict=True) if w for n in (False, True))


def test_fit_minimises_the_pair_loss_and_cuts_at_the_quantile():
    import numpy as np

    draw = np.random.default_rng(5)
    y = (draw.random(400) < 0.7).astype(int)
    x = draw.normal(size=(400, 4)) + y[:, None] * np.array([1.0, 0.5, 0.0, -0.7])
    pairs, penalty, seed, share = 3000, 1e-3, 7, 0.25
    model = fit(x, y, share, pairs, penalty, seed)
    z = np.clip((x - x.mean(axis=0)) / (x.std(axis=0) + 1e-6), -10, 10)
    again = np.random.default_rng(seed)
    diff = z[again.choice(np.flatnonzero(y == 1), pairs)] - z[again.choice(np.flatnonzero(y == 0), pairs)]
    loss = lambda w: np.log1p(np.exp(-(diff @ w))).mean() + penalty / 2 * (w @ w)
    w, rate = np.zeros(4), 1.0
    for _ in range(4000):  # plain gradient descent, in place of Newton's method
        w -= rate * (-(diff / (1 + np.exp(diff @ w))[:, None]).mean(axis=0) + penalty * w)
    assert np.allclose(model.weights, w, atol=1e-4) and loss(model.weights) <= loss(w) + 1e-9
    strength = z @ w
    weight = np.where(y == 1, (1 - share) / (y == 1).sum(), share / (y == 0).sum())
    under = weight[model.score(x) < GOOD].sum()  # weighed as the labels are, the share of bad ones scores under the threshold
    assert abs(under - share) <= weight.max() + 1e-9
    assert (np.diff(model.score(x)[np.argsort(strength)]) >= -1e-12).all()


def all_pairs_slope(model, good, bad, penalty=1e-3):
    z = [np.clip((np.array([features(t) for t in side]) - model.mean) / model.scale, -10, 10) for side in (good, bad)]
    lose = 1 - 1 / (1 + np.exp(-((z[0] @ model.weights)[:, None] - (z[1] @ model.weights)[None, :])))
    return -(lose.sum(axis=1) @ z[0] - lose.sum(axis=0) @ z[1]) / lose.size + penalty * model.weights


def test_every_labelled_document_counts(spark):
    good = [(i, prose(i, 40 + i % 50) + (" ! " * (i % 3))) for i in range(100)]
    bad = [(1000 + i, junk(i) if i % 2 else prose(500 + i, 30) + " ! # ") for i in range(70)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad], "doc_id long, label int")
    model = train(docs, labels)
    x = np.array([features(t) for _, t in good + bad])
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.scale, x.std(axis=0) + 1e-6)
    assert np.abs(all_pairs_slope(model, [t for _, t in good], [t for _, t in bad])).max() < 1e-6
    strength = model.strength(x)
    share, y = 70 / 170, np.r_[np.ones(100), np.zeros(70)]
    order = np.argsort(strength, kind="stable")
    at = int(np.searchsorted(np.cumsum(np.full(170, 1 / 170)), share - 1e-9))
    assert model.cut == pytest.approx(strength[order[[at, at + 1]]].mean()) and len(y) == 170
    assert model.slope == pytest.approx(3 / (np.median(np.abs(strength - model.cut)) + 1e-9))


def test_groups_hold_every_document_and_both_labels(spark, tables, monkeypatch):
    docs, labels = tables
    monkeypatch.setattr(bradley_terry, "GROUP", 8)
    monkeypatch.setattr(bradley_terry, "OTHERS", 2)
    monkeypatch.setattr(bradley_terry, "BROADCAST_LABELS", 0)
    known = labels.filter("doc_id < 1000 OR doc_id > 1055").selectExpr("doc_id AS id", "label AS y")  # 90 good ones, 4 bad ones
    data = bradley_terry._features_of(docs.withColumnRenamed("doc_id", "id").join(known, "id"), ["id", "y"])
    plain = Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES))
    rows = bradley_terry._groups(data, {1: 90, 0: 4}, plain).collect()
    assert len(rows) > 5 and all(r.good and r.bad for r in rows)
    sides = [{tuple(np.round(x, 9)) for r in rows for x in np.reshape(r[side], (-1, N_FEATURES))} for side in ("good", "bad")]
    want = [{tuple(np.round(np.clip(r.x, -10, 10), 9)) for r in data.filter(f"y = {y}").collect()} for y in (1, 0)]
    assert sides == want
    rows = scored(docs, train(docs, labels)).collect()
    assert all((r.score >= GOOD) == (r.id < 1000) for r in rows)


@pytest.mark.parametrize("n", [1, 2, 7, 300])
def test_crossing_of_many_values(spark, n, monkeypatch):
    monkeypatch.setattr(bradley_terry, "BIN_ROWS", 3)
    draw = np.random.default_rng(n)
    s, y = np.round(draw.normal(size=n) ** 3, 2), draw.integers(0, 2, n)
    values = spark.createDataFrame(list(zip(y.tolist(), s.tolist())), "y int, s double")
    for share in (0.0, 0.3, 0.5, 1.0):
        weight = {0: share / max(1, (y == 0).sum()), 1: (1 - share) / max(1, (y == 1).sum())}
        order = np.lexsort((y, s))
        reached = np.cumsum([weight[v] for v in y[order]])
        at = min(int(np.searchsorted(reached, share - 1e-9)), n - 1)
        assert bradley_terry._crossing(values, weight, share) == (s[order[at]], s[order[min(at + 1, n - 1)]])

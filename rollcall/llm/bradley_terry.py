"""Document quality from preference pairs: a Bradley-Terry model of text features, cut at a score quantile."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.session import cut_lineage

#: Pairs that ``fit`` draws from the rows it is given.
PAIRS = 40_000
#: Documents of the more frequent label in a group whose good-bad pairs are all compared, and at least so many of the other.
GROUP = 128
OTHERS = 8
#: Labels that are broadcast; with more of them the features are joined, not the texts.
BROADCAST_LABELS = 1_000_000
#: Strengths in one bin of a quantile that are looked at one by one.
BIN_ROWS = 4096
#: A document is predicted good from this score on; the threshold's quantile is mapped to it.
GOOD = 0.3
MARKS = "#*$%&|<>!?.,;:'\"()[]{}/\\_-+=@^~"


def features(text: str | None) -> list[float]:
    """Numbers that tell running prose from repeats, tables, shouting and symbol noise; all zero without a word."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [0.0] * N_FEATURES
    n, size = len(words), len(raw)
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lines = [x for x in raw.split(b"\n") if not x.isspace() and x]
    counts = Counter(words)
    letters = seen[97:123].sum() + seen[65:91].sum()
    lengths = np.fromiter(map(len, words), np.int64, n)
    pairs = max(1, n - 1)
    fives = max(1, n - 4)
    return [
        np.log1p(n),
        np.log1p(len(lines)),
        lengths.mean(),
        np.log1p(lengths.max()),
        lengths.std(),
        len(counts) / n,
        max(counts.values()) / n,
        sum(map(eq, words, words[1:])) / pairs,
        len(set(zip(words, words[1:], strict=False))) / pairs,
        len(set(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False))) / fives,
        len(set(lines)) / len(lines),
        n / len(lines),
        seen[65:91].sum() / max(1, letters),
        letters / size,
        seen[48:58].sum() / size,
        seen[128:].sum() / size,
        sum(x.endswith((b".", b"!", b"?")) for x in lines) / len(lines),
        *np.log1p(100 * seen[MARK_BYTES] / n),
    ]


MARK_BYTES = np.frombuffer(MARKS.encode(), np.uint8)
N_FEATURES = 17 + len(MARKS)


@dataclass(frozen=True)
class Model:
    """Standardised features times ``weights`` is a document's strength; ``cut`` is the strength that scores ``GOOD``."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float = 0.0
    slope: float = 1.0

    def strength(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -10, 10) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1; ``GOOD`` or more exactly from the cut on."""
        at = self.slope * (self.strength(x) - self.cut)
        return np.where(at >= 0, 1 - (1 - GOOD) * np.exp(-np.maximum(at, 0)), GOOD * np.exp(np.minimum(at, 0)))


def fit(x: np.ndarray, y: np.ndarray, share: float, pairs: int = PAIRS, penalty: float = 1e-3, seed: int = 7) -> Model:
    """Learn strengths from pairs of a good and a bad document, then cut at the quantile ``share`` of bad ones.

    The good one of a pair wins with probability sigmoid(difference of the strengths); Newton's
    method minimises the logistic loss on the feature differences. With one label only there is
    no pair: all documents then have the same strength and score ``GOOD``.
    """
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    model = Model(mean, scale, np.zeros(x.shape[1]))
    if not len(good) or not len(bad):
        return model
    z = np.clip((x - mean) / scale, -10, 10)
    draw = np.random.default_rng(seed)
    diff = z[draw.choice(good, pairs)] - z[draw.choice(bad, pairs)]
    w = np.zeros(x.shape[1])
    for _ in range(30):
        win = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
        slope = diff.T @ (win - 1) / pairs + penalty * w
        bend = (diff * (win * (1 - win))[:, None]).T @ diff / pairs + penalty * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    model = Model(mean, scale, w)
    strength = model.strength(x)
    order = np.argsort(strength, kind="stable")
    weight = np.where(y == 1, (1 - share) / len(good), share / len(bad))[order]
    below = int(np.searchsorted(np.cumsum(weight), share - 1e-9)) + 1  # fitted documents under the quantile
    ends = strength[order[[min(below, len(order)) - 1, min(below, len(order) - 1)]]]
    cut = float(ends.mean())
    return Model(mean, scale, w, cut, float(3 / (np.median(np.abs(strength - cut)) + 1e-9)))


def _features_of(docs: DataFrame, also: list[str]) -> DataFrame:
    """``also`` and the feature vector ``x`` of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array([features(t.as_py()) for t in batch.column("text")], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in also), x], [*also, "x"])

    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in also)
    return docs.select(*also, "text").mapInArrow(run, f"{kinds}, x array<double>")


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "label", rows: int | None = None) -> Model:
    """Fit on all documents with a label (0 or 1); with ``rows``, on up to so many of each label, the first by a hash of their id.

    Labels that are NULL or something else, ids without a document and documents without a label
    do not count; a repeated label counts as often as it is there. The quantile of the threshold
    is the share of label 0 among all labels. Features stay in stored tables: only sums and counts reach the driver.
    """
    known = labels.select(F.col(id).alias("id"), F.col(label).cast("int").alias("y")).filter("y IN (0, 1) AND id IS NOT NULL")
    counts = dict(known.groupBy("y").count().collect())
    texts = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    if rows is None:
        return _fit_all(texts, known, counts)
    picked = None
    for y in (0, 1):
        own = known.filter(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(rows)
        picked = own if picked is None else picked.union(own)
    got = _features_of(texts.join(F.broadcast(picked), "id"), ["id", "y"]).orderBy("id", "y").toArrow()
    x = np.array(got["x"].to_pylist(), np.float64).reshape(-1, N_FEATURES)
    y = np.array(got["y"].to_pylist(), np.int64)
    if not len(y):
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES))
    return fit(x, y, counts.get(0, 0) / sum(counts.values()))


def _fit_all(texts: DataFrame, known: DataFrame, counts: dict[int, int]) -> Model:
    """As ``fit``, over stored tables: every labelled document is in pairs, and counts for the mean, the scale and the cut."""
    if sum(counts.values()) <= BROADCAST_LABELS:
        data = _features_of(texts.join(F.broadcast(known), "id"), ["id", "y"])
    else:
        data = _features_of(texts.filter("id IS NOT NULL"), ["id"]).join(known, "id").select("id", "y", "x")
    data = cut_lineage(data)
    total, mean, square = _moments(data)
    n = dict(data.groupBy("y").count().collect())
    if not total:
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(N_FEATURES))
    model = Model(mean, np.sqrt(square / total) + 1e-6, np.zeros(N_FEATURES))
    if len(n) < 2:
        return model
    model = Model(model.mean, model.scale, _weights(cut_lineage(_groups(data, n, model))))

    def strengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(model.strength(_matrix(batch.column("x"))))], ["y", "s"])

    strength = cut_lineage(data.mapInArrow(strengths, "y int, s double"))
    share = counts.get(0, 0) / sum(counts.values())
    cut = sum(_crossing(strength, {0: share / n[0], 1: (1 - share) / n[1]}, share)) / 2
    at, after = _crossing(strength.select("y", F.abs(F.col("s") - cut).alias("s")), {0: 1 / total, 1: 1 / total}, 0.5)
    median = at if total % 2 else (at + after) / 2
    return Model(model.mean, model.scale, model.weights, cut, float(3 / (median + 1e-9)))


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)


def _moments(data: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, mean and sum of squared deviations of ``x``: worked out by batch, and batches put together."""

    def merge(a, b):
        n = a[0] + b[0]
        step = b[1] - a[1]
        return n, a[1] + step * (b[0] / n), a[2] + b[2] + step**2 * (a[0] * b[0] / n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (0, np.zeros(N_FEATURES), np.zeros(N_FEATURES))
        for batch in batches:
            x = _matrix(batch.column("x"))
            if len(x):
                held = merge(held, (len(x), x.mean(axis=0), x.var(axis=0) * len(x)))
        yield pa.RecordBatch.from_pydict({"n": [held[0]], "mean": [held[1].tolist()], "square": [held[2].tolist()]})

    held = (0, np.zeros(N_FEATURES), np.zeros(N_FEATURES))
    for n, mean, square in data.select("x").mapInArrow(run, "n long, mean array<double>, square array<double>").collect():
        if n:
            held = merge(held, (n, np.array(mean), np.array(square)))
    return held


def _groups(data: DataFrame, n: dict[int, int], model: Model) -> DataFrame:
    """``(group, good, bad)``: standardised features of documents whose pairs are all compared.

    A hash of the id chooses the group. Of a rare label a document is in several groups, and the first one in all,
    so that every document meets one of the other label.
    """
    rare = 0 if n[0] < n[1] else 1
    groups = -(-n[1 - rare] // GROUP)
    times = min(groups, -(-OTHERS * groups // n[rare]))
    hashed = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(groups))
    first = data.filter(F.col("y") == rare).agg(F.min_by("id", F.struct(F.xxhash64("id"), "id"))).first()[0]
    copies = (
        F.when(F.col("y") != rare, F.array(hashed))
        .when(F.col("id") == F.lit(first), F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
        .otherwise(F.transform(F.sequence(F.lit(0).cast("long"), F.lit(times - 1).cast("long")), lambda j: F.pmod(hashed + F.floor(j * groups / times), F.lit(groups)).cast("long")))
    )
    mean, scale = model.mean, model.scale

    def gather(table: pa.Table) -> pa.Table:
        table = table.sort_by([("id", "ascending")])
        z = np.clip((np.array(table["x"].combine_chunks().flatten()).reshape(-1, N_FEATURES) - mean) / scale, -10, 10)
        y = table["y"].to_numpy()
        kind = pa.list_(pa.float64())
        return pa.table({"good": pa.array([z[y == 1].ravel()], kind), "bad": pa.array([z[y == 0].ravel()], kind)})

    return data.withColumn("group", F.explode(copies)).groupBy("group").applyInArrow(gather, "good array<double>, bad array<double>")


def _weights(groups: DataFrame, penalty: float = 1e-3) -> np.ndarray:
    """Newton's method on the logistic loss of all pairs within the groups; a step is one pass that sums up slopes and bends."""
    k = N_FEATURES
    w = np.zeros(k)
    for _ in range(30):
        here = w.copy()

        def run(batches: Iterator[pa.RecordBatch], w=here) -> Iterator[pa.RecordBatch]:
            pairs, slope, bend = 0, np.zeros(k), np.zeros((k, k))
            for batch in batches:
                for good, bad in zip(batch.column("good"), batch.column("bad"), strict=True):
                    good, bad = (np.asarray(side.values).reshape(-1, k) for side in (good, bad))
                    win = 1 / (1 + np.exp(-np.clip((good @ w)[:, None] - (bad @ w)[None, :], -30, 30)))
                    pairs += win.size
                    slope += (win - 1).sum(axis=1) @ good - (win - 1).sum(axis=0) @ bad
                    win *= 1 - win
                    both = good.T @ win @ bad
                    bend += (good.T * win.sum(axis=1)) @ good + (bad.T * win.sum(axis=0)) @ bad - both - both.T
            yield pa.RecordBatch.from_pydict({"sums": [[pairs, *slope, *bend.ravel()]]}, pa.schema([("sums", pa.list_(pa.float64()))]))

        sums = sum(np.array(r.sums) for r in groups.mapInArrow(run, "sums array<double>").toLocalIterator())
        pairs, slope, bend = sums[0], sums[1 : k + 1], sums[k + 1 :].reshape(k, k)
        step = np.linalg.solve(bend / pairs + penalty * np.eye(k), slope / pairs + penalty * w)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _crossing(values: DataFrame, weight: dict[int, float], share: float) -> tuple[float, float]:
    """The value ``s``, in ascending order, at which the rows' weights by ``y`` reach ``share``, and the one behind it.

    Bins are counted, and the bin with the crossing is cut into bins again, until its rows are few or all alike.
    """
    low, high = values.agg(F.min("s"), F.max("s")).first()
    passed, behind, bins = 0.0, None, 1000
    while True:
        wide = high - low
        place = F.least(F.floor((F.col("s") - low) / (wide if wide > 0 else 1.0) * bins), F.lit(bins)).cast("int")
        binned = values.withColumn("bin", place)
        each = binned.groupBy("bin").agg(F.min("s").alias("low"), F.max("s").alias("high"), F.count_if(F.col("y") == 0).alias("n0"), F.count_if(F.col("y") == 1).alias("n1"))
        each = each.orderBy("bin").collect()
        for i, b in enumerate(each):
            own = b.n0 * weight[0] + b.n1 * weight[1]
            if passed + own >= share - 1e-9 or i == len(each) - 1:
                break
            passed += own
        if i + 1 < len(each):
            behind = each[i + 1].low
        values, low, high = binned.filter(F.col("bin") == b.bin).drop("bin"), b.low, b.high
        if low == high:
            # All alike: behind the last row that is needed comes another one, or the next bin.
            last = b.n0 + b.n1 == 1 or passed + own - (weight[1] if b.n1 else weight[0]) < share - 1e-9
            return low, behind if last and behind is not None else low
        if b.n0 + b.n1 <= BIN_ROWS:
            rows = sorted(tuple(r) for r in values.select("s", "y").collect())
            reached = passed + np.cumsum([weight[y] for _, y in rows])
            at = min(int(np.searchsorted(reached, share - 1e-9)), len(rows) - 1)
            after = rows[at + 1][0] if at + 1 < len(rows) else behind
            return rows[at][0], rows[at][0] if after is None else after


def scored(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, score)`` of every row, NULL and empty texts too (all features zero); other columns are left behind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(1)], np.float64).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x), pa.float64())], ["id", "score"])

    pick = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return pick.mapInArrow(run, f"id {pick.schema['id'].dataType.simpleString()}, score double")


def keep_good(docs: DataFrame, model: Model, text: str = "text", good: float = GOOD) -> DataFrame:
    """The rows of ``docs`` whose text scores ``good`` or more, with all columns; ids play no part.

    A row is scored and kept or left out where it is read: nothing is joined or shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(text)], np.float64).reshape(-1, N_FEATURES)
            yield batch.filter(pa.array(model.score(x) >= good))

    return docs.mapInArrow(run, docs.schema)

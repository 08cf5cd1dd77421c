"""Repeated paragraphs and passages across documents: MinHash bands, exact Jaccard, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pandas.util import hash_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.components import components
from rollcall.llm.joins import sized
from rollcall.session import cut_lineage

SHINGLE, SIMILAR = 5, 0.8
#: Hashes of a band, and the recall that the number of bands must reach at the similarity sought.
ROWS, RECALL = 3, 0.999
SEED = 11
#: Members of a bucket that are compared in one task; larger buckets are cut into blocks, and blocks paired.
BLOCK = 2048
#: Up to so many members are compared set by set.
FEW = 24
#: Words of a passage that is found wherever it stands in a text, and of the units that are compared for it.
PASSAGE, UNIT = 50, 25
#: Odd factors and seeds of the two numbers by which equal pieces are known.
KEYS = ((0xD1342543DE82EF95, 0x2545F4914F6CDD1D), (0xAF251AF3B0F025B5, 0x9E6C63D0876A9A47))
#: Documents that a task cuts at a time.
SLICE = 64


def tuned(similar: float = SIMILAR, rows: int = ROWS, recall: float = RECALL) -> int:
    """Bands of ``rows`` hashes that two sets of this Jaccard similarity miss with probability 1 - ``recall`` at most."""
    bands = 1
    while (1 - similar**rows) ** bands > 1 - recall:
        bands += 1
    return bands


def shingles(text: str, size: int = SHINGLE) -> set[str]:
    """Word shingles of a normalised paragraph; fewer words: the whole."""
    words = text.split(" ")
    return set(map(" ".join, zip(*(words[i:] for i in range(size)), strict=False))) or {text}


def hashed(shingles: np.ndarray, spans: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """``bands`` numbers for each span (start, end) of the shingles, each a hash of ``rows`` minima over the span."""
    draw = np.random.default_rng(SEED)
    times = draw.integers(0, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    plus = draw.integers(0, 1 << 63, bands * rows, np.uint64)
    mixed = np.zeros((bands, len(spans)), np.uint64)
    padded = np.append(shingles, np.uint64(0))  # a span may end with the last shingle
    for i in range(bands * rows):
        value = padded * times[i]
        value += plus[i]
        value ^= value >> np.uint64(32)
        value *= np.uint64(0x9E3779B97F4A7C15)
        low = np.minimum.reduceat(value, spans.ravel())[::2]
        band = mixed[i // rows]
        band ^= low + np.uint64(0x9E3779B97F4A7C15) + (band << np.uint64(6)) + (band >> np.uint64(2))
    mixed += np.arange(1, bands + 1, dtype=np.uint64)[:, None] * np.uint64(0xD6E8FEB86659FD93)
    return np.ascontiguousarray(mixed.T).view(np.int64)


def keys(own: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers for each span (start, end) of words, 128 bits in all: equal where the words are equal."""
    found = []
    for times, seed in KEYS:
        times, back = np.uint64(times), np.uint64(pow(times, -1, 1 << 64))
        value = (own ^ np.uint64(seed)) * np.uint64(0xBF58476D1CE4E5B9)
        value ^= value >> np.uint64(31)
        up, down = np.ones(len(own) + 1, np.uint64), np.ones(len(own) + 1, np.uint64)
        up[1:], down[1:] = times, back
        np.multiply.accumulate(up, out=up)
        np.multiply.accumulate(down, out=down)
        total = np.zeros(len(own) + 1, np.uint64)
        np.cumsum(value * up[:-1], out=total[1:])
        found.append(((total[spans[:, 1]] - total[spans[:, 0]]) * down[spans[:, 0]]).view(np.int64))
    return found[0], found[1]


def pieces(
    docs: DataFrame, id: str, text: str, shingle: int, least: int = 0, bands: int = 0, rows: int = 0, passage: int = 0, unit: int = 0
) -> DataFrame:
    """``(id, para, start, a, b, bands, norm)`` of each text's lines and units, from one pass over its words.

    Words are what white space parts, in lower case. Lines of ``least`` words or more have their number among all lines of
    the text as ``para``, their band hashes and their words as ``norm``; without ``bands`` there are none. Units, whose ``para`` is
    NULL, are cut by content where a ``passage`` is named. ``start`` counts the words of the whole text; ``a`` and ``b`` tell equal pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                if found := slice_pieces(part.column(1).to_pylist()):
                    owner, *columns = found
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(owner)), *columns], ["id", "para", "start", "a", "b", "bands", "norm"]
                    )

    def slice_pieces(texts: list[str | None]):
        words, begins, owner, paras, spans, norms = [], [], [], [], [], []
        for i, whole in enumerate(texts):
            begins.append(len(words))
            for para, line in enumerate((whole or "").lower().split("\n")):
                here = line.split()
                if bands and len(here) >= least:
                    owner.append(i)
                    paras.append(para)
                    spans.append((len(words), len(words) + len(here)))
                    norms.append(" ".join(here))
                words += here
        begins.append(len(words))
        if not words:
            return None
        own = word_hashes(words)
        runs = mixed_runs(own, shingle)
        n_lines = len(spans)
        for i, (begin, end) in enumerate(zip(begins, begins[1:], strict=False)) if passage else ():
            starts = anchors(runs[begin : max(begin, end - shingle + 1)], end - begin, passage, unit) + begin
            starts = apart(starts.tolist(), runs, unit, shingle)
            owner += [i] * len(starts)
            spans += [(x, x + unit) for x in starts]
        if not spans:
            return None
        spans = np.array(spans, np.int64)
        a, b = keys(own, spans)
        more = len(spans) - n_lines
        flat = np.zeros(0, np.int64)
        if n_lines:
            flat = hashed(runs, spans[:n_lines] - [0, shingle - 1], bands, rows).ravel()
        ends = np.minimum(np.arange(len(spans) + 1), n_lines).astype(np.int32) * bands
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
        numbers = pa.array(paras + [None] * more, pa.int32())
        starts = spans[:, 0] - np.array(begins)[owner]
        return owner, numbers, pa.array(starts), pa.array(a), pa.array(b), lists, pa.array(norms + [None] * more, pa.string())

    if bands and least < shingle:
        raise ValueError("a line has the words of a shingle at least")
    if passage and not shingle <= unit <= passage:
        raise ValueError("a unit has the words of a shingle at least and of a passage at most")
    pick = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = pick.schema["id"].dataType.simpleString()
    return pick.mapInArrow(run, f"id {kind}, para int, start long, a long, b long, bands array<long>, norm string")


def linked(texts: list[str], similar: float, shingle: int, sides: list[int] | None = None) -> list[tuple[int, int]]:
    """Pairs that connect all members whose exact Jaccard similarity is ``similar`` or more; fewer pairs than members.

    Two members that are connected already are not compared. ``sides`` (0 and 1) asks for pairs across only.
    """
    sets = [shingles(x, shingle) for x in texts]
    root, found = list(range(len(sets))), []

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def meet(i: int, j: int, both: int) -> None:
        a, b = top(i), top(j)
        if a != b and both >= similar * (len(sets[i]) + len(sets[j]) - both):
            root[a] = b
            found.append((i, j))

    if len(sets) <= FEW:
        for i, j in combinations(range(len(sets)), 2):
            if (sides is None or sides[i] != sides[j]) and top(i) != top(j):
                meet(i, j, len(sets[i] & sets[j]))
        return found
    code: dict[str, int] = {}
    rows = [np.array([code.setdefault(x, len(code)) for x in s]) for s in sets]
    sizes = np.array([len(x) for x in rows])
    member = np.repeat(np.arange(len(rows)), sizes)
    flat = np.concatenate(rows)
    order = np.argsort(flat, kind="stable")
    posted = member[order]  # members by shingle
    ends = np.cumsum(np.bincount(flat, minlength=len(code)))
    side = np.array(sides) if sides is not None else None
    for i, row in enumerate(rows):
        lists = [posted[(ends[x - 1] if x else 0) : ends[x]] for x in row]
        both = np.bincount(np.concatenate(lists), minlength=len(rows))
        close = both >= similar * (sizes + sizes[i] - both)
        close[: i + 1] = False
        if side is not None:
            close &= side != side[i]
        for j in np.flatnonzero(close):
            meet(i, int(j), int(both[j]))
    return found


def links(members: DataFrame, similar: float, shingle: int) -> DataFrame:
    """``(a, b)`` from ``members`` (bucket, one, two, side, pid, norm), bucket by bucket; a task holds one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, pids, texts, sides = None, [], [], []

        def close():
            if len(pids) > 1:
                cross = None if last is None or last[1] == last[2] else sides
                pairs = linked(texts, similar, shingle, cross)
                yield from ((pids[i], pids[j]) for i, j in pairs)

        for batch in batches:
            out = []
            columns = [batch.column(c).to_pylist() for c in ("bucket", "one", "two", "side", "pid", "norm")]
            for *key, side, pid, norm in zip(*columns, strict=True):
                if key != last:
                    out += close()
                    last, pids, texts, sides = key, [], [], []
                pids.append(pid)
                texts.append(norm)
                sides.append(side)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b"])
        out = list(close())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b"])

    return members.mapInArrow(run, "a long, b long")


def word_hashes(words: list[str]) -> np.ndarray:
    """A hash per word, the same in every process."""
    return hash_array(np.array(words, dtype=object), categorize=False)


def mixed_runs(own: np.ndarray, shingle: int) -> np.ndarray:
    """A hash per run of ``shingle`` words, from the words' own."""
    n = max(0, len(own) - shingle + 1)
    out = np.zeros(n, np.uint64)
    for i in range(shingle):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + own[i : i + n]
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(29))


def anchors(hashes: np.ndarray, n_words: int, passage: int, unit: int) -> np.ndarray:
    """Words at which units start: the least hash of each run of ``passage - unit + 1``, so equal passages start alike.

    Every run of ``passage`` words holds a whole unit whose start depends on these words only.
    """
    if n_words < passage:
        return np.zeros(0, np.int64)
    bits = np.uint64(len(hashes).bit_length())
    least = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)  # of equal ones the first
    run, width = passage - unit + 1, 1
    while width < run:
        step = min(width, run - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    found = (least[: n_words - passage + 1] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    return found[np.diff(found, prepend=-1) > 0]


def apart(starts: list[int], runs: np.ndarray, unit: int, shingle: int) -> list[int]:
    """``starts`` without units that overlap an equal one before them (a text that repeats itself at once)."""
    if len(set(runs[starts].tolist())) == len(starts):  # no two begin alike
        return starts
    out, ends = [], {}
    for start in starts:
        norm = runs[start : start + unit - shingle + 1].tobytes()
        if start >= ends.get(norm, 0):
            out.append(start)
            ends[norm] = start + unit
    return out


def repeated_paragraphs(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    similar: float = SIMILAR,
    rows: int = ROWS,
    recall: float = RECALL,
    block: int = BLOCK,
    least: int | None = None,
    within: bool = True,
) -> DataFrame:
    """``(id, para, keep_id, keep_para, group_size, kept)`` of every paragraph that is like another.

    A paragraph is a line of ``least`` words or more (None: those of a shingle). Two are linked if a band of their MinHashes
    is equal and their word shingles have a Jaccard similarity of ``similar`` or more; groups are the components of links and
    equality. The first paragraph of a group, by id and line, is kept; the others may be removed. Equal paragraphs count once
    in all comparisons. Without ``within``, a group whose members all stand in one document is left out. NULL and
    empty texts have no paragraph; a NULL id comes last. A repeated row has the same paragraphs twice: rows that tie with the
    kept one are kept too.
    """
    cut = cut_lineage(pieces(docs, id, text, shingle, least or shingle, tuned(similar, rows, recall), rows))
    return _paragraph_groups(cut, similar, shingle, block, within)


def _paragraph_groups(cut: DataFrame, similar: float, shingle: int, block: int, within: bool) -> DataFrame:
    """Groups of the lines in ``cut``, a stored table of ``pieces``."""
    lines = cut.filter("para is not null")
    distinct = lines.groupBy("a", "b").agg(
        F.first("bands").alias("bands"),
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "para")).alias("place"),
        F.max(F.struct(F.col("id").isNull().alias("none"), "id")).alias("last"),
        F.count("*").alias("n"),
    )
    distinct = cut_lineage(distinct.withColumn("pid", F.monotonically_increasing_id()))

    in_buckets = distinct.select("pid", F.explode("bands").alias("bucket"))
    sizes = cut_lineage(in_buckets.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1"))
    members = cut_lineage(in_buckets.join(sizes, "bucket"))
    wanted = distinct.join(members.select("pid").distinct(), "pid").select("pid", "a", "b", "place")
    first = F.col("id").eqNullSafe(F.col("place.id")) & (F.col("para") == F.col("place.para"))
    norms = lines.select("a", "b", "id", "para", "norm").join(sized(cut_lineage(wanted)), ["a", "b"]).filter(first)
    norms = norms.groupBy("pid").agg(F.first("norm").alias("norm"))
    blocks = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("pid"), blocks).cast("int")
    members = members.select("bucket", "pid", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    members = members.select(
        "bucket", "pid", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), F.col("own").alias("side")
    )
    full = members.join(cut_lineage(norms), "pid")
    full = full.repartition("bucket", "one", "two").sortWithinPartitions("bucket", "one", "two", "pid")
    edges = cut_lineage(links(full, similar, shingle))

    found = components(edges)
    named = distinct.join(found, distinct.pid == found.node, "left")
    named = cut_lineage(named.select("a", "b", "place", "last", "n", F.coalesce("component", "pid").alias("component")))
    groups = named.groupBy("component").agg(
        F.min("place").alias("keep"), F.max("last").alias("last"), F.sum("n").alias("group_size")
    )
    groups = groups.filter("group_size > 1")
    if not within:
        groups = groups.filter(~F.col("keep.id").eqNullSafe(F.col("last.id")))
    labels = cut_lineage(named.join(cut_lineage(groups.drop("last")), "component").select("a", "b", "keep", "group_size"))
    return lines.select("id", "para", "a", "b").join(labels, ["a", "b"]).select(
        "id",
        "para",
        F.col("keep.id").alias("keep_id"),
        F.col("keep.para").alias("keep_para"),
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep.id")) & (F.col("para") == F.col("keep.para"))).alias("kept"),
    )


def repeated_passages(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    passage: int = PASSAGE,
    unit: int = UNIT,
    within: bool = True,
) -> DataFrame:
    """``(id, start, end, keep_id, keep_start, keep_end, group_size, kept)`` of units of ``unit`` words that stand elsewhere too.

    Units are cut by content from the whole text. So wherever the same ``passage`` words or more stand twice, within a
    line or over line breaks, at least one unit of them is found at both places. Units lie ``passage - unit + 1`` words
    apart at most and may overlap; at either end of a passage up to as many words can be in none of its
    units. ``start`` and ``end`` (exclusive) count words. Units are equal but for case and white space: two of this length
    reach a Jaccard similarity of 0.8 only if they are shifted or differ in their outermost words. The
    first of a group, by id and start, is kept; ``within``, NULLs and repeated rows are as for paragraphs.
    """
    cut = cut_lineage(pieces(docs, id, text, shingle, passage=passage, unit=unit))
    return _passage_groups(cut, unit, within)


def _passage_groups(cut: DataFrame, unit: int, within: bool) -> DataFrame:
    """Groups of the units in ``cut``, a stored table of ``pieces``."""
    found = cut.filter("para is null").select("a", "b", "id", "start")
    # Counts and ends of ids first, which hash aggregation takes for numbers; places only of what stands twice.
    groups = found.groupBy("a", "b").agg(
        F.count("*").alias("group_size"), F.count("id").alias("named"), F.min("id").alias("keep_id"), F.max("id").alias("last")
    )
    groups = groups.filter("group_size > 1")
    if not within:
        groups = groups.filter("keep_id <> last or (named > 0 and named < group_size)")
    all_rows = cut_lineage(found.join(groups.select("a", "b", "group_size", "keep_id"), ["a", "b"]))
    of_keep = F.col("id").eqNullSafe(F.col("keep_id"))
    starts = all_rows.filter(of_keep).groupBy("a", "b").agg(F.min("start").alias("keep_start"))
    return all_rows.join(starts, ["a", "b"]).select(
        "id",
        "start",
        (F.col("start") + unit).alias("end"),
        "keep_id",
        "keep_start",
        (F.col("keep_start") + unit).alias("keep_end"),
        "group_size",
        (of_keep & (F.col("start") == F.col("keep_start"))).alias("kept"),
    )


def repeated(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    similar: float = SIMILAR,
    rows: int = ROWS,
    recall: float = RECALL,
    block: int = BLOCK,
    least: int | None = None,
    passage: int = PASSAGE,
    unit: int = UNIT,
    within: bool = True,
) -> DataFrame:
    """Rows of ``repeated_paragraphs`` and ``repeated_passages`` together, each text's words cut once; the other's columns are NULL."""
    cut = cut_lineage(pieces(docs, id, text, shingle, least or shingle, tuned(similar, rows, recall), rows, passage, unit))
    lines = _paragraph_groups(cut, similar, shingle, block, within)
    return lines.unionByName(_passage_groups(cut, unit, within), allowMissingColumns=True)

"""Spelling variants: words one edit apart, found by scanning a sorted vocabulary with shared edit-matrix rows."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.components import Rounds
from rollcall.llm.joins import sized
from rollcall.session import cut_lineage

RUN = "A-Za-zÀ-ÿ"
#: Code points and occurrences that a word has at least.
LETTERS, SEEN = 7, 2
#: One in so many runs loses a letter; 0: none does.
MISSPELT = 31
#: A variant's form is so many times as frequent.
RATIO = 10
#: Distinct words that a task counts before it passes them on.
HELD = 1 << 18
#: Letters of the words that share a key and are scanned together; more are told apart by longer keys.
BLOCK = 1 << 20
#: Letters of a padded table of words that a task scans at once, and words looked for at a time.
CELLS, QUERIES = 1 << 21, 1 << 13


def count_words(
    docs: DataFrame, id: str = "doc_id", text: str = "text", letters: int = LETTERS, seen: int = SEEN, misspelt: int = MISSPELT
) -> DataFrame:
    """``(word, n)``: runs of Latin letters, A to Z in lower case, of ``letters`` code points or more that occur ``seen`` times.

    A run whose CRC-32 with its document's id is divisible by ``misspelt`` counts without one of its letters, as
    that number says; a NULL id is written as nothing. NULL and empty texts have no words. Repeated rows
    count each time. Tasks add up before the shuffle, so the commonest word is one row of a task's thousands.
    """
    find = re.compile(f"[{RUN}]{{{letters},}}").findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}

        def passed_on():
            batch = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for own, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                low = (value.as_py() or "").encode().lower().decode()  # of bytes, only A to Z have a lower case
                start = crc32(f"{'' if own is None else own}:".encode())
                for word, n in Counter(find(low)).items():
                    drawn = crc32(word.encode(), start)
                    if misspelt and drawn % misspelt == 0:
                        at = drawn % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < letters:
                            continue
                    counts[word] = counts.get(word, 0) + n
                if len(counts) > HELD:
                    yield passed_on()
        yield passed_on()

    pick = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return pick.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= seen)


def keyed(words: DataFrame) -> DataFrame:
    """``words`` (id, word, n, head, tail) once for each key that they may share with a word one edit away.

    Words of a key have their first ``head`` and last ``tail`` letters in common, so an edit lies in the middle of both. It
    leaves the first or the last ``(m - 1) div 2`` letters of the middle alone, m being the shorter word's
    middle. So each word gives its longer and its shorter beginning, ``way`` 1, and end, ``way`` -1.
    """
    middle = F.length("word") - F.col("head") - F.col("tail")
    half = lambda less: F.floor((middle - less) / 2).cast("int")
    steps = F.array_distinct(F.array(half(1), half(2)))
    steps = F.filter(steps, lambda k: k >= 0)
    made = words.withColumn("step", F.explode(steps)).withColumn("way", F.explode(F.array(F.lit(1), F.lit(-1))))
    made = made.withColumns(
        {
            "up": F.array("head", "tail"),
            "head": F.col("head") + F.when(F.col("way") == 1, F.col("step")).otherwise(0),
            "tail": F.col("tail") + F.when(F.col("way") == -1, F.col("step")).otherwise(0),
        }
    )
    ends = [F.substring("word", F.lit(1), F.col("head")), F.expr("right(word, tail)")]
    return made.withColumn("key", F.xxhash64(*ends, "head", "tail", "way", "step", *(["key"] if "key" in words.columns else [])))


def blocks(words: DataFrame, block: int) -> list[DataFrame]:
    """Keyed words; those of a key with more than ``block`` letters are keyed anew, until their middles are used up."""
    found, last = [], words.withColumns({"head": F.lit(0), "tail": F.lit(0)})
    columns = ["id", "word", "n", "head", "tail", "step", "way", "up", "key"]
    while True:
        made = cut_lineage(keyed(last).select(*columns))
        used = F.col("step") == 0  # two or three letters are left to differ: no longer key would part them
        sizes = made.filter(~used).groupBy("key").agg(F.sum(F.length("word")).alias("letters")).filter(F.col("letters") > block)
        crowded = cut_lineage(sizes.select("key"))
        if crowded.isEmpty():
            return [*found, made]
        crowded = sized(crowded)
        found.append(made.join(crowded, "key", "left_anti").select(*columns))
        last = made.join(crowded, "key", "left_semi").select("id", "word", "n", "head", "tail", "key")


class Scan:
    """Words of some keys, sorted, and the pairs among them that one edit turns into each other."""

    def __init__(self, words: list[str], starts: list[int]):
        """``words`` in order within each key; ``starts``: where the keys' words begin."""
        n = len(words)
        self.lens = np.fromiter(map(len, words), np.int32, n)
        longest = int(self.lens.max())
        joined = "".join(w.ljust(longest, "\0") for w in words)
        self.chars = np.frombuffer(joined.encode("utf-32-le"), "<u4").reshape(n, longest)
        #: Query letters with a column before the first and two behind the last, which match nothing.
        self.asked = np.full((n, longest + 3), 0xFFFFFFFF, np.uint32)
        self.asked[:, 1:-2] = np.where(np.arange(longest) < self.lens[:, None], self.chars, 0xFFFFFFFF)
        self.same = np.zeros(n, np.int32)  # letters in common with the word before
        differ = self.chars[1:] != self.chars[:-1]
        self.same[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), longest)
        self.same[1:] = np.minimum(self.same[1:], np.minimum(self.lens[1:], self.lens[:-1]))
        self.starts, ends = np.array(starts), np.array([*starts[1:], n])
        self.same[self.starts] = -1
        low = np.where(self.same < 0, longest, self.same)
        self.block = np.repeat(np.arange(len(starts)), ends - self.starts)
        self.first = np.minimum(np.minimum.reduceat(low, self.starts), np.minimum.reduceat(self.lens, self.starts))
        self.ends = ends

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        order = np.argsort(self.first[self.block], kind="stable")
        for at in range(0, len(order), QUERIES):
            yield from self.look(order[at : at + QUERIES])

    def look(self, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, later word of its key) one edit apart.

        All queries go down the sorted words together. A state is a query, a range of words with their first ``depth``
        letters in common, and the row of the edit matrix of these letters: the three cells next to the diagonal, as
        others exceed one edit. The row is worked out once for the range, from the row of the range around it, and
        serves all its words. A range whose row exceeds one edit is skipped whole.
        """
        begin = self.first[self.block[queries]]
        depth = int(begin.min())
        empty = np.zeros(0, np.int64)
        q, lo, hi, rows = empty, empty, empty, [np.zeros(0, np.int8)] * 3
        while len(q) or depth <= int(begin.max()):
            new = queries[begin == depth]
            if len(new):  # their whole key has this beginning in common: the row of equal letters
                one = np.ones(len(new), np.int8)
                beyond = np.where(self.lens[new] > depth, 1, 2).astype(np.int8)
                rows = [np.concatenate(x) for x in zip(rows, (one if depth else one * 2, one * 0, beyond), strict=True)]
                q, lo = np.concatenate([q, new]), np.concatenate([lo, self.starts[self.block[new]]])
                hi = np.concatenate([hi, self.ends[self.block[new]]])
            # A word that ends here is the first of its range.
            over = self.lens[lo] == depth
            if over.any():
                cell = self.lens[q] - depth + 1
                done = over & (cell >= 0) & (cell <= 2) & (lo > q)
                done[done] = np.choose(cell[done], [r[done] for r in rows]) == 1
                yield q[done], lo[done]
                lo = lo + over
            # Each range falls apart by the next letter.
            begins = self.same <= depth
            places, before = np.flatnonzero(begins), np.concatenate([[0], np.cumsum(begins)])
            a, b = before[lo], before[hi]
            times = np.where(lo < hi, b - a, 0)
            state = np.repeat(np.arange(len(q)), times)
            child = np.arange(len(state)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(a, times)
            q, lo = q[state], places[child]
            hi = np.append(places, len(self.lens))[child + 1]
            later = hi > q + 1  # a pair is found from its earlier word
            q, lo, hi, state = q[later], lo[later], hi[later], state[later]
            left, mid, right = (r[state] for r in rows)
            letter = self.chars[lo, depth] if depth < self.chars.shape[1] else np.zeros(len(lo), np.uint32)
            asked, at = self.asked, min(depth, self.asked.shape[1] - 3)
            left = np.minimum(mid + 1, left + (asked[q, at] != letter))
            mid = np.minimum(np.minimum(right + 1, left + 1), mid + (asked[q, at + 1] != letter))
            right = np.minimum(mid + 1, right + (asked[q, at + 2] != letter))
            room = self.lens[q] - depth - 1  # letters of the query behind the diagonal
            left, mid, right = np.where(room < -1, 2, left), np.where(room < 0, 2, mid), np.where(room < 1, 2, right)
            alive = np.minimum(np.minimum(left, mid), right) <= 1
            q, lo, hi = q[alive], lo[alive], hi[alive]
            rows = [x[alive].astype(np.int8) for x in (left, mid, right)]
            depth += 1


def _owned(one: str, two: str, head: int, tail: int, step: int, way: int) -> bool:
    """Whether a pair belongs to this key and to no other of the same round; ``head`` and ``tail`` are those before it."""
    shorter = min(len(one), len(two)) - head - tail
    if step != (shorter - 1) // 2:
        return False
    same = one[head : head + step] == two[head : head + step]
    return same if way == 1 else not same


def near(made: DataFrame, top: bool) -> DataFrame:
    """``(id, n_near, best_n, best)`` of keyed words, once for each batch of keys in which a word has a near one.

    A pair counts where its key is the first that it has in common, so no pair counts twice in a round. Pairs of
    keys made anew (not ``top``) would also meet under another key of the round before: they are sent on as
    pairs and made distinct by the caller.
    """
    fields = ["key", "id", "word", "n", "step", "way", "up"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # words of whole keys: (id, word, word as it is scanned, n, step, way, up)
        starts: list[int] = []
        group: list[tuple] = []  # words of the key that is being read
        longest, last = 0, None

        def found() -> Iterator[pa.RecordBatch]:
            scan = Scan([r[2] for r in held], starts)
            pairs = [
                (i, j)
                for a, b in scan.pairs()
                for i, j in zip(a.tolist(), b.tolist(), strict=True)
                if _owned(held[i][1], held[j][1], *held[i][6], held[i][4], held[i][5])
            ]
            if not pairs:
                return
            a, b = np.array(pairs).T
            ids, counts = np.array([r[0] for r in held]), np.array([r[3] for r in held])
            a, b = np.concatenate([a, b]), np.concatenate([b, a])
            if top:
                order = np.lexsort((ids[b], -counts[b], ids[a]))
                a, b = a[order], b[order]
                head = np.flatnonzero(np.diff(ids[a], prepend=-1))
                columns = [ids[a[head]], np.diff(np.append(head, len(a))), counts[b[head]], ids[b[head]]]
            else:
                columns = [ids[a], np.ones(len(a), np.int64), counts[b], ids[b]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["id", "n_near", "best_n", "best"])

        def closed() -> Iterator[pa.RecordBatch]:
            """The key is read to its end; keys are scanned together while their padded table is small."""
            nonlocal held, starts, group, longest
            if len(group) > 1:  # alone, a word has no near one
                own = max(len(r[1]) for r in group)
                if held and (len(held) + len(group)) * max(longest, own) > CELLS:
                    yield from found()
                    held, starts, longest = [], [], 0
                starts.append(len(held))
                held += group
                longest = max(longest, own)
            group = []

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in fields]
            for key, id, word, n, step, way, up in zip(*columns, strict=True):
                if key != last:
                    yield from closed()
                    last = key
                group.append((id, word, word if way == 1 else word[::-1], n, step, way, up))
        yield from closed()
        if held:
            yield from found()

    text = F.when(F.col("way") == 1, F.col("word")).otherwise(F.reverse("word"))
    dealt = made.select(*fields).repartition("key").sortWithinPartitions("key", text)
    return dealt.mapInArrow(run, "id long, n_near long, best_n long, best long")


def variants(words: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every row of ``words`` (word, n), which are distinct and not NULL.

    Two words are near if one letter put in, taken out or replaced makes one of the other. A word's form is its most
    frequent near word, the first in code-point order of equally frequent ones, if that is ``ratio`` times as frequent
    as the word itself; ``root`` follows forms to the last. Words of any length are compared whole. The vocabulary is
    sorted once by all tasks, so the number of a word is its place; pairs travel as numbers. No words give no rows.
    """
    spark = words.sparkSession
    numbered = cut_lineage(words.orderBy("word").select(F.monotonically_increasing_id().alias("id"), "word", "n"))
    first, *further = blocks(numbered, block)
    found = near(first, top=True)
    if further:
        pairs = near(first, top=False)
        for made in further:
            pairs = pairs.unionByName(near(made, top=False))
        found = pairs.distinct()
    best = F.min(F.struct((-F.col("best_n")).alias("loss"), "best")).alias("b")
    found = cut_lineage(found.groupBy("id").agg(F.sum("n_near").alias("n_near"), best))
    found = numbered.join(found, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), (-F.col("b.loss")).alias("form_n"), F.col("b.best").alias("form")
    )
    found = cut_lineage(found)
    formed = found.filter(F.col("form_n") >= ratio * F.col("n")).select("id", "form", "form_n")

    rounds = Rounds(spark)
    roots = rounds.store(formed.select("id", F.col("form").alias("root")))
    while True:  # each round goes twice as far; forms grow at least tenfold a step, so a few rounds do
        above = roots.select(F.col("id").alias("root"), F.col("root").alias("next"))
        roots = rounds.store(roots.join(above, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("more")))
        rounds.forget(keep=2)
        if not roots.filter("more").limit(1).count():
            break
        roots = roots.drop("more")
    texts = lambda name: numbered.select(F.col("id").alias(name), F.col("word").alias(f"{name}_word"))
    named = formed.join(roots.drop("more"), "id").join(texts("form"), "form").join(texts("root"), "root")
    named = named.select("id", F.col("form_word"), F.col("root_word"), F.col("form_n").alias("n_form"))
    return found.select("id", "word", "n", "n_near").join(named, "id", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", F.col("n_form").alias("form_n")
    )

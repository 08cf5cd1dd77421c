"""Phrase collocations: frequent phrases by Misra-Gries summaries, counted exactly in a second pass, and scored."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.session import cut_lineage

#: Occurrences that a phrase has at least, rows that a group lists, and the share of a longer phrase that drops it, in percent.
OFTEN, LISTED, WITHIN = 10, 2000, 50
NO_GROUP = "und"
#: In one pass over the bytes of a text: A to Z in lower case, ends of a piece, blanks.
LETTERS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + b"." * 10)
END = b"."
#: Words that a task counts together.
BLOCK_WORDS = 1 << 19
#: Phrases' occurrences in a hash partition, by their expected number.
MASS = 1 << 23
#: Bits in which a task looks up whether a phrase may be frequent: of a hash partition, and of all at most (64 MB).
SLICE_BITS, MOST_BITS = 20, 29
#: Phrases that are ranked together; of more, each part first brings its best ones.
RANKED = 1 << 18
SEED = 13


class Block:
    """Words of some documents as numbers, with the phrases of two and three that stand in them."""

    def __init__(self):
        self.words: list[bytes] = []  # by number
        self.groups: dict[str, int] = {}  # number of a group
        self.owner: list[int] = []  # the group's number, by word number
        self.known: dict[str, dict[bytes, int]] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, group: str, words: list[bytes]) -> None:
        """``words`` in order; ``END`` parts pieces."""
        known = self.known.get(group)
        if known is None:
            known = self.known[group] = {END: -1}
            self.groups[group] = len(self.groups)
        new = set(words).difference(known)
        at = len(self.words)
        known.update(zip(new, range(at, at + len(new)), strict=True))
        self.words += new
        self.owner += repeat(self.groups[group], len(new))
        self.parts.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        self.parts.append(np.array([-1]))
        self.size += len(words)

    def phrases(self) -> list[tuple[list[np.ndarray], np.ndarray]]:
        """For one, two and three words: the numbers of each distinct phrase's words, and how often it stands there."""
        code = np.concatenate(self.parts)
        most, out = max(len(self.words), 1), []
        at = np.flatnonzero(code >= 0)
        number = code[at]
        for k in range(3):
            if k:
                inside = at + k < len(code)
                at, number = at[inside], number[inside]
                follows = code[at + k] >= 0
                at, number = at[follows], number[follows]
                if most ** (k + 1) >> 63:  # only a piece of millions of different words: its phrases are numbered anew
                    number = np.unique(number, return_inverse=True)[1]
                number = number * most + code[at + k]
            if most ** (k + 1) >> 63:
                _, first, times = np.unique(number, return_index=True, return_counts=True)
                parts = [code[at[first] + i] for i in range(k + 1)]
            else:
                rest, times = np.unique(number, return_counts=True)
                parts = []
                for _ in range(k + 1):
                    rest, last = np.divmod(rest, most)
                    parts.insert(0, last)
            out.append((parts, times))
        return out

    def hashes(self) -> np.ndarray:
        """A hash of each word with its group."""
        groups = [xxhash.xxh64_intdigest(g, SEED) for g in self.groups]
        both = zip(self.words, self.owner, strict=True)
        return np.fromiter((xxhash.xxh64_intdigest(w, groups[g]) for w, g in both), np.uint64, len(self.words))


def phrase_hash(words: np.ndarray, parts: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + words[part]
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return out ^ (out >> np.uint64(29))


def blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Block]:
    """The documents (group, text) of a task as blocks of some ``size`` words.

    A text longer than that goes on in the next block, cut between two pieces; a piece longer than that alone is one block's.
    """
    block = Block()
    for batch in batches:
        for group, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            words = (text.as_py() or "").encode().translate(LETTERS).replace(END, b" . ").split()
            while words:
                cut = len(words)
                if cut > size:
                    cut = size
                    while cut < len(words) and words[cut] != END:
                        cut += 1
                block.add(group, words[:cut])
                words = words[cut:]
                if block.size >= size:
                    yield block
                    block = Block()
    if block.size:
        yield block


def merged(keys: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Counters of equal keys added up; if over ``capacity`` are left, what the next one has is taken off all.

    The merge step of mergeable Misra-Gries summaries: a key loses at most (mass taken off) / (capacity + 1). The third
    value is what was taken off.
    """
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    head = np.flatnonzero(np.diff(keys.astype(np.int64), prepend=-1))
    keys, counts = keys[head], np.add.reduceat(counts, head) if len(head) else counts
    if len(keys) <= capacity:
        return keys, counts, 0
    off = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
    left = counts > off
    return keys[left], counts[left] - off, off


def frequent(summaries: list[tuple[bytes, bytes]], often: int) -> np.ndarray:
    """Keys that may stand ``often`` times in the blocks whose ``summaries`` (sorted keys, counters) are given.

    The capacity exceeds mass / ``often``, so a key with ``often`` occurrences keeps a counter. A key counts as
    frequent if its counter and all that was taken off reach ``often``.
    """
    mass = sum(int(np.frombuffer(c, "<u4").sum(dtype=np.int64)) for _, c in summaries)
    capacity = mass // often + 1
    keys, counts, off = np.zeros(0, np.uint32), np.zeros(0, np.int64), 0
    todo, held = [], 0
    for i, (k, c) in enumerate(summaries):
        todo.append((np.frombuffer(k, "<u4"), np.frombuffer(c, "<u4").astype(np.int64)))
        held += len(todo[-1][0])
        if held > max(capacity, 1 << 20) or i + 1 == len(summaries):
            keys, counts, taken = merged(np.concatenate([keys, *(x[0] for x in todo)]), np.concatenate([counts, *(x[1] for x in todo)]), capacity)
            off, todo, held = off + taken, [], 0
    return keys[counts + off >= often]


def summaries(docs: DataFrame, partition_bits: int) -> DataFrame:
    """``(part, keys, counters)``: of each block and hash partition the phrases' hashes, sorted, and how often they stand there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, BLOCK_WORDS):
            words = block.hashes()
            _, two, three = block.phrases()
            found = np.concatenate([phrase_hash(words, p) for p, _ in (two, three)])
            times = np.concatenate([t for _, t in (two, three)]).astype("<u4")
            order = np.argsort(found)
            found, times = found[order], times[order]
            part = (found >> np.uint64(64 - partition_bits)).astype(np.int64) if partition_bits else np.zeros(len(found), np.int64)
            keys = (found >> np.uint64(32 - partition_bits)).astype("<u4")
            head = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
            ends = [*head[1:], len(part)]
            for at in range(0, len(head), 256):
                cut = list(zip(head[at : at + 256], ends[at : at + 256], strict=True))
                columns = [pa.array(part[head[at : at + 256]], pa.int64())]
                columns += [pa.array([x[a:b].tobytes() for a, b in cut], pa.binary()) for x in (keys, times)]
                yield pa.RecordBatch.from_arrays(columns, ["part", "keys", "counters"])

    return docs.mapInArrow(run, "part long, keys binary, counters binary")


def marks(summed: DataFrame, often: int, slice_bits: int) -> DataFrame:
    """``(part, bits)``: of each hash partition a slice of ``2 ** slice_bits`` bits, set where a phrase may be frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def slice_of(part, own):
            bits = np.zeros(1 << slice_bits, bool)
            bits[frequent(own, often) >> np.uint32(32 - slice_bits)] = True
            columns = [pa.array([part], pa.int64()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["part", "bits"])

        last, own = None, []
        for batch in batches:
            for part, keys, counters in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != last and own:
                    yield slice_of(last, own)
                    own = []
                last = part
                own.append((keys, counters))
        if own:
            yield slice_of(last, own)

    return summed.repartition("part").sortWithinPartitions("part").mapInArrow(run, "part long, bits binary")


def counted(docs: DataFrame, often: int) -> DataFrame:
    """``(group, k, phrase, n)``: exact counts of phrases of ``k`` words, 1 to 3, with ``often`` occurrences; ``k`` 0: all words.

    First pass: hashes of phrases, added up by block, go to hash partitions; a partition's Misra-Gries summary, with a capacity
    over its mass divided by ``often``, tells which may be frequent. They are marked in a table of bits whose size
    grows with the text up to 64 MB. Second pass: phrases whose bit is set are counted by their words. Bits that
    are set without need, by chance or because a huge table fills them, cost a row of a count, no more:
    the second count decides.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    partition_bits = min(max(0, (size * 2 // 5 // MASS).bit_length()), 24)
    slice_bits = min(SLICE_BITS, MOST_BITS - partition_bits)
    table = np.zeros((1 << partition_bits, 1 << slice_bits >> 3), np.uint8)
    for row in marks(summaries(docs, partition_bits), often, slice_bits).collect():
        table[row.part] = np.frombuffer(row.bits, np.uint8)
    shared = spark.sparkContext.broadcast(table.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        shift = np.uint64(64 - partition_bits - slice_bits)
        for block in blocks(batches, BLOCK_WORDS):
            words, texts = block.hashes(), block.words
            owner = np.array(block.owner, np.int64)
            groups = pa.array(list(block.groups), pa.string())
            for k, (parts, times) in enumerate(block.phrases()):
                if k == 0:
                    n = np.bincount(owner[parts[0]], times, len(block.groups)).astype(np.int64)
                    yield rows(groups, 0, pa.array([""] * len(n), pa.string()), n)
                else:
                    at = phrase_hash(words, parts) >> shift
                    kept = (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                    parts, times = [p[kept] for p in parts], times[kept]
                for i in range(0, len(times), 1 << 16):
                    cut = [p[i : i + (1 << 16)].tolist() for p in parts]
                    own = zip(*(map(texts.__getitem__, p) for p in cut), strict=True)
                    phrases = pa.array(map(b" ".join, own), pa.binary()).cast(pa.string())
                    yield rows(groups.take(pa.array(owner[cut[0]])), k + 1, phrases, times[i : i + (1 << 16)])

    def rows(groups, k, phrases, n):
        return pa.RecordBatch.from_arrays([groups, pa.array(np.full(len(n), k, np.int32)), phrases, pa.array(n.astype(np.int64))], names)

    names = ["group", "k", "phrase", "n"]
    found = docs.mapInArrow(run, "group string, k int, phrase string, n long")
    return found.groupBy("group", "k", "phrase").agg(F.sum("n").alias("n")).filter((F.col("k") == 0) | (F.col("n") >= often))


def scored(phrases: DataFrame, within: int = WITHIN) -> DataFrame:
    """``(group, phrase, k, a, l, r, score)`` of the phrases of two and three words that no longer one covers.

    ``phrases`` is what ``counted`` gives, stored. Each candidate asks for the counts of its parts; answers come
    back by candidate. Scores are exact: products are decimals of 38 digits.
    """
    candidates = phrases.filter("k > 1").select("group", "phrase", "k", F.col("n").alias("a"))
    words = F.split("phrase", " ")
    ends = F.when(F.col("k") == 2, F.array(words[0], words[1])).otherwise(
        F.array(words[0], F.concat_ws(" ", words[1], words[2]), F.concat_ws(" ", words[0], words[1]), words[2])
    )
    asked = candidates.select("group", "phrase", "k", "a", F.posexplode(ends).alias("side", "part"))
    counts = phrases.filter("k > 0").select("group", F.col("phrase").alias("part"), F.col("n").alias("of_part"))
    answered = cut_lineage(asked.join(counts, ["group", "part"]))
    of = [F.max(F.when(F.col("side") == i, F.col("of_part"))).cast("decimal(19,0)").alias(f"of{i}") for i in range(4)]
    whole = answered.groupBy("group", "phrase", "k", F.col("a")).agg(*of)
    whole = whole.withColumn("square", F.expr("CAST(1000000 AS DECIMAL(38,0)) * CAST(a AS DECIMAL(19,0)) * CAST(a AS DECIMAL(19,0))"))

    def worth(cut: int):
        left, right = F.col(f"of{2 * cut}"), F.col(f"of{2 * cut + 1}")
        score = F.expr(f"square DIV (of{2 * cut} * of{2 * cut + 1})")
        return F.struct(score.cast("long").alias("score"), F.lit(cut).alias("cut"), left.cast("long").alias("l"), right.cast("long").alias("r"))

    whole = whole.withColumn("least", F.when(F.col("k") == 2, worth(0)).otherwise(F.least(worth(0), worth(1))))
    covering = answered.filter("k = 3 AND side IN (1, 2)").groupBy("group", F.col("part").alias("phrase")).agg(F.max("a").alias("longer"))
    kept = whole.join(covering, ["group", "phrase"], "left").filter(F.coalesce(100 * F.col("longer") < within * F.col("a"), F.lit(True)))
    return kept.select("group", "phrase", "a", "least.l", "least.r", "least.score")


def best(found: DataFrame, listed: int, ranked: int = RANKED) -> DataFrame:
    """The first ``listed`` rows of each group by score, a and phrase, with their ``rank``.

    One group may have nearly all rows: rows are ranked in parts of some ``ranked`` by hash, and the best of
    each part again, until one part is left.
    """
    order = [F.desc("score"), F.desc("a"), "phrase"]
    while True:
        found = cut_lineage(found)
        parts = -(-found.count() // max(ranked, 4 * listed)) or 1
        by = Window.partitionBy("group", F.pmod(F.xxhash64("phrase"), F.lit(parts))).orderBy(*order)
        found = found.withColumn("rank", F.row_number().over(by).cast("long")).filter(F.col("rank") <= listed)
        if parts == 1:
            return found
        found = found.drop("rank")


def collocations(
    docs: DataFrame, text: str = "text", group: str = "lang", often: int = OFTEN, listed: int = LISTED, within: int = WITHIN
) -> DataFrame:
    """``(group, rank, phrase, a, l, r, n, score)``: each group's best phrases of two or three words, ``listed`` at most.

    Words are what blanks part, A to Z in lower case; no phrase reaches over ``.,;:!?`` or a line break. Everything is by
    group (NULL: ``und``): ``n`` is its number of words, ``a`` that of the phrase's occurrences, ``often`` or more, ``l`` and
    ``r`` those of its two parts at the cut with the lowest score, which is 10^6 a^2 / (l r) rounded
    down. A phrase that stands in a longer one in ``within`` percent of its places goes. Order is by score, a, phrase. NULL and
    empty texts have no words; repeated rows count each time. Groups without a frequent phrase give no row.
    """
    pick = docs.select(F.coalesce(F.col(group).cast("string"), F.lit(NO_GROUP)).alias("group"), F.col(text).alias("text"))
    phrases = cut_lineage(counted(pick, often))
    found = best(scored(phrases, within), listed)
    words = phrases.filter("k = 0").select("group", F.col("n"))
    return found.join(words, "group").select("group", "rank", "phrase", "a", "l", "r", "n", "score")

"""Best fuzzy match of each name against all canonical names, without a cross join.

Names are first reduced to distinct comparison keys. Then

* a dictionary whose measured size is small goes to the tasks once, and the keys
  stream past it in Arrow batches;
* a larger one is sorted and cut into blocks, each known by the prefixes and lengths of
  its texts. Keys ask for high similarities first, then for less and less, each time only
  the blocks that may hold so much, and leave with their answer. Blocks and keys meet in
  co-groups whose size is bounded on both sides, and a block is walked as a prefix tree.
  Copies of blocks are at most as many rows as keys meet them, and what one round stored
  for the next goes with it, so disk grows with the input.

Both ways give the best match over the whole dictionary. No pair leaves a task:
each task returns at most one row per key.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from rollcall.functions import lcs
from rollcall.functions.text import token_key
from rollcall.operators.dictionary import DictionarySize, candidate_keys, dictionary_size
from rollcall.session import cut_lineage, drop_path, scratch_path

for module in (lcs, sys.modules[__name__]):  # executors need no copy of this package
    cloudpickle.register_pickle_by_value(module)

SMALL_ROWS = 5_000
SMALL_BYTES = 1 << 20
TASK_PAIRS = 20_000_000  # pairs that one task may have to look at
BLOCK_ROWS = 400_000
BLOCK_CHARS = 10_000_000
GROUP_KEYS = 400_000
LEAST_KEYS = 1_000  # a group's keys, if there are so many, and one for so many candidates: its tree is built for each group
KEY_ROWS = 20
COPIED_ROWS = 10_000_000  # rows of blocks that may be copied for more tasks; beyond that, as many as there are pairs and candidates
WAVE_PAIRS = 20_000_000  # (key, block) pairs that are shuffled at once; beyond that, some for each key and candidate
WAVE_SHARE = 2
ROUTE_KEYS = 20_000
COVERS = 200_000  # prefixes that stand for all blocks
MOST_TASKS = 20_000
SHORT = 64  # below, a band holds lengths up to twofold; from here on they differ by at most this factor:
BAND = 1.15
PREFIX = 8  # the end of the texts where fewer prefixes of this length occur is sorted by
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

GATE = 80
UNKNOWN = "UNKNOWN"


def similarity(left: Column, right: Column) -> Column:
    """Token-sort similarity of two names, 0 to 100, not rounded."""
    return _pair_similarity(token_key(left), token_key(right))


@F.pandas_udf(DoubleType())
def _pair_similarity(left: pd.Series, right: pd.Series) -> pd.Series:
    known = left.notna() & right.notna()
    return pd.Series(lcs.pair_similarity(left[known].tolist(), right[known].tolist()), left.index[known]).reindex(left.index)


def score(sim: Column) -> Column:
    """Similarity as the reported integer, halves to even."""
    return F.bround(sim).cast("long")


def gate(best: Column, score: Column, above: int = GATE) -> Column:
    """The best match if its score exceeds the gate, else the literal UNKNOWN."""
    return F.when(score > above, best).otherwise(F.lit(UNKNOWN))


def best_match(
    keys: DataFrame,
    dictionary: DataFrame,
    size: DictionarySize | None = None,
    small_rows: int = SMALL_ROWS,
    small_bytes: int = SMALL_BYTES,
    **blocks,
) -> DataFrame:
    """``keys`` (unique, non-null ``key``; further columns are kept) plus ``best`` and ``sim``.

    Of equally similar candidates the one with the smaller ``ord`` is best.
    """
    size = size or dictionary_size(dictionary)
    candidates = candidate_keys(dictionary)
    if not size.names:
        return keys.withColumn("best", F.lit(None).cast("string")).withColumn("sim", F.lit(0.0))
    if size.names <= small_rows and size.name_bytes <= small_bytes:
        return _stream(keys, candidates)
    return _blocks(keys, candidates, **blocks)


def _stream(keys: DataFrame, candidates: DataFrame) -> DataFrame:
    """Every task holds the whole, size-checked dictionary."""
    held = candidates.toArrow().sort_by([("ord", "ascending"), ("standard_name", "ascending")])
    texts = keys.sparkSession.sparkContext.broadcast(
        (held["cand_key"].to_pylist(), held["standard_name"].to_pylist())
    )

    def run(batches):
        cand_keys, names = texts.value
        index = lcs.BestMatch(cand_keys, range(len(cand_keys)))
        for batch in batches:
            row, sim = index.find(batch["key"].to_pylist())
            best = pa.array([names[r] for r in row], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, best, pa.array(sim)], [*batch.schema.names, "best", "sim"]
            )

    # Keys are few bytes but much work: left alone, adaptive execution would merge them into few tasks. So
    # they are stored, counted and dealt out by the pairs they make.
    keys = cut_lineage(keys)
    tasks = min(max(1, math.ceil(keys.count() * len(held) / TASK_PAIRS)), MOST_TASKS)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys.schema.fields)
    return keys.repartition(tasks, F.xxhash64("key")).mapInArrow(run, schema + ", best string, sim double")


def _band(length: Column) -> Column:
    short = F.floor(F.log2(F.greatest(length, F.lit(1))))
    return F.when(length < SHORT, short).otherwise(math.log2(SHORT) + F.floor(F.log(length / SHORT) / math.log(BAND))).cast("int")


def _stored(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` as a table in the shared folder, and its path. The shuffles that made it go at once: nothing reads them again."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "table")
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def _blocks(
    keys: DataFrame,
    candidates: DataFrame,
    block_rows: int = BLOCK_ROWS,
    block_chars: int = BLOCK_CHARS,
    group_keys: int = GROUP_KEYS,
) -> DataFrame:
    """Equal keys by a join; the rest in rounds of co-groups of (block, slice of keys), one for each similarity asked for."""
    spark = keys.sparkSession
    dictionary, rows, routes = _cut(candidates, block_rows, block_chars)
    # Only equal texts (but for empty ones) reach 100, and candidate keys are unique: these are done.
    same = (F.col("key") == F.col("cand_key")) & (F.col("cand_key") != "")
    tagged, _ = _stored(keys.join(dictionary.drop("block"), same, "left"))
    kept = [F.col(f"`{c}`") for c in keys.columns]
    equal = tagged.filter(F.col("cand_key").isNotNull()).select(
        *kept, F.col("standard_name").alias("best"), F.lit(100.0).alias("sim")
    )
    keys = tagged.filter(F.col("cand_key").isNull()).select(*kept)
    most_pairs = max(WAVE_PAIRS, WAVE_SHARE * (tagged.count() + sum(rows.values())))

    def route(asking: DataFrame, tasks: int, first: bool = False) -> tuple[DataFrame, str]:
        """``asking`` is (key, floor): plus the ``blocks`` that may hold a candidate of that similarity, or one of them."""

        def run(batches):
            way = lcs.Routes(*routes.value)
            for batch in batches:
                texts = batch["key"].to_pylist()
                text, block = (np.arange(len(texts)), way.first(texts)) if first else way.find(texts, batch["floor"].to_numpy())
                ends = pa.array(np.searchsorted(text, np.arange(len(texts) + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.ListArray.from_arrays(ends, pa.array(block, pa.int64()))], [*batch.schema.names, "blocks"]
                )

        # Keys are few bytes but much work, as in ``_stream``.
        dealt = asking.select("key", "floor").repartition(tasks, F.xxhash64("key"))
        return _stored(dealt.mapInArrow(run, "key string, floor double, blocks array<long>"))

    def meet(pairs: DataFrame, levels) -> list[tuple[DataFrame, str]]:
        """``pairs`` is (key, floor, block): the best candidate of each key in its blocks, in tables that may share keys."""

        def compare(keys: pa.Table, block: pa.Table) -> pa.Table:
            return _best_in_block(keys, block, levels)

        asked = pairs.groupBy("block").agg(F.count(F.lit(1)), F.sum(F.length("key"))).collect()
        found = []
        for wave in _waves([(block, n) for block, n, _ in asked], most_pairs):
            slices = _slices({r[0]: tuple(r[1:]) for r in asked if r[0] in wave}, rows, group_keys, block_chars)
            firsts = np.cumsum([0, *slices.values()]).tolist()
            placed = [(block, n, first) for (block, n), first in zip(slices.items(), firsts)]
            some = F.broadcast(spark.createDataFrame(placed, "block long, slices int, first int"))
            # Each group has a partition of its own; equal hashes would leave some tasks with several.
            tasks = min(firsts[-1], MOST_TASKS)
            slice_ = F.pmod(F.xxhash64("key"), "slices").cast("int")
            dealt = pairs.join(some, "block").select((F.col("first") + slice_).alias("group"), "key", "floor")
            groups = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("slices") - 1)).alias("group")
            copied = dictionary.join(some, "block").select(groups, "cand_key", "ord", "standard_name")
            best = (
                dealt.repartitionById(tasks, F.col("group"))
                .groupBy("group")
                .cogroup(copied.repartitionById(tasks, F.col("group")).groupBy("group"))
                .applyInArrow(compare, "key string, ord long, best string, sim double")
            )
            found.append(_stored(_winner(best)))
        return found

    def union(tables: list[tuple[DataFrame, str]]) -> DataFrame:
        both = tables[0][0]
        for table, _ in tables[1:]:
            both = both.unionByName(table)
        return both

    def drop(tables: list[tuple[DataFrame, str]]) -> None:
        for _, path in tables:
            drop_path(spark, path)

    def settled(tables: list[tuple[DataFrame, str]]) -> tuple[DataFrame, str]:
        """One row per key; of several tables, each was left with the best of its own blocks."""
        if len(tables) == 1:
            return tables[0]
        one = _stored(_winner(union(tables)))
        drop(tables)
        return one

    def dealt_to(todo: DataFrame) -> int:
        return min(max(1, math.ceil(todo.count() / ROUTE_KEYS)), MOST_TASKS)

    if len(rows) == 1:
        (only,) = rows
        best = settled(meet(keys.select("key", F.lit(-1.0).alias("floor"), F.lit(only).cast("long").alias("block")), None))[0]
        return equal.unionByName(keys.join(best.drop("ord"), "key"))

    # All candidates of at least ``level`` are in the blocks that are asked, so what is found there is the best of all.
    walks = (F.length("key") > 0) & (F.length("key") <= lcs.WALKED)
    left, answers = _stored(keys.filter(walks).select("key")), []
    for level in lcs.LEVELS:
        if left[0].isEmpty():
            break
        routed = route(left[0].withColumn("floor", F.lit(level)), dealt_to(left[0]))
        best = settled(meet(routed[0].withColumn("block", F.explode("blocks")), (level,)) or [_stored(_none(spark))])
        rest = _stored(left[0].join(best[0], "key", "left_anti"))
        drop([left, routed])
        left, answers = rest, [*answers, best]
    # Long keys, and those without anything similar: the score found in one block rules out what it can of the others.
    late = _stored(left[0].unionByName(keys.filter(~walks).select("key")))
    drop([left])
    if not late[0].isEmpty():
        tasks = dealt_to(late[0])
        own = route(late[0].withColumn("floor", F.lit(-1.0)), tasks, first=True)
        near = settled(meet(own[0].withColumn("block", F.explode("blocks")), ()))
        routed = route(near[0].withColumn("floor", F.col("sim")), tasks)
        further = routed[0].withColumn("block", F.explode("blocks")).join(own[0].select("key", F.col("blocks")[0].alias("own")), "key")
        best = meet(further.filter(F.col("block") != F.col("own")).select("key", "floor", "block"), ())
        answers.append(settled([near, *best]))
        drop([own, routed])
    drop([late])
    best = union(answers or [_stored(_none(spark))])
    return equal.unionByName(keys.join(best.drop("ord"), "key"))


def _none(spark) -> DataFrame:
    return spark.createDataFrame([], "key string, ord long, best string, sim double")


def _cut(candidates: DataFrame, block_rows: int, block_chars: int):
    """Candidates with their ``block``, stored; rows of each block; what ``lcs.Routes`` is made of, for tasks.

    Texts of a band of lengths are sorted, from the end where they have more in common, and cut into ranges. Texts of a range
    that is too large all the same, long ones, are dealt to some blocks by hash.
    """
    spark = candidates.sparkSession
    listed, at = _stored(candidates)
    length = F.length("cand_key")
    ends = (F.approx_count_distinct(F.substring("cand_key", *cut)) for cut in ((1, PREFIX), (-PREFIX, PREFIX)))
    count, chars, longest, heads, tails = listed.agg(F.count(F.lit(1)), F.sum(length), F.max(length), *ends).first()
    parts = max(1, math.ceil(count / block_rows), math.ceil(chars / block_chars))
    if parts == 1 and count * min(longest, 255) <= 2 * block_chars:
        return listed.withColumn("block", F.lit(0).cast("long")), {0: count}, None
    back = tails < heads
    text = F.reverse("cand_key") if back else F.col("cand_key")
    ranged = listed.withColumn("band", _band(length)).repartitionByRange(parts, "band", text)
    ranged, _ = _stored(ranged.withColumn("part", F.spark_partition_id()))
    drop_path(spark, at)
    # A row for each range, and about a hundred for where bands meet in one.
    groups = ranged.groupBy("part", "band").agg(F.count(F.lit(1)).alias("n"), F.sum(length).alias("chars")).collect()
    numbered, blocks = [], 0
    for part, band, n, chars in sorted(tuple(g) for g in groups):
        split = max(1, math.ceil(n / (2 * block_rows)), math.ceil(chars / (2 * block_chars)))
        numbered.append((part, band, blocks, split))
        blocks += split
    placed = F.broadcast(spark.createDataFrame(numbered, "part int, band int, first long, split int"))
    block = F.col("first") + F.pmod(F.xxhash64("cand_key"), "split")
    dictionary = ranged.join(placed, ["part", "band"]).select("cand_key", "ord", "standard_name", block.alias("block"))
    most = min(lcs.COVER, max(1, COVERS // blocks))

    def covered(block: pa.Table) -> pa.Table:
        texts = block["cand_key"].to_pylist()
        prefix, least, greatest = zip(*lcs.cover(texts, back, most))
        same = [block["block"][0].as_py()] * len(prefix)
        return pa.table({"block": same, "prefix": prefix, "least": least, "greatest": greatest, "n": [len(texts)] * len(prefix)})

    few = dictionary.select("block", "cand_key").repartition(min(blocks, MOST_TASKS), "block").groupBy("block")
    cover = few.applyInArrow(covered, "block long, prefix string, least long, greatest long, n long").toArrow()
    rows = dict(zip(cover["block"].to_pylist(), cover["n"].to_pylist()))
    known = tuple(cover[c].to_pylist() for c in ("block", "prefix", "least", "greatest"))
    return dictionary, rows, spark.sparkContext.broadcast((*known, back))


def _waves(asked, most_pairs: int) -> list[set]:
    """Blocks with their numbers of pairs, in sets of up to ``most_pairs`` pairs, or of one block."""
    waves, held = [], 0
    for block, n in sorted(asked):
        if not waves or held + n > most_pairs:
            waves.append(set())
            held = 0
        waves[-1].add(block)
        held += n
    return waves


def _slices(asked: dict, rows: dict, group_keys: int, group_chars: int) -> dict:
    """Slices that each block's keys are cut into; ``asked`` is {block: (keys, their characters)}, ``rows`` {block: candidates}.

    Each slice copies its block. More than ``COPIED_ROWS`` are copied only as far as there are keys and candidates to
    compare, or where a task could not hold the keys.
    """
    pairs, whole = sum(n for n, _ in asked.values()), sum(rows[b] for b in asked)
    least = 1.0
    while True:
        slices = {}
        for block, (n, chars) in asked.items():
            most = min(group_keys, max(LEAST_KEYS, rows[block] / KEY_ROWS) * least)
            slices[block] = max(1, math.ceil(n / most), math.ceil(chars / group_chars))
        copied = sum(rows[b] * k for b, k in slices.items())
        if copied <= max(COPIED_ROWS, pairs + whole) or least > group_keys:
            return slices
        least *= 1.25


def _winner(found: DataFrame) -> DataFrame:
    """The most similar row per key; the smaller ``ord``, then the smaller name, on a tie."""
    rank = F.struct((-F.col("sim")).alias("loss"), "ord", "best")
    return found.groupBy("key").agg(F.min(rank).alias("w")).select(
        "key", F.col("w.ord").alias("ord"), F.col("w.best").alias("best"), (-F.col("w.loss")).alias("sim")
    )


def _best_in_block(keys: pa.Table, block: pa.Table, levels) -> pa.Table:
    block = block.sort_by([("ord", "ascending"), ("standard_name", "ascending")])
    won, sim, names = np.empty(0, int), np.empty(0), []
    if len(keys) and len(block):
        index = lcs.Tree(block["cand_key"].to_pylist(), range(len(block)))
        row, sim = index.find(keys["key"].to_pylist(), keys["floor"].to_numpy(), levels)
        hit = row >= 0
        won, sim, names = row[hit], sim[hit], keys["key"].filter(pa.array(hit))
    found = block.take(pa.array(won, pa.int64()))
    return pa.table(
        {
            "key": pa.chunked_array([names], pa.string()) if isinstance(names, list) else names,
            "ord": found["ord"],
            "best": found["standard_name"],
            "sim": pa.array(sim, pa.float64()),
        }
    )

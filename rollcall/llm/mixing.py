"""Mixing sources to target weights: balanced samples of whole documents by the cube method."""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.components import Rounds
from rollcall.llm.joins import BROADCAST_ROWS, sized
from rollcall.session import cut_lineage

WORD = "[^\\x20\\x09-\\x0D]+"
#: Weights of the sources in code-point order, repeating; words of the mix as a share of all; copies of a document at most.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
#: Documents of a source whose probabilities one task moves.
BLOCK = 20_000
#: Documents that are kept for the landing beside the two that the flight leaves: all their samples are looked at.
LANDING = 12
#: A probability this close to 0 or 1 is decided.
SURE = 1e-9
#: Bytes of source names that may be broadcast.
BROADCAST_BYTES = 32 << 20
SEED = 12


def numbered(sources: DataFrame, source: str) -> DataFrame:
    """``sources`` with ``place``, from 0, in code-point order, NULL last; sorted and counted by all tasks."""
    sorted_ = sources.orderBy(F.col(source).asc_nulls_last()).withColumn("place", F.monotonically_increasing_id())
    sorted_ = cut_lineage(sorted_)
    part = F.shiftright("place", 33)  # as monotonically_increasing_id numbers partitions and their rows
    parts = sorted_.groupBy(part.alias("part")).agg(F.count("*").alias("rows")).orderBy("part").collect()  # one row a task
    ahead, before = [], 0
    for row in parts:
        ahead += [F.lit(row.part).cast("long"), F.lit(before).cast("long")]
        before += row.rows
    if not ahead:
        return sorted_
    offset = F.element_at(F.create_map(*ahead), part)
    return sorted_.withColumn("place", offset + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)))


def water_level(sources: DataFrame, total: float) -> float:
    """The ``level`` at which ``min(cap, weight * level)`` adds up to ``total`` over ``sources``.

    Caps that the level exceeds are held, and what is above them is shared again by weight among the others,
    until none is above. Each round is one aggregate.
    """
    level, above = 0.0, -1
    while True:
        over = F.col("cap") < F.col("weight") * F.lit(level)
        held, free, n = sources.agg(
            F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)),
            F.coalesce(F.sum(over.cast("long")), F.lit(0)),
        ).first()
        if n == above or not free:
            return level if free else float("inf")
        level, above = (total - held) / free, n


def targets(
    rows: DataFrame, source: str = "source", weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """``(source, place, n, source_size, target)``, one row per source of ``rows`` (source, size); NULL is a source.

    Targets add up to ``share`` of all sizes, by weight; none is over ``most`` times its source's size.
    """
    sizes = rows.groupBy(source).agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    by_place = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("place") % len(weights) + 1).cast("int"))
    found = numbered(sizes, source).withColumn("weight", by_place).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    found = cut_lineage(found)
    total = share * (found.agg(F.sum("source_size")).first()[0] or 0)
    target = F.least("cap", F.col("weight") * F.lit(water_level(found, total)))
    return found.select(source, "place", "n", "source_size", target.alias("target"))


def move(units: list[list], draw: random.Random) -> None:
    """Move the probabilities ``unit[1]`` of three units of sizes ``unit[0]`` along the null space of (sizes, ones).

    The sums of size times probability and of probabilities stay; at least one probability becomes 0 or 1. Of the
    two directions each is drawn with the probability that keeps every unit's expected value.
    """
    a, b, c = (unit[0] for unit in units)
    along = (b - c, c - a, a - b)
    if not any(along):
        along = (1, -1, 0)
    reach = []
    for sign in (1, -1):
        room = [((1 - u[1]) / (sign * x) if sign * x > 0 else u[1] / -(sign * x)) if x else float("inf") for u, x in zip(units, along, strict=True)]
        reach.append((min(room), room.index(min(room)), sign))
    forth, back = reach
    step, first, sign = forth if draw.random() * (forth[0] + back[0]) < back[0] else back
    for unit, x in zip(units, along, strict=True):
        moved = unit[1] + sign * x * step
        unit[1] = 0.0 if moved < SURE else 1.0 if moved > 1 - SURE else moved
    units[first][1] = 1.0 if sign * along[first] > 0 else 0.0


def flight(units: Iterable[list], draw: random.Random) -> Iterator[list]:
    """``units`` [size, probability, ..] as they are decided; up to two undecided ones come last."""
    held: list[list] = []
    for unit in units:
        held.append(unit)
        if len(held) == 3:
            move(held, draw)
            yield from (u for u in held if u[1] in (0.0, 1.0))
            held = [u for u in held if u[1] not in (0.0, 1.0)]
    yield from held


def spaced(units: Iterable[list], most: int, kept: list[list]) -> Iterator[list]:
    """``units``, the largest first, but for up to ``most`` that go to ``kept``: each at most half as large as the one before.

    What the flight leaves may be large. Samples of the kept ones differ by amounts of every order, so one of them makes up for it.
    """
    edge = float("inf")
    for unit in units:
        if len(kept) < most and unit[0] <= edge:
            kept.append(unit)
            edge = unit[0] / 2
        else:
            yield unit


def land(units: list[list]) -> None:
    """Decide the few units left: the sample whose size comes closest to what their probabilities say, then its number."""
    if not units:
        return
    sizes, chances = np.array([u[0] for u in units], float), np.array([u[1] for u in units])
    samples = np.arange(1 << len(units))[:, None] >> np.arange(len(units)) & 1
    off = np.abs(samples @ sizes - sizes @ chances)
    number = np.abs(samples.sum(axis=1) - chances.sum())
    best = samples[np.lexsort((number, np.round(off, 6)))[0]]
    for unit, taken in zip(units, best.tolist(), strict=True):
        unit[1] = float(taken)


def fly(units: DataFrame, seed: int, turn: int, landing: int) -> DataFrame:
    """``units`` (place, block, last, id, size, chance) with new chances; all are decided in blocks that are the ``last``.

    A task holds the few units that are undecided, whatever the block's size.
    """
    names = ["place", "id", "size", "chance"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                columns = (batch.column(c).to_pylist() for c in ("place", "block", "last", "size", "chance", "id"))
                yield from zip(*columns, strict=True)

        def decided():
            stream = rows()
            row = next(stream, None)
            while row:
                place, block, last = key = row[:3]

                def own():
                    nonlocal row
                    while row and row[:3] == key:
                        yield [row[3], row[4], place, row[5]]
                        row = next(stream, None)

                rest = []
                for unit in flight(spaced(own(), landing, rest), random.Random(f"{seed} {turn} {place} {block}")):
                    if unit[1] in (0.0, 1.0):
                        yield unit
                    else:
                        rest.append(unit)
                if last:
                    land(rest)
                yield from rest

        out = []
        for unit in decided():
            out.append(unit)
            if len(out) == 4096:
                yield made(out)
                out = []
        if out:
            yield made(out)

    def made(out: list[list]) -> pa.RecordBatch:
        size, chance, place, id = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(id, kind), pa.array(size, pa.int64()), pa.array(chance)], names)

    kind = units.limit(0).select("id").toArrow().schema.field(0).type
    # The largest come first: what is left undecided in the end is small. Order and draws depend on the rows alone.
    dealt = units.repartition("place", "block").sortWithinPartitions("place", "block", F.desc("size"), F.xxhash64("id"), "id")
    return dealt.mapInArrow(run, f"place long, id {units.schema['id'].dataType.simpleString()}, size long, chance double")


def balanced(units: DataFrame, block: int = BLOCK, landing: int = LANDING, seed: int = SEED) -> DataFrame:
    """``(place, id, size, chance)`` of ``units`` with every chance 0 or 1: a sample balanced on sizes and numbers by place.

    Flight phase: a place's units are cut into blocks by hash; each block leaves ``landing`` and two undecided, which meet in
    fewer blocks in the next turn, until a place has one. Its last units land. So a place with a third
    of all units is spread over many tasks, and the turns grow with the logarithm of its size.
    """
    if block < 2 * (landing + 2):
        raise ValueError("a block must be twice as large as what it leaves undecided")
    rounds, done, turn = Rounds(units.sparkSession), [], 0
    while True:
        sizes = cut_lineage(units.groupBy("place").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")))
        blocks = F.pmod(F.xxhash64("id", "size", F.lit(turn)), "blocks").alias("block")
        cut = units.join(sized(sizes), "place").select("place", blocks, (F.col("blocks") == 1).alias("last"), "id", "size", "chance")
        flown = rounds.store(fly(cut, seed, turn, landing))
        sure = F.col("chance").isin(0.0, 1.0)
        done.append(flown.filter(sure))
        units, turn = flown.filter(~sure), turn + 1
        if not units.limit(1).count():
            break
    for more in done[1:]:
        done[0] = done[0].unionByName(more)
    return done[0]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def mixed(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    block: int = BLOCK,
    seed: int = SEED,
) -> DataFrame:
    """``(id, source, size, source_size, target, copies, taken)`` per row: how often the mix takes it, and the words of that.

    Size is the number of words (NULL and empty texts: 0). A source's target is a multiple of its size: each of its
    documents is taken that many times, rounded down, and once more with the remainder as its probability,
    by one balanced sample, so the words taken come as near the target as whole documents allow. NULL is a source of its
    own, the last. Repeated rows and NULL ids are documents like others; rows alike in id and size may be told apart
    by their copies only. The draws depend on the rows, not on how they are dealt, so a run over the same rows
    gives the same mix. A source without words takes none. An empty table gives no rows.
    """
    rows = cut_lineage(docs.select(F.col(id).alias("id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size")))
    plan = cut_lineage(targets(rows, "source", weights, share, most))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio + SURE).cast("long")
    plan = plan.select("source", "place", "source_size", "target", whole.alias("whole"), F.greatest(ratio - whole, F.lit(0.0)).alias("chance"))
    n, named_bytes = plan.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("source")), F.lit(0))).first()
    if n <= BROADCAST_ROWS and named_bytes <= BROADCAST_BYTES:
        plan = F.broadcast(plan)
    places = plan.select(F.col("source").alias("_source"), "place", "chance")
    units = rows.join(places, F.col("source").eqNullSafe(F.col("_source"))).select("place", "id", "size", "chance")
    open_ = F.col("chance") > SURE
    taken = balanced(units.filter(open_), block, seed=seed).unionByName(units.filter(~open_).withColumn("chance", F.lit(0.0)))
    copies = F.col("whole") + F.col("chance").cast("long")
    found = taken.join(plan.drop("chance"), "place")
    return found.select("id", "source", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"))

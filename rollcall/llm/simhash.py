"""SimHash fingerprints, and their links within two bits through a grid of segment bit counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rollcall.llm.components import components
from rollcall.llm.joins import drop_ids
from rollcall.session import cut_lineage

SEED = 42
#: Shingles whose bits are counted at a time; bounds the memory of a very long text.
STRIDE = 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of the word shingles of a text, repeats included, as a signed number.

    Words are runs without ASCII white space, A-Z lower-cased. Fewer words than a
    shingle make one shingle; no word (NULL, empty, blank) gives 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        runs = [b" ".join(words)]
    else:
        runs = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(runs), STRIDE):
        part = runs[at : at + STRIDE]
        hashes = np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in part), np.uint64, len(part))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(runs), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """``(id, fp)``, one row per row of ``docs``; other columns are left behind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(x, shingle) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["id", "fp"])

    pick = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return pick.mapInArrow(run, f"id {pick.schema['id'].dataType.simpleString()}, fp long")


def _half(bits) -> str:
    """SQL: the bit counts of the eight 4-bit segments of a 32-bit number, packed 4 bits each."""
    pairs = f"(({bits}) & 1431655765L) + (shiftrightunsigned({bits}, 1) & 1431655765L)"
    return f"(({pairs}) & 858993459L) + (shiftrightunsigned({pairs}, 2) & 858993459L)"


#: SQL over ``fp``: its point in the grid, sixteen counts of 0 to 4.
POINT = f"shiftleft({_half('shiftrightunsigned(fp, 32)')}, 32) | ({_half('fp & 4294967295L')})"


def _cells(fps: DataFrame) -> DataFrame:
    """``(fp, step, cell)``: the grid cells within Manhattan distance one; step +-s moves the count of segment s - 1."""
    steps = F.array(*(F.lit(i) for i in range(-16, 17)))
    moved = fps.select("fp", F.expr(POINT).alias("point"), F.explode(steps).alias("step"))
    moved = moved.withColumn("at", F.expr("4 * (abs(step) - 1)"))
    count = F.expr("IF(step = 0, 0L, shiftrightunsigned(point, at) & 15)")
    fits = F.expr("step = 0 OR (step > 0 AND count < 4) OR (step < 0 AND count > 0)")
    cell = F.expr("point + sign(step)::int * IF(step = 0, 0L, shiftleft(1L, at))")
    return moved.withColumn("count", count).filter(fits).select("fp", "step", cell.alias("cell"))


def near_links(fps: DataFrame, max_distance: int = 2) -> DataFrame:
    """``(a, b)`` with a < b at ``max_distance`` bits or fewer (0 to 2) that connect all distinct ``fp`` so near.

    Not all pairs: fingerprints within one bit of the same 64-bit centre are within two of each
    other, so a star per centre connects what the pairs would. The counts of two fingerprints
    differ by no more than their bits (Manhattan distance), so a common centre lies in a grid
    cell that both reach; cells that hold one fingerprint only are dropped before centres are made.
    A centre has at most 65 members, whatever the input.
    """
    if not 0 <= max_distance <= 2:
        raise ValueError("links are defined for up to two bits")
    cells = _cells(fps)
    shared = cells.groupBy("cell").agg(F.min("fp").alias("least"), F.max("fp").alias("most"))
    shared = cut_lineage(shared.filter("least <> most").select("cell"))
    met = cells.join(shared, "cell")
    flips = F.explode(F.when(F.col("step") == 0, F.array(F.lit(-1))).otherwise(F.array(*map(F.lit, range(4)))))
    near = met.select("fp", "step", flips.alias("j"))
    bit = "shiftleft(1L, 4 * (abs(step) - 1) + j)"
    near = near.filter(f"j < 0 OR ((fp & {bit}) = 0) = (step > 0)")
    near = near.select("fp", F.expr(f"IF(j < 0, fp, fp ^ {bit})").alias("centre"))
    stars = near.groupBy("centre").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    if max_distance == 2:
        hub = F.array_min("fps")
    else:
        stars = stars.filter(F.array_contains("fps", F.col("centre")))
        hub = F.col("centre")
    ends = stars.select(hub.alias("hub"), F.explode("fps").alias("fp")).filter("hub <> fp")
    ends = ends.select(F.least("hub", "fp").alias("a"), F.greatest("hub", "fp").alias("b")).distinct()
    return ends.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance)


def _labelled(prints: DataFrame, place, max_distance: int) -> DataFrame:
    """``prints`` (fp, ..) with ``first``, the least ``place`` reachable over links, its own included."""
    nodes = prints.groupBy("fp").agg(F.min(place).alias("least"))
    found = components(near_links(nodes.select("fp"), max_distance))
    named = nodes.join(found, nodes.fp == found.node, "left")
    named = cut_lineage(named.select("fp", "least", F.coalesce("component", "fp").alias("component")))
    smallest = named.groupBy("component").agg(F.min("least").alias("first"))
    labels = cut_lineage(named.join(cut_lineage(smallest), "component").select("fp", "first"))
    return prints.join(labels, "fp")


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, max_distance: int = 2
) -> DataFrame:
    """``(id, fp, component_id)`` for each row: the least id reachable over links, its own included.

    Equal fingerprints are linked; repeated rows and ids stay separate rows. A NULL id is
    never the least unless its component has no other. An empty table gives none.
    """
    prints = cut_lineage(fingerprints(docs, id, text, shingle))
    found = _labelled(prints, F.col("id"), max_distance)
    return found.select("id", "fp", F.col("first").alias("component_id"))


def _marked(docs: DataFrame, text: str, shingle: int) -> DataFrame:
    """``(row, at, fp)``: each row whole, a number of its own and its fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(x.as_py(), shingle) for x in batch.column(0).field(text)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps, pa.int64())], ["row", "at", "fp"])

    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    pick = docs.select(row, F.monotonically_increasing_id().alias("at"))
    return pick.mapInArrow(run, StructType([*pick.schema.fields, StructField("fp", LongType())]))


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """One row of each component, with the columns of ``docs``: the least id's, the first stored of several rows that have it.

    Rows are stored with a number each, and the number decides: of rows that share an id or have none, those unlike
    all others stay, and of those in one component one stays. A NULL id comes last.
    """
    rows = cut_lineage(_marked(docs, text, shingle))
    prints = rows.select(F.col("row").getField(id).alias("id"), "at", "fp")
    found = _labelled(prints, F.struct(F.col("id").isNull().alias("none"), "id", "at"), max_distance)
    return drop_ids(rows, found.filter(F.col("at") != F.col("first.at")).select("at"), "at").select("row.*")

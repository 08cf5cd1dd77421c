"""Token counts: the pieces of each distinct pre-token, joined to the pre-token frequencies of documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.packing import slices
from rollcall.llm.pretokens import cut, encode

#: Characters of the documents of one block; documents of a block share one list per pre-token.
BLOCK_CHARS = 1 << 23
#: Documents of a block at most, so that a document's place fits 16 bits.
BLOCK_DOCS = 1 << 16
#: Buckets of pre-tokens for each task that adds them up.
BUCKETS = 8
#: Sums that a task holds before it passes them on.
HELD = 1 << 20
#: One posting: a document's place in its block and how often the pre-token is there.
POSTING = np.dtype([("doc", "<u2"), ("times", "<u2")])
TOTAL = np.dtype([("doc", "<u2"), ("tokens", "<i8")])


def postings(texts: list[str], path: str) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    """The distinct pre-tokens of some texts, the postings by pre-token, and where each one's postings end."""
    cuts = [cut(x, path) for x in texts]
    doc = np.repeat(np.arange(len(texts)), [len(c) for c in cuts])
    coded = pa.array([p for c in cuts for p in c], pa.string()).dictionary_encode()
    keys, times = np.unique(coded.indices.to_numpy().astype(np.int64) * BLOCK_DOCS + doc, return_counts=True)
    whole = times // 0xFFFF  # a count beyond 16 bits goes on in further postings
    if whole.any():
        keys = np.repeat(keys, whole + 1)
        last = np.cumsum(whole + 1) - 1
        full = np.full(len(keys), 0xFFFF)
        full[last] = times % 0xFFFF
        times = full
    listed = np.empty(len(keys), POSTING)
    listed["doc"], listed["times"] = keys % BLOCK_DOCS, times
    ends = np.cumsum(np.bincount(keys // BLOCK_DOCS, minlength=len(coded.dictionary)))
    return coded.dictionary, listed, ends


def frequencies(docs: DataFrame, path: str, buckets: int) -> DataFrame:
    """``(bucket, block, tokens, sizes, data, docs)`` of ``docs`` (id, text).

    A block's distinct pre-tokens are dealt out to buckets by their hash; a row holds those of one block
    and bucket, with the number and the list of their postings. A row without pre-tokens holds the block's documents.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for ids, texts in slices(batch, BLOCK_CHARS):
                for at in range(0, len(ids), BLOCK_DOCS):
                    own = texts[at : at + BLOCK_DOCS]
                    yield from dealt(block, *postings(own, path))
                    rows = [{"id": i, "n_bytes": len(x.encode())} for i, x in zip(ids[at : at + BLOCK_DOCS], own, strict=True)]
                    none = [pa.nulls(1, kinds[c]) for c in ("tokens", "sizes", "data")]
                    heads = [pa.array([hash(block) % buckets], pa.int32()), pa.array([block]), *none, pa.array([rows], kinds["docs"])]
                    yield pa.RecordBatch.from_arrays(heads, list(kinds))
                    block += 1

    def dealt(block: int, tokens: pa.StringArray, listed: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        bucket = (pd.util.hash_array(tokens.to_numpy(zero_copy_only=False), categorize=False) % buckets).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        sizes = np.diff(ends, prepend=0)
        starts, sizes = (ends - sizes)[order], sizes[order]
        ends = np.cumsum(sizes)
        listed = listed[np.repeat(starts - (ends - sizes), sizes) + np.arange(len(listed))]
        used, first = np.unique(bucket[order], return_index=True)
        bounds = np.append(first, len(order)).astype(np.int32)
        bytes_to = np.concatenate([[0], ends])[bounds] * POSTING.itemsize
        if not len(used):
            return
        columns = [
            pa.array(used),
            pa.array(np.full(len(used), block)),
            pa.ListArray.from_arrays(bounds, tokens.take(pa.array(order))),
            pa.ListArray.from_arrays(bounds, pa.array(sizes.astype(np.int32))),
            pa.Array.from_buffers(pa.binary(), len(used), [None, pa.py_buffer(bytes_to.astype(np.int32)), pa.py_buffer(listed.tobytes())]),
            pa.nulls(len(used), kinds["docs"]),
        ]
        yield pa.RecordBatch.from_arrays(columns, list(kinds))

    kind = docs.schema["id"].dataType
    kinds = {
        "bucket": pa.int32(),
        "block": pa.int64(),
        "tokens": pa.list_(pa.string()),
        "sizes": pa.list_(pa.int32()),
        "data": pa.binary(),
        "docs": pa.list_(pa.struct([("id", _arrow(kind)), ("n_bytes", pa.int64())])),
    }
    schema = "bucket int, block long, tokens array<string>, sizes array<int>, data binary"
    return docs.mapInArrow(run, f"{schema}, docs array<struct<id: {kind.simpleString()}, n_bytes: long>>")


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _sums(path: str, head: pa.DataType):
    """Per task: pieces once per distinct pre-token (its bucket's rows come together), times the postings, summed by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, doc, tokens, held = [], [], [], 0
        bucket, pieces = None, {}
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                if row.column("tokens").null_count:
                    yield pa.RecordBatch.from_arrays([row.column("block"), pa.nulls(1, pa.binary()), row.column("docs")], out)
                    continue
                if row.column("bucket")[0] != bucket:
                    bucket, pieces = row.column("bucket")[0], {}
                own = row.column("tokens").flatten().to_pylist()
                new = list(set(own).difference(pieces))
                pieces.update(zip(new, map(len, encode(new, path)), strict=True))
                listed = np.frombuffer(row.column("data")[0].as_buffer(), POSTING)
                counts = np.fromiter(map(pieces.__getitem__, own), np.int64, len(own))
                tokens.append(np.repeat(counts, row.column("sizes").flatten().to_numpy()) * listed["times"])
                block.append(np.full(len(listed), row.column("block")[0].as_py()))
                doc.append(listed["doc"])
                held += len(listed)
                if held >= HELD:
                    yield totals(block, doc, tokens)
                    block, doc, tokens, held = [], [], [], 0
        if held:
            yield totals(block, doc, tokens)

    def totals(block, doc, tokens) -> pa.RecordBatch:
        block, doc, tokens = np.concatenate(block), np.concatenate(doc), np.concatenate(tokens)
        blocks, at = np.unique(block, return_inverse=True)
        keys, place = np.unique(at * BLOCK_DOCS + doc, return_inverse=True)
        total = np.empty(len(keys), TOTAL)
        total["doc"], total["tokens"] = keys % BLOCK_DOCS, np.bincount(place, tokens, len(keys)).astype(np.int64)
        ends = np.searchsorted(keys // BLOCK_DOCS, np.arange(len(blocks) + 1)) * TOTAL.itemsize
        data = pa.Array.from_buffers(pa.binary(), len(blocks), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(total.tobytes())])
        return pa.RecordBatch.from_arrays([pa.array(blocks), data, pa.nulls(len(blocks), head)], out)

    out = ["block", "data", "docs"]
    return run


def token_counts(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens)`` of every row; NULL and empty texts have 0.

    Documents are read in blocks; each block gives its distinct pre-tokens with the documents they are in, in buckets by
    the pre-token's hash. A bucket's rows of all blocks meet in one task, which encodes each distinct pre-token
    once and adds its pieces, times the frequencies, to the documents. A common pre-token is there once a block, not once
    a document. The sums of a block then meet by block, whose size is bounded. Ids of tokens are never kept. Repeated
    rows and ids are counted one by one.
    """
    pick = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = pick.schema["id"].dataType
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = frequencies(pick, tokenizer, tasks * BUCKETS)
    dealt = rows.repartition(tasks, "bucket").sortWithinPartitions("bucket")
    head = pa.list_(pa.struct([("id", _arrow(kind)), ("n_bytes", pa.int64())]))
    heads = f"array<struct<id: {kind.simpleString()}, n_bytes: long>>"
    sums = dealt.mapInArrow(_sums(tokenizer, head), f"block long, data binary, docs {heads}")

    def gather(table: pa.Table) -> pa.Table:
        heads = pc.is_valid(table["docs"])
        own = table.filter(heads)["docs"].combine_chunks()
        own = (own.combine_chunks() if isinstance(own, pa.ChunkedArray) else own).flatten()
        total = np.zeros(len(own), np.int64)
        for part in table.filter(pc.invert(heads))["data"]:
            listed = np.frombuffer(part.as_buffer(), TOTAL)
            total[listed["doc"]] += listed["tokens"]
        return pa.table([own.field("id"), own.field("n_bytes"), pa.array(total)], names=["id", "n_bytes", "n_tokens"])

    return sums.groupBy("block").applyInArrow(gather, f"id {kind.simpleString()}, n_bytes long, n_tokens long")

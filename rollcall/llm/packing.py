"""Packing token sequences into windows by minimum bin slack."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.pretokens import encode_texts

WINDOW = 2048
END_ID = 1
#: Tokens that one task packs together, and characters that it encodes together; both bound its memory.
BLOCK_TOKENS = 1 << 21
ENCODE_CHARS = 1 << 23


def fullest(left: Counter[int], window: int) -> Counter[int]:
    """The multiset of lengths in ``left`` whose sum comes closest to ``window`` from below.

    A sum that is the window itself is sought with the longest length in it first, which few others go with; only
    if there is none are all lengths tried.
    """
    lengths = sorted(left, reverse=True)
    longest = lengths[0]
    fitting = [x for x in lengths if x <= window - longest]
    more = Counter(left)
    more[longest] -= 1
    taken = _subset(more, fitting, window, longest)
    if taken is None:
        return _subset(left, lengths, window, 0)
    taken[longest] += 1
    return taken


def _subset(left: Counter[int], lengths: list[int], window: int, held: int) -> Counter[int] | None:
    """The counts of ``lengths`` that, with ``held``, come closest to ``window``; with some held, only if they reach it.

    Subset sums are the bits of a number: a length that is there c times is shifted in as
    1, 2, 4 .. copies that add up to c. The sums are no longer extended once the window can
    be filled. The counts are found by going back through the shifts.
    """
    mask, sums, steps = (1 << window + 1) - 1, 1 << held, []
    for length in lengths:
        count, copies = min(left[length], (window - held) // length), 1
        while count > 0:
            copies = min(copies, count)
            steps.append((length, copies, sums))
            sums |= sums << length * copies & mask
            count -= copies
            copies *= 2
        if sums >> window:
            break
    at, taken = sums.bit_length() - 1, Counter()
    if held and at < window:
        return None
    for length, copies, before in reversed(steps):
        if not before >> at & 1:
            taken[length] += copies
            at -= length * copies
    return taken


def plan(left: Counter[int], window: int) -> Iterator[tuple[Counter[int], int]]:
    """Fillings ``(lengths, times)`` that use up ``left``; each is repeated as often as the counts allow."""
    left = Counter(left)
    while left:
        filling = fullest(left, window)
        times = min(left[x] // n for x, n in filling.items())
        yield filling, times
        for x, n in filling.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]


def powers(total: int) -> list[int]:
    """The powers of two that add up to ``total``, largest first."""
    return [1 << i for i in range(total.bit_length() - 1, -1, -1) if total >> i & 1]


def pack(lengths: list[int], window: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """``(document, start, length, sequence, offset)`` pieces of documents of these lengths, and the number of sequences.

    A document longer than a window gives full windows first; what remains of each is packed by
    ``plan``. A filling short of the window takes its slack from the front of the next filling's
    pieces, which are cut there; what is left at the very end is cut into sequences
    whose lengths are powers of two. So no sequence needs padding.
    """
    pieces, sequence, rest = [], 0, {}
    for doc, length in enumerate(lengths):
        whole = length // window * window
        for start in range(0, whole, window):
            pieces.append((doc, start, window, sequence, 0))
            sequence += 1
        if length > whole:
            rest.setdefault(length - whole, []).append((doc, whole))
    short = []
    for filling, times in plan(Counter({x: len(v) for x, v in rest.items()}), window):
        full = sum(x * n for x, n in filling.items()) == window
        for _ in range(times):
            offset = 0
            for length, n in filling.items():
                for _ in range(n):
                    doc, start = rest[length].pop()
                    if full:
                        pieces.append((doc, start, length, sequence, offset))
                        offset += length
                    else:
                        short.append((doc, start, length))
            sequence += full
    left = sum(x[2] for x in short)
    rooms = iter([window] * (left // window) + powers(left % window))
    room, offset = next(rooms, 0), 0
    for doc, start, length in short:
        while length:
            if offset == room:
                room, offset, sequence = next(rooms), 0, sequence + 1
            part = min(length, room - offset)
            pieces.append((doc, start, part, sequence, offset))
            start, length, offset = start + part, length - part, offset + part
    return pieces, sequence + bool(short)


def packed(
    docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID
) -> DataFrame:
    """``(id, start, length, ids, doc_tokens, sequence_id, offset)``, one row per piece.

    Each document's ids (NULL text: none) end with ``end_id``; ``ids`` holds the piece's own as
    little-endian unsigned 32-bit numbers. Sequences are made of documents that one task has read
    close together (``BLOCK_TOKENS``), so nothing is shuffled, a task that runs again gives the same
    rows, and a longer table gives more blocks, not larger ones. Repeated rows and ids are packed
    one by one. An empty table gives no row; one empty text gives one piece of one token.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = end_id.to_bytes(4, "little")
        sequence = TaskContext.get().partitionId() << 40
        ids, tokens, size = [], [], 0

        def flush():
            nonlocal sequence, ids, tokens, size
            pieces, n = pack([len(x) // 4 for x in tokens], window)
            for at in range(0, len(pieces), 4096):
                doc, start, length, seq, offset = map(list, zip(*pieces[at : at + 4096], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[d] for d in doc], kind),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array([tokens[d][4 * s : 4 * (s + k)] for d, s, k in zip(doc, start, length, strict=True)], pa.binary()),
                        pa.array([len(tokens[d]) // 4 for d in doc], pa.int64()),
                        pa.array([sequence + s for s in seq], pa.int64()),
                        pa.array(offset, pa.int64()),
                    ],
                    names,
                )
            sequence, ids, tokens, size = sequence + n, [], [], 0

        for batch in batches:
            kind = batch.schema.field(0).type
            for own, texts in slices(batch, ENCODE_CHARS):
                new = [x + end for x in encode_texts(texts, tokenizer)]
                ids += own
                tokens += new
                size += sum(map(len, new)) // 4
                if size >= BLOCK_TOKENS:
                    yield from flush()
        if ids:
            yield from flush()

    names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    pick = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    schema = f"id {pick.schema['id'].dataType.simpleString()}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return pick.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, chars: int) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts (NULL: empty) of a batch, in lists of some ``chars`` characters or of one longer text."""
    ids, texts, size = [], [], 0
    for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        text = text.as_py() or ""
        ids.append(i)
        texts.append(text)
        size += len(text)
        if size >= chars:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts

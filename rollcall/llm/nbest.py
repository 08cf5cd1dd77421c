"""N-best segmentation into the pieces of a SentencePiece model, and back to text."""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.packing import slices

MARK = "▁"  # stands for a space
#: No piece reaches over these cuts: before a word mark, and around a line break.
CUT = re.compile(f"{MARK}[^{MARK}\n]*|[^{MARK}\n]+|\n")
#: As in the library's own lattice: a character without a piece scores this much less than the worst piece.
UNKNOWN = 10.0
#: Pieces scored at or below this are placeholders: one character counts as unknown, longer ones are never used.
UNUSED = -1e8
#: Distinct strings in each of the two generations that a worker remembers; some 200 MB in all.
REMEMBERED = 300_000
#: Where no piece goes on.
STOP: dict = {}
ENCODE_CHARS = 1 << 20
#: Strings of one length that are looked at together, so many at least; longer strings are looked at one by one.
ROWS, FEWEST, LONGEST = 1 << 13, 16, 64


class Pieces:
    """Pieces and scores of a model file, and what was found for strings between cuts."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.text = [b""] * len(ids)
        self.byte = [0] * 256
        self.score: dict[str, float | None] = {}
        self.id: dict[str, int] = {}
        for i in ids:
            piece, score = model.id_to_piece(i), model.get_score(i)
            if model.is_byte(i):
                value = int(piece[3:-1], 16)
                self.text[i], self.byte[value] = bytes([value]), i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.text[i] = piece.replace(MARK, " ").encode()
                if score > UNUSED or len(piece) == 1:
                    if MARK in piece[1:] or "\n" in piece:
                        raise ValueError(f"piece {i} reaches over a cut")
                    self.id[piece], self.score[piece] = i, score
        self.unknown = min(x for x in self.score.values() if x > UNUSED) - UNKNOWN
        self.score = {piece: max(score, self.unknown) for piece, score in self.score.items()}
        #: Letter by letter, the pieces that begin so; under "" the score of the piece that ends there.
        self.tree: dict = {}
        for piece, score in self.score.items():
            node = self.tree
            for letter in piece:
                node = node.setdefault(letter, {})
            node[""] = score
        self._number_tree()
        self.best, self.more = Looked(self), {}

    def _number_tree(self) -> None:
        """The tree as arrays: ``steps`` (node and letter, sorted) lead to ``node``; by node, score and piece."""
        nodes, places = [("", self.tree)], {id(self.tree): 0}
        steps = []
        for prefix, node in nodes:  # grows as it goes
            for letter, below in node.items():
                if letter:
                    places[id(below)] = len(nodes)
                    steps.append((places[id(node)] << 21 | ord(letter), len(nodes)))
                    nodes.append((prefix + letter, below))
        steps.sort()
        self.steps = np.array([k for k, _ in steps] + [-1], np.int64)
        self.node = np.array([v for _, v in steps] + [0], np.int64)
        self.gain = np.array([node.get("", np.nan) for _, node in nodes])
        self.piece = np.array([self.id.get(prefix, -1) for prefix, _ in nodes], np.int64)
        self.flat_text = np.frombuffer(b"".join(self.text), np.uint8)
        self.text_size = np.fromiter(map(len, self.text), np.int64, len(self.text))
        self.text_start = np.cumsum(self.text_size) - self.text_size

    def edges(self, s: str, start: int) -> Iterator[tuple[int, float]]:
        """Ends and scores of the lattice's edges from ``start``."""
        node, alone = self.tree, True
        for end in range(start, len(s)):
            node = node.get(s[end])
            if node is None:
                break
            if "" in node:
                alone = alone and end > start
                yield end + 1, node[""]
        if alone:
            yield start + 1, self.unknown

    def numbers(self, s: str, cuts: list[int]) -> list[int]:
        """Ids of the pieces of ``s`` between ``cuts``."""
        known, out = self.id, []
        for a, b in zip(cuts, cuts[1:], strict=False):
            i = known.get(s[a:b])
            if i is None:
                out += [self.byte[x] for x in s[a:b].encode()]
            else:
                out.append(i)
        return out

    def packed(self, s: str, cuts: list[int]) -> bytes:
        """The same as little-endian unsigned 32-bit numbers."""
        return packed(self.numbers(s, cuts))

    def forward(self, s: str) -> tuple[list[float], list[float], list[int]]:
        """Viterbi scores of the best and second best way to each place, and where the best one's last piece starts."""
        low, n, tree, unknown = float("-inf"), len(s), self.tree, self.unknown
        first, second, back = [low] * (n + 1), [low] * (n + 1), [0] * (n + 1)
        first[0] = 0.0
        for start in range(n):
            one, two, node, end, alone = first[start], second[start], tree, start, True
            while True:
                node = node.get(s[end]) if end < n else None
                if node is None:
                    if not alone:
                        break
                    end, score = start, unknown  # no piece is this one letter: it is an edge all the same
                    node = STOP
                elif "" in node:
                    score = node[""]
                    if end == start:
                        alone = False
                else:
                    end += 1
                    continue
                end += 1
                way = one + score
                if way > first[end]:
                    second[end] = max(first[end], two + score)
                    first[end], back[end] = way, start
                elif way > second[end]:
                    second[end] = way
                if node is STOP:
                    break
        return first, second, back

    def look(self, s: str) -> tuple[float, float, bytes, bytes]:
        """The best score of ``s``, how much less the second best has, the best one's ids and what they stand for."""
        first, second, back = self.forward(s)
        cuts = [len(s)]
        while cuts[-1]:
            cuts.append(back[cuts[-1]])
        ids = self.numbers(s, cuts[::-1])
        return first[-1], first[-1] - second[-1], packed(ids), b"".join(map(self.text.__getitem__, ids))

    def look_many(self, strings: list[str]) -> None:
        """``look`` at many strings, those of one length together: each step of the Viterbi pass is one of arrays."""
        by_size: dict[int, list[str]] = {}
        for s in strings:
            by_size.setdefault(len(s), []).append(s)
        for size, same in by_size.items():
            if size > LONGEST or len(same) < FEWEST:
                for s in same:
                    self.best[s] = self.look(s)
                continue
            for at in range(0, len(same), ROWS):
                part = same[at : at + ROWS]
                self.best.update(zip(part, self._looked(part, size), strict=True))

    def _looked(self, part: list[str], size: int) -> list[tuple[float, float, bytes, bytes]]:
        rows = len(part)
        letters = np.frombuffer("".join(part).encode("utf-32-le"), "<u4").reshape(rows, size).astype(np.int64)
        first, second = np.full((size + 1, rows), -np.inf), np.full((size + 1, rows), -np.inf)
        back, last = np.zeros((size + 1, rows), np.int64), np.zeros((size + 1, rows), np.int64)
        first[0] = 0.0

        def reach(row, start, end, gain, piece):
            way, two = first[start, row] + gain, second[start, row] + gain
            held = first[end, row]
            better = way > held
            second[end, row] = np.where(better, np.maximum(held, two), np.maximum(second[end, row], way))
            won = row[better]
            first[end, won], back[end, won] = way[better], start
            last[end, won] = piece[better]

        for start in range(size):
            row, node, alone = np.arange(rows), np.zeros(rows, np.int64), np.ones(rows, bool)
            for end in range(start, size):
                asked = node << 21 | letters[row, end]
                at = np.searchsorted(self.steps[:-1], asked)
                goes_on = self.steps[at] == asked
                row, node = row[goes_on], self.node[at[goes_on]]
                if not len(row):
                    break
                gain = self.gain[node]
                is_piece = ~np.isnan(gain)
                reach(row[is_piece], start, end + 1, gain[is_piece], self.piece[node[is_piece]])
                if end == start:
                    alone[row[is_piece]] = False
            single = np.flatnonzero(alone)
            reach(single, start, start + 1, np.full(len(single), self.unknown), np.full(len(single), -1))
        # Back along the best ways of all strings at once; the first piece of a string is found last.
        row, place, found = np.arange(rows), np.full(rows, size), []
        while len(row):
            found.append((row, last[place, row]))
            place = back[place, row]
            row, place = row[place > 0], place[place > 0]
        row, piece = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((-np.arange(len(row)), row))
        row, piece = row[order], piece[order]
        strange = np.bincount(row, piece < 0, rows) > 0
        ends = np.cumsum(np.bincount(row, minlength=rows))
        sizes = self.text_size[piece]
        stops = np.cumsum(sizes)
        text = self.flat_text[np.repeat(self.text_start[piece] - (stops - sizes), sizes) + np.arange(stops[-1])].tobytes()
        stops = np.concatenate([[0], stops])[ends].tolist()
        ids, ends = piece.astype("<u4").tobytes(), ends.tolist()
        loss = (first[size] - second[size]).tolist()
        columns = zip(part, strange.tolist(), first[size].tolist(), loss, [0, *ends], ends, [0, *stops], stops, strict=False)
        return [self.look(s) if odd else (score, less, ids[4 * a : 4 * b], text[x:y]) for s, odd, score, less, a, b, x, y in columns]

    def bytes_of(self, ids: bytes) -> bytes:
        return b"".join(map(self.text.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def others(self, s: str, n: int) -> list[tuple[float, bytes]]:
        """Up to ``n`` segmentations of ``s`` beside the best, each with how much less it scores; best first.

        Backward A-star from the end of the lattice: a partial way is worth what it scored so far plus the forward
        Viterbi score of the place it has reached. That is exactly what its best completion scores, so complete ways
        come out best first and nothing else is expanded.
        """
        if (s, n) in self.more:
            return self.more[s, n]
        first, _, _ = self.forward(s)
        into: list[list[tuple[int, float]]] = [[] for _ in range(len(s) + 1)]
        for start in range(len(s)):
            for end, score in self.edges(s, start):
                into[end].append((start, score))
        best, found = self.best[s][2], []
        heap, order = [(-first[-1], 0, 0.0, (len(s),))], 0
        while heap and len(found) < n:
            worth, _, so_far, cuts = heapq.heappop(heap)
            if not cuts[0]:
                ids = self.packed(s, list(cuts))
                if ids != best:
                    found.append((first[-1] + worth, ids))
                continue
            for start, score in into[cuts[0]]:
                order += 1
                heapq.heappush(heap, (-(so_far + score + first[start]), order, so_far + score, (start, *cuts)))
        self.more[s, n] = found
        return found

    def learn(self, texts: list[str], remembered: int = REMEMBERED) -> list[list[str]]:
        """The strings between the cuts of each text; those not remembered are looked at, many at once."""
        if len(self.best) > remembered:
            self.best.forget()
            self.more = {}
        parts = list(map(parts_of, texts))
        new = set(chain.from_iterable(parts)).difference(self.best)
        kept = new.intersection(self.best.before)
        self.best.update((s, self.best.before[s]) for s in kept)
        self.look_many(list(new - kept))
        return parts

    def segmentations(self, parts: list[str], n: int) -> list[tuple[float, bytes, bytes]]:
        """The ``n`` best (score, ids, decoded ids) of a text's strings, best first; ties by the earliest change of the best one.

        The lattice falls apart at the cuts, so a text's segmentation is one for each string between them. The n
        best differ from the best only in the n - 1 strings whose second best loses least: the others are not touched again.
        """
        scores, losses, ids, raws = map(list, zip(*map(self.best.__getitem__, parts), strict=True)) if parts else ([], [], [], [])
        score = sum(scores)
        ways: list[tuple[float, tuple]] = [(0.0, ())]
        for at in least(losses, n - 1):
            others = [(0.0, ()), *((loss, ((at, i),)) for i, (loss, _) in enumerate(self.others(parts[at], n - 1)))]
            ways = sorted((a + b, x + y) for a, x in ways for b, y in others)[:n]
        out, plain = [], b"".join(raws)
        for loss, changes in ways:
            old, same = [(at, ids[at], raws[at]) for at, _ in changes], True
            for at, i in changes:
                ids[at] = self.others(parts[at], n - 1)[i][1]
                raws[at], before = self.bytes_of(ids[at]), raws[at]
                same = same and raws[at] == before
            out.append((score - loss, b"".join(ids), plain if same else b"".join(raws)))
            for at, i, raw in old:
                ids[at], raws[at] = i, raw
        return out

    def decode(self, ids: bytes) -> str:
        """The text of some ids: pieces and bytes put together, the first word mark dropped."""
        return shown(self.bytes_of(ids))


def parts_of(text: str) -> list[str]:
    return CUT.findall(MARK + text.replace(" ", MARK)) if text else []


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def shown(raw: bytes) -> str:
    return raw.removeprefix(b" ").decode(errors="replace")


class Looked(dict):
    """What ``look`` found, by string; of the generation before, what is asked for again is kept."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.before = pieces, {}

    def __missing__(self, s: str) -> tuple[float, float, bytes, bytes]:
        found = self[s] = self.before.get(s) or self.pieces.look(s)
        return found

    def forget(self) -> None:
        self.before = dict(self)
        self.clear()


def least(losses: list[float], n: int) -> list[int]:
    """Places of the ``n`` least finite numbers, the first of equal ones, in order of place."""
    if n <= 0 or not losses:
        return []
    values = np.array(losses)
    if len(values) > n:
        bound = np.partition(values, n - 1)[n - 1]
        under, equal = np.flatnonzero(values < bound), np.flatnonzero(values == bound)
        places = np.sort(np.concatenate([under, equal[: n - len(under)]]))
    else:
        places = np.arange(len(values))
    return [int(i) for i in places if np.isfinite(values[i])]


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def encoded(
    docs: DataFrame, model: str, n: int, id: str = "doc_id", text: str = "text", back: bool = False
) -> DataFrame:
    """``(id, rank, score, ids)``: up to ``n`` segmentations of each row's text, ``ids`` little-endian unsigned 32 bits.

    With ``back``, a further column holds what the ids decode to, in the same pass. NULL and empty texts have one segmentation, without ids. Texts with fewer ways give fewer rows. Repeated rows and ids
    are encoded one by one; other columns are left behind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(model)
        for batch in batches:
            for ids, texts in slices(batch, ENCODE_CHARS):
                cut = known.learn(texts)
                rows = [(i, r + 1, *x) for i, parts in zip(ids, cut, strict=True) for r, x in enumerate(known.segmentations(parts, n))]
                columns = [list(c) for c in zip(*rows, strict=True)]
                columns[4:] = [[shown(raw) for raw in columns[4]]] if back else []
                arrays = [pa.array(c, kind) for c, kind in zip(columns, [batch.schema.field(0).type, *kinds], strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    pick = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    names = ["id", "rank", "score", "ids"] + ["back"] * back
    kinds = [pa.int32(), pa.float64(), pa.binary()] + [pa.string()] * back
    schema = f"id {pick.schema['id'].dataType.simpleString()}, rank int, score double, ids binary"
    return pick.mapInArrow(run, schema + ", back string" * back)


def decoded(rows: DataFrame, model: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``rows`` with ``text`` decoded from ``ids``; NULL stays NULL."""

    @F.pandas_udf("string")
    def run(column):
        known = pieces(model)
        return column.map(lambda x: None if x is None else known.decode(bytes(x)))

    return rows.withColumn(text, run(F.col(ids)))

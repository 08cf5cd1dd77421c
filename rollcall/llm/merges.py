"""Byte-pair merges of a vocabulary file over many short strings at once."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache

import numpy as np

#: Rank of a pair that is never merged.
NEVER = np.int32(2**31 - 1)
#: Strings that are merged together: they and their pairs stay in a core's cache.
ROWS = 1 << 13


def byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself where it can be seen, else one from U+0100 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in seen else chr(next(hidden)) for b in range(256)]


class Merges:
    """Pairs of ids by rank. ``plain`` tells whether the file asks for nothing but merges in the order listed."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        unusual = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        vocabulary, letters = model.get("vocab", {}), byte_letters()
        self.plain = model.get("type") == "BPE" and not spec.get("normalizer") and not any(model.get(x) for x in unusual)
        self.plain = self.plain and all(x in vocabulary for x in letters)
        if not self.plain:
            return
        self.first = np.array([vocabulary[x] for x in letters], np.int64)
        pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        left, right = (np.array([vocabulary[p[i]] for p in pairs], np.int64) for i in (0, 1))
        self.size = len(vocabulary) + 1
        keys = left * self.size + right
        keys, first = np.unique(keys, return_index=True)
        self.keys, self.rank = np.append(keys, -1), np.append(first, NEVER).astype(np.int32)
        self.into = np.array([vocabulary[a + b] for a, b in pairs], np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids."""
        asked = left * self.size + right
        at = np.searchsorted(self.keys[:-1], asked)
        return np.where(self.keys[at] == asked, self.rank[at], NEVER)

    def merged(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(rows, ids)`` of the rows of ``ids`` (strings of one length) when no pair of theirs can be merged any more.

        Each step merges the first of the lowest pairs of every row, so rows that are not done have one length.
        """
        rows = np.arange(len(ids))
        rank = self.ranks(ids[:, :-1], ids[:, 1:])
        while len(rows):
            width = ids.shape[1]
            if width == 1:
                yield rows, ids
                return
            place = rank.argmin(axis=1)
            lowest = rank[np.arange(len(rows)), place]
            done = lowest == NEVER
            if done.any():
                yield rows[done], ids[done]
                rows, ids, rank, place, lowest = (x[~done] for x in (rows, ids, rank, place, lowest))
            n = np.arange(len(rows))
            ids[n, place] = self.into[lowest]
            ids = ids[np.arange(width) != place[:, None] + 1].reshape(len(rows), width - 1)
            rank = rank[np.arange(width - 1) != place[:, None]].reshape(len(rows), width - 2)
            for side in (0, 1):  # the pairs before and behind the new one
                there = n[place > 0] if side == 0 else n[place < width - 2]
                at = place[there] - (side == 0)
                rank[there, at] = self.ranks(ids[there, at], ids[there, at + 1])

    def encode(self, strings: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each string, none of them empty."""
        out = [b""] * len(strings)
        lens = np.fromiter(map(len, strings), np.int64, len(strings))
        order = np.argsort(lens, kind="stable")
        cuts = np.flatnonzero(np.diff(lens[order])) + 1
        for same in np.split(order, cuts) if len(order) else ():
            for at in range(0, len(same), ROWS):
                part = same[at : at + ROWS].tolist()
                raw = np.frombuffer(b"".join(strings[i] for i in part), np.uint8)
                for rows, ids in self.merged(self.first[raw].reshape(len(part), -1)):
                    flat, step = ids.astype("<u4").tobytes(), 4 * ids.shape[1]
                    for i, row in enumerate(rows.tolist()):
                        out[part[row]] = flat[step * i : step * (i + 1)]
        return out


@cache
def merges(path: str) -> Merges:
    return Merges(path)

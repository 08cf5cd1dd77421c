"""Byte-level BPE by pre-tokens: pieces of a text that the library encodes alike, alone or in place."""

from __future__ import annotations

import os
import re
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from rollcall.llm.merges import merges

#: Unicode white space, as the pattern of the vocabulary has it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Latin letters, where a run of letters may be cut off from the marks that follow it.
LETTERS = "A-Za-z\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\xff"
#: The cuts are among those that the vocabulary's own pattern makes before any merge: before a
#: space that a word follows, around white space, and after Latin letters that a common mark ends.
#: Everything else stays in one piece, left to the library's own pattern.
CUT = re.compile(
    rf" ?[{LETTERS}]+(?=[{SPACE}.,!?;:|*%&$#]|\Z)| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
#: Pre-tokens that are one run of Latin letters to any such vocabulary, and short.
PLAIN = re.compile(rf" ?[{LETTERS}]{{1,40}}").fullmatch
#: White space behind a space, in the syntax of Arrow's expressions.
WHOLE = " ([" + re.sub(r"\\u(....)", r"\\x{\1}", SPACE) + "]|$)"


@cache
def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores already
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def _special(path: str) -> re.Pattern | None:
    """The special strings of a vocabulary; by the library's default they are looked for before the text is cut."""
    strings = [x.content for x in _library(path).get_added_tokens_decoder().values()]
    return re.compile(f"({'|'.join(map(re.escape, strings))})") if strings else None


def cut(text: str, path: str) -> list[str]:
    """The pre-tokens of a text, in order; joined they are the text."""
    special = _special(path)
    if not special or not special.search(text):
        return CUT.findall(text)
    parts = special.split(text)
    return [p for i, part in enumerate(parts) for p in ([part] if i % 2 else CUT.findall(part))]


def encode(pieces: list[str], path: str) -> list[list[int]]:
    """Ids of each string as the library gives them, without added special tokens."""
    return [x.ids for x in _library(path).encode_batch_fast(pieces, add_special_tokens=False)]


def _encoded(pieces: list[str], path: str) -> list[bytes]:
    """Ids of distinct pre-tokens: runs of Latin letters by the vocabulary's merges, many at once; all others by the library."""
    table = merges(path)
    letters = [bool(PLAIN(p)) for p in pieces] if table.plain else [False] * len(pieces)
    short = iter(table.encode([p.encode() for p, plain in zip(pieces, letters, strict=True) if plain]))
    rest = iter(encode([p for p, plain in zip(pieces, letters, strict=True) if not plain], path))
    return [next(short) if plain else np.array(next(rest), "<u4").tobytes() for plain in letters]


def _runs(starts: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the runs ``at``, one after the other, and where each run ends among them, from 0 on."""
    own = sizes[at]
    ends = np.cumsum(own, dtype=np.int64)
    places = np.repeat((starts[at] - (ends - own)).astype(np.int32), own)
    places += np.arange(len(places), dtype=np.int32)
    return places, np.concatenate([[0], ends])


def encode_texts(texts: list[str], path: str) -> list[bytes]:
    """Little-endian unsigned 32-bit ids of each text.

    A space that a character other than white space follows begins a pre-token, so a text may be cut there into words.
    Each distinct word of ``texts`` is cut into pre-tokens once, each distinct pre-token encoded once, and runs of ids put
    together by their places. Texts with a special string, or with more white space behind a space, are cut as a whole.
    """
    special = _special(path)
    strings = pa.array(texts, pa.large_string())
    whole = pc.match_substring_regex(strings, WHOLE).to_pylist()
    whole = [w or bool(special and special.search(text)) for w, text in zip(whole, texts, strict=True)]
    plain = pc.split_pattern(strings.filter(pc.invert(pa.array(whole, pa.bool_()))), " ")
    firsts, words = plain.offsets.to_numpy(), plain.flatten().dictionary_encode()
    del strings, plain
    at = words.indices.to_numpy().copy()
    cuts = [CUT.findall(" " + word) for word in words.dictionary.to_pylist()]
    del words
    n_words = len(cuts)  # behind them, the first word of each text, which has no space before it, or the whole text
    cuts += [cut(text, path) if w else CUT.findall(text.split(" ", 1)[0]) for w, text in zip(whole, texts, strict=True)]
    counts = np.cumsum([0, *map(len, cuts)])
    pieces = pa.array(list(chain.from_iterable(cuts)), pa.large_string()).dictionary_encode()
    del cuts  # some hundred bytes a word
    ids = _encoded(pieces.dictionary.to_pylist(), path)
    sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    places, ends = _runs(np.cumsum(sizes) - sizes, sizes, pieces.indices.to_numpy())
    tokens = np.frombuffer(b"".join(ids), "<u4")[places]
    bounds = ends[counts]
    at[firsts[:-1]] = n_words + np.flatnonzero(~np.array(whole, bool))
    places, ends = _runs(bounds[:-1], np.diff(bounds), at)
    flat = tokens[places].tobytes()
    ends = (4 * ends[firsts]).tolist()
    found = iter(zip(ends, ends[1:], strict=False))
    heads = zip(bounds[n_words:].tolist(), bounds[n_words + 1 :].tolist(), strict=False)
    return [tokens[a:b].tobytes() if w else flat[slice(*next(found))] for w, (a, b) in zip(whole, heads, strict=True)]

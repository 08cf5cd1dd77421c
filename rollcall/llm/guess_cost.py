"""Secrets in texts: three fixed patterns, and values in a credential context that are costly to guess."""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log10

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Fixed patterns and the least length of group 2 or of the match, in the order in which kinds are listed.
BASE = {
    "assign": (
        re.compile(
            r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
        ),
        2,
        12,
    ),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 16),
}
#: Names of credentials. The short ones end ordinary words (compass), so they stand at a word's start, a camel-case hump or
#: behind a usual prefix.
NAME = (
    r"""(?:(?:(?<![A-Za-z])|(?-i:(?<=[a-z])(?=[A-Z])))(?:(?:my|db|sql|user|admin|root|ftp|smtp|mail|login)?pass|auth|bearer)"""
    r"""|pass(?:word|wd|phrase|code)|pwd|secret|token|credentials?|(?:api|access|private|auth|client|account)[_-]?key)"""
)
#: Every name holds one of these; a text without them is not searched for contexts.
STEMS = ("pass", "pwd", "secret", "token", "credential", "key", "auth", "bearer")
HEAD = NAME + r"""["']?[\x20\t]*(?:[:=]{1,3}>?|[\x20\t](?:is|was)[\x20\t])[\x20\t]*["']?"""
#: A value that something names as a credential; not consumed, as it may itself name the next one.
CONTEXT = re.compile(HEAD + r"""(?=([^\s"'<>]+))""", re.ASCII | re.IGNORECASE)
#: The same with the value, for Spark: such values do not count as words.
VALUE = "(?i)(?:" + HEAD + r"""[{(\[]*)+[^\s"'<>]+"""
#: Decimal digits of guesses from which on a value is a secret.
COSTLY = 8.0
#: Fixed list, commonest first: words that people put into passwords.
WORDS = (
    "password pass love admin welcome qwerty monkey dragon master hello login princess sunshine shadow football "
    "baseball superman batman michael jordan summer winter spring autumn secret token test example changeme default "
    "root user guest letmein computer internet access system server service account company public private key"
).split()
#: Keyboard rows and the alphabet; a walk follows one of them either way.
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
LEET = str.maketrans("@4301!57$", "aaeoiists")
DATE = re.compile(
    r"(?:19|20)\d\d(?:[-/._]?(?:0?[1-9]|1[0-2])(?:[-/._]?(?:0?[1-9]|[12]\d|3[01]))?)?"
    r"|(?:0?[1-9]|[12]\d|3[01])[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:19|20)?\d\d"
)
RANK = {word: i + 1 for i, word in enumerate(WORDS)}
#: Rows, either way, in which one character follows another; some pairs stand in two.
NEXT: dict[tuple[str, str], list[str]] = {}
for _row in (*ROWS, *(r[::-1] for r in ROWS)):
    for _pair in zip(_row, _row[1:], strict=False):
        NEXT.setdefault(_pair, []).append(_row)
#: Words of the documents that are ranked at most, documents that hold one at least, and their letters.
RANKED, HELD_BY, LETTERS = 30_000, 5, (3, 24)
#: Documents that a task searches at a time.
SLICE = 256
#: Longest unit that counts as a repeat.
UNIT = 8


def brute(value: str) -> float:
    """Cost of one character of ``value`` that nothing explains: digits of the size of the alphabet used."""
    size = (
        10 * any("0" <= c <= "9" for c in value)
        + 26 * any("a" <= c <= "z" for c in value)
        + 26 * any("A" <= c <= "Z" for c in value)
        + 33 * any(not c.isalnum() for c in value)
        + 100 * any(ord(c) > 127 for c in value)
    )
    return log10(max(size, 2))


def word_ranks(docs: DataFrame, text: str = "text", most: int = RANKED, least: int = HELD_BY) -> dict[str, int]:
    """Ranks of ``WORDS`` and of the ``most`` words that most rows of ``docs`` hold, ``least`` rows at least, commonest first.

    Words are runs of a to z in lower case. Values in a credential context are left out, so that a secret in many
    copies is no word. Counted by Spark; the driver and each task hold the bounded result only.
    """
    low = F.lower(F.col(text))
    named = F.greatest(*(F.contains(low, F.lit(stem)) for stem in STEMS))
    plain = F.when(named, F.lower(F.regexp_replace(F.col(text), VALUE, " "))).otherwise(low)
    words = docs.select(F.explode(F.array_distinct(F.split(plain, "[^a-z]+"))).alias("word"))
    words = words.filter(F.length("word").between(*LETTERS)).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    ranks = dict(RANK)
    for i, row in enumerate(words.orderBy(F.desc("n"), "word").limit(most).collect()):
        ranks[row.word] = min(ranks.get(row.word, i + 1), i + 1)
    return ranks


def guess_cost(value: str, ranks: dict[str, int] = RANK, longest: int = LETTERS[1]) -> float:
    """Decimal digits of the guesses that the cheapest segmentation of ``value`` takes; 0 for an empty one.

    Segments are words of ``ranks`` (any case, common substitutions), dates, walks along a keyboard row or the
    alphabet, repeats of up to ``UNIT`` characters, and single characters at brute force. It is the minimum over all
    segmentations: every date, walk and repeat of two or more is tried, but for repeats that end far inside a longer
    run. Those cost more than the run itself: what follows them in the run costs at least what going on does, unless it
    reaches over the run's end, and then it begins close to it. So the time is proportional to the length.
    """
    n, low, one = len(value), value.lower(), brute(value)
    plain = low.translate(LEET)
    if len(low) != n:  # a character whose lower case has more than one
        low = plain = value
    best = [0.0] + [float("inf")] * n
    over = max(longest, *map(len, ROWS), 2 * UNIT, 10)  # what reaches over a run's end begins so close to it
    walk, runs = [1] * (n + 1), {}  # length of the longest walk from here, and of that along each row
    for i in range(n - 2, -1, -1):
        runs = {row: runs.get(row, 1) + 1 for row in NEXT.get((low[i], low[i + 1]), ())}
        walk[i] = max(runs.values(), default=1)
    same = [[0] * (n + 1) for _ in range(UNIT + 1)]  # same[u][i]: characters from i on that equal those u further on
    for u in range(1, UNIT + 1):
        run = same[u]
        for i in range(n - u - 1, -1, -1):
            run[i] = run[i + 1] + 1 if value[i] == value[i + u] else 0

    def reach(end: int, cost: float) -> None:
        if cost < best[end]:
            best[end] = cost

    for i in range(n):
        at = best[i]
        reach(i + 1, at + one)
        for j in range(i + 3, min(n, i + longest) + 1):
            rank = ranks.get(low[i:j]) or ranks.get(plain[i:j])
            if rank:
                case = 0.0 if value[i:j] == low[i:j] else 0.31
                leet = 0.0 if low[i:j] in ranks else 0.6
                reach(j, at + log10(rank + 1) + case + leet)
        if low[i].isdigit():
            for j in range(i + 4, min(n, i + 10) + 1):
                if DATE.fullmatch(low, i, j):
                    reach(j, at + date_cost(j - i))
        for j in range(i + 3, i + walk[i] + 1):
            reach(j, at + walk_cost(j - i))
        for u in range(1, UNIT + 1):
            most = same[u][i] // u + 1
            if most > 1:
                unit = best_unit(value[i : i + u], one, ranks)
                for times in range(max(2, most - over // u - 1), most + 1):
                    reach(i + u * times, at + unit + log10(times))
    return best[n]


def date_cost(length: int) -> float:
    """A year, or a longer date."""
    return 2.1 if length == 4 else 4.6


def walk_cost(length: int) -> float:
    """A row, a direction, a place to begin and a length."""
    return log10(len(ROWS) * 2 * 10 * length)


def best_unit(unit: str, one: float, ranks: dict[str, int] = RANK) -> float:
    """Cost of a repeat's unit: a word, or its characters."""
    rank = ranks.get(unit.lower())
    return min(len(unit) * one, log10(rank + 1) if rank else float("inf"))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of the fixed patterns by start, then kind as listed; code points, end exclusive."""
    found = [
        (start, i, kind, m.end())
        for i, (kind, (pattern, group, least)) in enumerate(BASE.items())
        for m in pattern.finditer(text)
        for start in [m.start()]
        if m.end(group) - m.start(group) >= least
    ]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def covered(start: int, end: int, spans: list[tuple[str, int, int]]) -> bool:
    """Whether ``spans``, sorted by start, hold every character from ``start`` to ``end``."""
    for _, s, e in spans:
        if s <= start < e:
            start = e
    return start >= end


def guess_spans(
    text: str, base: list[tuple[str, int, int]], costly: float = COSTLY, ranks: dict[str, int] = RANK
) -> list[tuple[str, int, int]]:
    """Spans ``guess``: values in a credential context that base spans do not cover whole and that cost ``costly`` or more."""
    found, low = [], text.lower()
    for m in CONTEXT.finditer(text) if any(stem in low for stem in STEMS) else ():
        start, end = m.span(1)
        while end > start and text[end - 1] in ".,;:!?)]}":
            end -= 1
        if not covered(start, end, base) and guess_cost(text[start:end], ranks) >= costly:
            found.append(("guess", start, end))
    return found


def secret_spans(text: str, costly: float = COSTLY, ranks: dict[str, int] = RANK) -> tuple[list, list]:
    """Base spans, and all spans by start, then kind as listed (``guess`` last)."""
    base = base_spans(text)
    order = {kind: i for i, kind in enumerate((*BASE, "guess"))}
    return base, sorted(base + guess_spans(text, base, costly, ranks), key=lambda x: (x[1], order[x[0]]))


def find_secrets(
    docs: DataFrame, id: str = "doc_id", text: str = "text", costly: float = COSTLY, ranks: dict[str, int] | None = None
) -> DataFrame:
    """``(id, base, spans)`` per row: arrays of (kind, start, end); empty for NULL, empty and clean texts.

    Words are priced by ``ranks``, a bounded table; without it they are counted in ``docs`` (``word_ranks``). Given the
    same ranks, a text has the same spans in any table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                both = [secret_spans(x.as_py() or "", costly, ranks) for x in part.column(1)]
                columns = [pa.array([[dict(zip(names, s, strict=True)) for s in b[i]] for b in both], kind) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["id", "base", "spans"])

    ranks = word_ranks(docs, text) if ranks is None else ranks
    names = ("kind", "start", "end")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    pick = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    spans = "array<struct<kind string, start long, end long>>".replace(" string", ": string").replace(" long", ": long")
    return pick.mapInArrow(run, f"id {pick.schema['id'].dataType.simpleString()}, base {spans}, spans {spans}")


def redact(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    size: str | None = "n_chars",
    mark: str = "[SECRET]",
    ranks: dict[str, int] | None = None,
) -> DataFrame:
    """``docs`` with every secret's span replaced by ``mark`` and ``size`` (code points) set anew where a text changed.

    All rows stay. Overlapping spans become one mark. ``ranks`` are as for ``find_secrets``. A row's own text is searched, so
    repeated ids and rows without one are fine.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                columns = {c: part.column(c) for c in part.schema.names}
                old = columns[text].to_pylist()
                new = [masked(x, mark, ranks) for x in old]
                columns[text] = pa.array(new, columns[text].type)
                if size in columns:
                    sizes = zip(columns[size].to_pylist(), old, new, strict=True)
                    columns[size] = pa.array([n if a == b else len(b) for n, a, b in sizes], columns[size].type)
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    ranks = word_ranks(docs, text) if ranks is None else ranks
    return docs.mapInArrow(run, docs.schema)


def masked(text: str | None, mark: str, ranks: dict[str, int] = RANK) -> str | None:
    """``text`` with its secrets replaced."""
    if not text:
        return text
    out, at = [], 0
    for _, start, end in secret_spans(text, ranks=ranks)[1]:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])

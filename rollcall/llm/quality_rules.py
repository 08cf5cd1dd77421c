"""Quality rules: a table of thresholds, compiled into built-in column expressions over each document."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = "\\x20\\x09-\\x0D"
#: Fixed list: frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the be to of and that have with is in a for as on it was "
    "der die und den das ein ist zu mit auf von "
    "le la de et les des un une est en du que pour dans "
    "el los las y del por se su con no lo"
).split()


class Rule(NamedTuple):
    """A measure must lie within ``low`` and ``high`` (NULL: no bound) in documents of ``from_words`` words or more."""

    name: str
    measure: str
    low: float | None
    high: float | None
    from_words: int = 10


#: The measures are SQL over the columns that ``counts`` makes.
RULES = (
    Rule("length", "n_words", 10, 1_000_000),
    Rule("word_length", "word_chars / n_words", 2, 16),
    Rule("symbols", "n_symbols / n_words", None, 0.1),
    Rule("stop_words", "n_stop_words / n_words", 0.02, None, 50),
    Rule("stop_word_found", "n_stop_words", 1, None, 30),
    Rule("bullets", "n_bullet_lines / n_lines", None, 0.9),
    Rule("ellipses", "n_ellipsis_lines / n_lines", None, 0.3),
    Rule("dup_lines", "n_dup_lines / n_lines", None, 0.5),
)
#: The base verdict, whatever the table says.
BASE_FAILED = "n_words < 10 OR 100 * n_repeat_words > 20 * n_words"
WINDOW = 5


def counts(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``(id, n_words, word_chars, n_symbols, n_lines, ..)``: everything the rules measure, row by row, without a shuffle."""
    words = F.filter(F.split("text", f"[{BLANK}]+"), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(f"[^{BLANK}]"))
    parts = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).select(
        "id",
        words.alias("words"),
        lines.alias("lines"),
        F.length(F.regexp_replace("text", f"[{BLANK}]+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
    )
    return parts.select(
        "id",
        F.size("words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("lines", lambda x: x.rlike(f"^[{BLANK}]*[-*•]"))).alias("n_bullet_lines"),
        F.size(F.filter("lines", lambda x: x.rlike(f"(\\.\\.\\.|…)[{BLANK}]*$"))).alias("n_ellipsis_lines"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS))).alias("n_stop_words"),
        *_windows(),
    ).select("*", _repeated().alias("n_repeat_words")).drop("words", "hashes")


def _windows() -> tuple[Column, Column]:
    """The words, and a hash of each window of them; equal hashes only mark a document for the exact count."""
    hashed = ", ".join(f"get(words, i + {k})" for k in range(WINDOW))
    return (
        F.col("words"),
        F.expr(
            f"IF(size(words) < {WINDOW}, CAST(array() AS ARRAY<LONG>), "
            f"transform(sequence(0, size(words) - {WINDOW}), i -> xxhash64({hashed})))"
        ).alias("hashes"),
    )


def _repeated() -> Column:
    """Words in windows found twice or more: equal windows stand side by side once sorted by their text."""
    windows = (
        f"array_sort(transform(sequence(1, size(hashes)), i -> struct(array_join(slice(words, i, {WINDOW}), ' ') AS t, i AS i)))"
    )
    places = (
        f"transform(array({windows}), w -> array_sort(transform("
        f"filter(sequence(0, size(w) - 1), j -> coalesce(w[j].t = get(w, j - 1).t, false) OR coalesce(w[j].t = get(w, j + 1).t, false)),"
        f" j -> w[j].i)))[0]"
    )
    covered = (
        f"aggregate({places}, struct(0L AS n, {-WINDOW} AS last),"
        f" (s, i) -> struct(s.n + least({WINDOW}, i - s.last) AS n, i AS last), s -> s.n)"
    )
    return F.expr(f"IF(size(hashes) = size(array_distinct(hashes)), 0L, {covered})")


def compiled(rules: tuple[Rule, ...] = RULES) -> Column:
    """The names of the rules that a row of ``counts`` breaks, in the table's order."""
    broken = []
    for rule in rules:
        out = [f"{rule.measure} < {rule.low}"] * (rule.low is not None) + [f"{rule.measure} > {rule.high}"] * (rule.high is not None)
        broken.append(f"CASE WHEN n_words >= {rule.from_words} AND ({' OR '.join(out)}) THEN '{rule.name}' END")
    return F.expr(f"array_compact(array({', '.join(broken)}))" if broken else "CAST(array() AS ARRAY<STRING>)")


def judged(docs: DataFrame, id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(id, counts .., base_failed, failed, kept)`` of every row; NULL, empty and blank texts have no word and fail.

    Repeated rows and ids are judged one by one, NULL ids too; other columns of ``docs`` are left behind.
    """
    found = counts(docs, id, text).withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("failed", compiled(rules))
    return found.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))

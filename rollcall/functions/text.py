"""Text functions on columns. All of them are built-in expressions."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F


# Every character str.isdigit and str.isspace accept, found by asking for each code point.
DIGITS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isdigit())
SPACES = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())


def head_before(text: Column, marker: str) -> Column:
    """Text in front of the first ``marker``; all of it when there is none."""
    return F.substring_index(text, marker, 1)


def drop_digits(text: Column) -> Column:
    """Remove every digit, wherever it stands."""
    return F.translate(text, DIGITS, "")


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends."""
    return F.btrim(text, F.lit(SPACES))


def clean_cell(cell: Column, marker: str = "Form:") -> Column:
    """Table cell -> bare name: cut the marker's tail, drop digits, strip."""
    return strip(drop_digits(head_before(cell.cast("string"), marker)))


def usable_name(name: Column, longer_than: int = 2, stop: tuple[str, ...] = ("Team", "nan")) -> Column:
    """Keep names of enough characters that are no stop word (case matters). NULL is not kept."""
    return (F.length(name) > longer_than) & ~name.isin(*stop)


def normalise(name: Column) -> Column:
    """Everything but letters, numbers and ``_`` to one space; trimmed, lower case."""
    return F.lower(F.trim(F.regexp_replace(name, r"[^\p{L}\p{N}_]+", " ")))


def token_key(name: Column) -> Column:
    """Normalised tokens in code-point order: the text the similarity compares."""
    return F.array_join(F.sort_array(F.split(normalise(name), " ")), " ")


def snapshot_stamp(ts: Column) -> Column:
    """Time stamp as ``ddMMyyyy_HHmm``."""
    return F.date_format(ts, "ddMMyyyy_HHmm")

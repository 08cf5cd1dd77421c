"""Resolve raw names to canonical names: exact alias, else best fuzzy match, else UNKNOWN."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.text import token_key
from rollcall.operators.answers import kept_match
from rollcall.operators.dictionary import BROADCAST_BYTES, DictionarySize, dictionary_size, flatten_aliases
from rollcall.operators.fuzzy import GATE, best_match, gate, score
from rollcall.operators.skew import HOT_ROWS, join_lookup

# Columns that resolving adds on the way or in the end.
RESERVED = {"standard_name", "match_confidence", "alias", "score", "key", "n", "hot", "fan", "best", "sim", "_times", "_run", "_copy"}


def match_exact(
    rows: DataFrame,
    dictionary: DataFrame,
    name: str = "name",
    size: DictionarySize | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``rows`` plus ``standard_name`` and ``score`` 100 where the name is an alias; NULL elsewhere.

    Case and spaces count. Aliases are broadcast when their measured size allows.
    Beyond that each distinct name is looked up once, and the answer joined back
    with the rows of a hot name spread over many tasks.
    """
    rows = rows.filter(F.col(name).isNotNull())
    aliases = flatten_aliases(dictionary)
    size = size or dictionary_size(dictionary)
    kept = [F.col(f"`{c}`") for c in rows.columns]
    if size.aliases_fit(broadcast_bytes):
        tagged = rows.join(F.broadcast(aliases), F.col(name) == F.col("alias"), "left")
    else:
        names = rows.groupBy(F.col(name)).agg(F.count(F.lit(1)).alias("n"))
        lookup = names.drop("n").join(aliases, F.col(name) == F.col("alias"), "left")
        tagged = join_lookup(rows, lookup, names, name, hot_rows)
    hit = F.when(F.col("alias").isNotNull(), F.lit(100)).cast("long")
    return tagged.select(*kept, "standard_name", hit.alias("score"))


def nameless(rows: DataFrame, name: str = "name") -> DataFrame:
    """Rows without a name, with the ``reason``; resolving goes on without them."""
    return rows.filter(F.col(name).isNull()).withColumn("reason", F.lit("no name"))


def missed_keys(missed: DataFrame, name: str = "name") -> DataFrame:
    """``(key, n)``: distinct comparison keys of names without an alias, with their row counts."""
    return missed.groupBy(token_key(F.col(name)).alias("key")).agg(F.count(F.lit(1)).alias("n"))


def resolve(
    rows: DataFrame,
    dictionary: DataFrame,
    name: str = "name",
    above: int = GATE,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
    answers: str | None = None,
    **match,
) -> DataFrame:
    """``rows`` plus ``standard_name`` and ``match_confidence``; other columns are kept.

    With ``answers``, a folder, best matches are kept there between runs, and only what is new is compared (``kept_match``).

    Hits leave after the alias join. Only misses are shuffled: once to distinct
    keys, which are compared, and once to bring the answers back. ``rows`` is read
    for each branch, so pass a stored layer rather than a long computation.
    """
    taken = RESERVED & set(rows.columns)
    if taken:
        raise ValueError(f"rename these columns first: {sorted(taken)}")
    size = dictionary_size(dictionary)
    tagged = match_exact(rows, dictionary, name, size, broadcast_bytes, hot_rows)
    kept = [F.col(f"`{c}`") for c in rows.columns]
    hits = tagged.filter(F.col("score").isNotNull()).select(
        *kept, "standard_name", F.col("score").alias("match_confidence")
    )
    missed = tagged.filter(F.col("score").isNull()).select(*kept)
    keys = missed_keys(missed, name)
    if answers is None:
        found = best_match(keys, dictionary, size, **match)
    else:
        found = kept_match(keys, dictionary, answers, **match)
    confidence = score(F.col("sim"))
    answers = found.select(
        "key", gate(F.col("best"), confidence, above).alias("standard_name"), confidence.alias("match_confidence")
    )
    keyed = missed.withColumn("key", token_key(F.col(name)))
    back = join_lookup(keyed, answers, keys, "key", hot_rows)
    return hits.unionByName(back.drop("key"))


def master(
    resolved: DataFrame, name: str = "name", group: str = "league", keep: tuple[str, ...] = ()
) -> DataFrame:
    """The four columns of the master table, and those in ``keep``."""
    return resolved.select(
        F.col(name).alias("raw_name"), "standard_name", F.col(group).alias("league"), "match_confidence", *keep
    )


def review(
    resolved: DataFrame, name: str = "name", group: str = "league", below: int = 100, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Rows to look at by hand: every score under 100, the UNKNOWN ones included."""
    return resolved.filter(F.col("match_confidence") < below).select(
        F.col(name).alias("raw_input"),
        F.col("standard_name").alias("guessed_name"),
        F.col("match_confidence").alias("confidence_score"),
        F.col(group).alias("league"),
        *keep,
    )

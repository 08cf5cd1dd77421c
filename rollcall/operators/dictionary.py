"""The dictionary of canonical names: ``(ord, standard_name, aliases)``."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.text import token_key


BROADCAST_BYTES = 32 << 20
ROW_BYTES = 32  # what a broadcast row costs beside its texts


class DictionarySize(NamedTuple):
    """Counted by one aggregate over the dictionary; upper bounds for what is derived from it."""

    names: int
    name_bytes: int
    aliases: int
    alias_bytes: int  # each alias with its canonical name

    def aliases_fit(self, limit: int = BROADCAST_BYTES) -> bool:
        return self.alias_bytes + ROW_BYTES * self.aliases <= limit


def dictionary_size(dictionary: DataFrame) -> DictionarySize:
    name = F.octet_length("standard_name").cast("long")
    listed = F.size(F.coalesce("aliases", F.array().cast("array<string>"))).cast("long")
    texts = F.coalesce(F.octet_length(F.array_join("aliases", "")), F.lit(0))
    counted = dictionary.agg(
        F.count("standard_name"),
        F.coalesce(F.sum(name), F.lit(0)),
        F.coalesce(F.sum(listed), F.lit(0)),
        F.coalesce(F.sum(texts + listed * F.coalesce(name, F.lit(0))), F.lit(0)),
    )
    return DictionarySize(*counted.first())


def flatten_aliases(dictionary: DataFrame) -> DataFrame:
    """``(alias, standard_name)``, one row per alias; the last entry that names an alias owns it."""
    listed = dictionary.select("ord", "standard_name", F.posexplode("aliases").alias("pos", "alias"))
    return (
        listed.filter(F.col("alias").isNotNull() & F.col("standard_name").isNotNull())
        .groupBy("alias")
        .agg(F.max_by("standard_name", F.struct("ord", "pos")).alias("standard_name"))
    )


def unnamed(dictionary: DataFrame) -> DataFrame:
    """Entries without a canonical name, with the ``reason``; neither they nor their aliases match anything."""
    return dictionary.filter(F.col("standard_name").isNull()).withColumn("reason", F.lit("no canonical name"))


def candidate_keys(dictionary: DataFrame) -> DataFrame:
    """``(cand_key, ord, standard_name)``: canonical names by the text they are compared as.

    Names that compare alike score alike, so only the earliest of them can win.
    """
    named = dictionary.filter(F.col("standard_name").isNotNull())
    named = named.select("ord", "standard_name", token_key(F.col("standard_name")).alias("cand_key"))
    first = F.min(F.struct("ord", "standard_name")).alias("first")
    return named.groupBy("cand_key").agg(first).select("cand_key", "first.ord", "first.standard_name")

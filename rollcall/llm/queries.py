"""Registered queries of this subpackage, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import (
    bradley_terry,
    collocations,
    guess_cost,
    mixing,
    nbest,
    packing,
    paragraph_minhash,
    quality_rules,
    simhash,
    spelling,
    stream_dedup,
    token_counts,
    url_markov,
)

#: The public vocabularies that the queries name.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
#: Segmentations of each document.
N_BEST = 4
#: Words of a line that counts as a paragraph; shorter ones (headings, list items, notices) are no copied text by themselves.
LINE_WORDS = 20
#: Shingle length and greatest bit distance of near copies.
SHINGLE, BITS = 3, 2
#: Tokens beyond which a document is marked.
TOKEN_LIMIT = 512
#: What is known of hosts; the longest rule that fits a URL decides.
URL_RULES = [
    url_markov.Rule("com", "/", "allow"),
    url_markov.Rule("example.com", "/en/", "block"),
    url_markov.Rule("www.example.com", "/en/", "allow"),
    url_markov.Rule("net", "/es/", "block"),
    url_markov.Rule("net", "/fr/", "block"),
]
#: Labels are learnt where the remainder is not 0; the rest is held out.
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def held_out(id: str = "doc_id"):
    return F.crc32(F.col(id).cast("string")) % FOLDS == 0


def quality_model(spark: SparkSession, sf_dir: str) -> bradley_terry.Model:
    labels = table(spark, sf_dir, "labels").filter(~held_out()).withColumnRenamed("quality", "label")
    return bradley_terry.train(documents(spark, sf_dir), labels)


def op1_simhash(spark, sf_dir):
    found = simhash.near_duplicates(documents(spark, sf_dir), shingle=SHINGLE, max_distance=BITS)
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op2_nbest_pieces(spark, sf_dir):
    """Each segmentation's score, and checksums of its ids and of the text that they decode to."""
    found = nbest.encoded(documents(spark, sf_dir), PIECE_BPE, N_BEST, back=True)
    return found.select(
        F.col("id").alias("doc_id"),
        "rank",
        "score",
        (F.octet_length("ids") / 4).cast("long").alias("n_pieces"),
        F.crc32("ids").alias("ids_crc32"),
        F.crc32(F.encode("back", "UTF-8")).alias("text_crc32"),
    )


def op3_quality_bradley_terry(spark, sf_dir):
    found = bradley_terry.scored(documents(spark, sf_dir), quality_model(spark, sf_dir)).withColumnRenamed("id", "doc_id")
    return found.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= bradley_terry.GOOD).cast("int").alias("predicted"),
    )


def op4_exact_dedup(spark, sf_dir):
    found = stream_dedup.exact_duplicates(documents(spark, sf_dir))
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


OP4_SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM t JOIN g USING (norm)
"""


def op5_paragraph_minhash(spark, sf_dir):
    """Lines (``para``), and passages wherever they stand in a text (words ``start`` to ``end``); the other columns are NULL."""
    found = paragraph_minhash.repeated(documents(spark, sf_dir), least=LINE_WORDS, within=False)
    return found.withColumnsRenamed({"id": "doc_id", "keep_id": "keep_doc_id"})


def op6_token_counts(spark, sf_dir):
    found = token_counts.token_counts(documents(spark, sf_dir), BYTE_BPE)
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op7_quality_rules(spark, sf_dir):
    found = quality_rules.judged(documents(spark, sf_dir))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        F.array_join("failed", ",").alias("failed"),
    )


def _rules_sql() -> str:
    """The threshold table as DuckDB SQL: the names of broken rules, joined."""
    broken = []
    for name, measure, low, high, words in quality_rules.RULES:
        out = [f"{measure} < {low}"] * (low is not None) + [f"{measure} > {high}"] * (high is not None)
        broken.append(f"CASE WHEN n_words >= {words} AND ({' OR '.join(out)}) THEN '{name}' END")
    return f"array_to_string(list_filter([{', '.join(broken)}], lambda x: x IS NOT NULL), ',')"


OP7_SQL = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
p AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4] AS g
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM p)),
d AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM d, range(5) AS x(k) GROUP BY doc_id),
c AS (SELECT p.doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(l) AS n_lines,
    len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
    len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullet_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis_lines,
    len(list_filter(w, lambda x: lower(x) IN ({", ".join(f"'{x}'" for x in sorted(set(quality_rules.STOP_WORDS)))}))) AS n_stop_words
    FROM p LEFT JOIN r USING (doc_id)),
v AS (SELECT *, {quality_rules.BASE_FAILED} AS base_failed, {_rules_sql()} AS failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND failed = '' AS kept, failed FROM v
"""


def op8_slack_packing(spark, sf_dir):
    return piece_digests(packing.packed(documents(spark, sf_dir), BYTE_BPE))


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The packed pieces with a checksum in place of their ids."""
    return pieces.select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op9_url_markov(spark, sf_dir):
    found = url_markov.judged(table(spark, sf_dir, "pages"), URL_RULES)
    return found.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "ratio")


def op10_secret_guess_cost(spark, sf_dir):
    found = guess_cost.find_secrets(documents(spark, sf_dir))
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        F.col("id").alias("doc_id"),
        *(count(kind) for kind in guess_cost.BASE),
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )


def op11_spelling_variants(spark, sf_dir):
    return spelling.variants(spelling.count_words(documents(spark, sf_dir)))


def op12_cube_mixing(spark, sf_dir):
    return mixing.mixed(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op13_collocations(spark, sf_dir):
    return collocations.collocations(documents(spark, sf_dir)).withColumnRenamed("group", "lang")


OP13_SQL = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
i AS (SELECT lang, id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w),
h AS (SELECT lang, x, lead(x) OVER q AS y, lead(x, 2) OVER q AS z FROM i WINDOW q AS (PARTITION BY id ORDER BY i)),
g AS (SELECT lang, 1 AS k, x AS phrase FROM h
    UNION ALL SELECT lang, 2, x || ' ' || y FROM h WHERE y IS NOT NULL
    UNION ALL SELECT lang, 3, x || ' ' || y || ' ' || z FROM h WHERE z IS NOT NULL),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 10),
x AS (SELECT lang, k, phrase, a, w, unnest(range(1, k)) AS cut FROM c),
y AS MATERIALIZED (SELECT lang, phrase, a, cut, lang || ' ' || array_to_string(w[1:cut], ' ') AS lp, lang || ' ' || array_to_string(w[cut+1:], ' ') AS rp FROM x),
e AS MATERIALIZED (SELECT lang || ' ' || phrase AS part, a FROM f WHERE a >= 10),
s AS (SELECT y.*, l.a AS l, r.a AS r, ((1000000::HUGEINT * y.a * y.a) // (l.a::HUGEINT * r.a))::BIGINT AS score
    FROM y JOIN e AS l ON l.part = lp JOIN e AS r ON r.part = rp),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
d AS (SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, w[1] || ' ' || w[2] AS phrase FROM c WHERE k = 3 UNION ALL SELECT lang, a, w[2] || ' ' || w[3] FROM c WHERE k = 3) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM m LEFT JOIN d USING (lang, phrase) JOIN n USING (lang) WHERE longer IS NULL OR 100 * longer < 50 * a
QUALIFY rank <= 2000
"""


LLM_QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_nbest_pieces": op2_nbest_pieces,
    "op3_quality_bradley_terry": op3_quality_bradley_terry,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_paragraph_minhash": op5_paragraph_minhash,
    "op6_token_counts": op6_token_counts,
    "op7_quality_rules": op7_quality_rules,
    "op8_slack_packing": op8_slack_packing,
    "op9_url_markov": op9_url_markov,
    "op10_secret_guess_cost": op10_secret_guess_cost,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_cube_mixing": op12_cube_mixing,
    "op13_collocations": op13_collocations,
}
LLM_ORACLE = {"op4_exact_dedup": OP4_SQL, "op7_quality_rules": OP7_SQL, "op13_collocations": OP13_SQL}

"""DuckDB SQL for the registered queries, written against the given tables only."""

from __future__ import annotations

from workload import CUSTOMER_TEXT, HARD, NOISE, SLUGS

# ---- derived inputs -------------------------------------------------------

FEED = f"feed AS (SELECT p_type AS league, p_partkey AS ord, {NOISE} AS cell FROM part)"
CLUB = """club AS (
  SELECT min(p_partkey) AS ord, p_name || ' co' AS standard_name,
    CASE WHEN p_name LIKE '%gizmo' THEN []::VARCHAR[] ELSE [p_name, upper(p_name), p_name] END AS aliases
  FROM part GROUP BY p_name)"""


def clean(cell: str) -> str:
    bare = rf"regexp_replace(split_part({cell}, 'Form:', 1), '\p{{Nd}}', '', 'g')"
    return rf"regexp_replace({bare}, '^[\x{{00A0}}\s]+|[\x{{00A0}}\s]+$', '', 'g')"


def norm(name: str) -> str:
    return rf"lower(trim(regexp_replace({name}, '[^\p{{L}}\p{{N}}_]+', ' ', 'g')))"


def key(name: str) -> str:
    return f"array_to_string(list_sort(string_split({norm(name)}, ' ')), ' ')"


def sim(a: str, b: str) -> str:
    """Textbook row-by-row LCS, then the unrounded similarity."""
    row = (
        f"list_reduce(list_transform(range(1, length({b}) + 1), lambda j: [j]), lambda built, j: "
        f"list_append(built, CASE WHEN substr({b}, j[1], 1) = ca[2] THEN prev[j[1]] + 1 "
        f"ELSE greatest(prev[j[1] + 1], built[-1]) END), [0::BIGINT])"
    )
    row = row.replace("ca[2]", "chr(ca[1]::INT)")
    lcs = (
        f"list_reduce(list_transform(string_split({a}, ''), lambda c: [ord(c)::BIGINT]), lambda prev, ca: {row}, "
        f"list_resize([]::BIGINT[], length({b}) + 1, 0))[-1]"
    )
    total = f"(length({a}) + length({b}))"
    return f"CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0.0::DOUBLE ELSE 200.0::DOUBLE * {lcs} / {total} END"


def rounded(value: str) -> str:
    return f"CAST(round_even({value}, 0) AS BIGINT)"


CLEANED = f"""cleaned AS (
  SELECT * FROM (SELECT league, ord, {clean('cell')} AS name FROM feed)
  WHERE length(name) > 2 AND name NOT IN ('Team', 'nan'))"""
DEDUPED = "deduped AS (SELECT league, name, min(ord) AS first_ord FROM cleaned GROUP BY ALL)"
ALIAS = """alias AS (
  SELECT alias, arg_max(standard_name, (ord, pos)) AS standard_name
  FROM (SELECT ord, standard_name, unnest(aliases) AS alias, generate_subscripts(aliases, 1) AS pos FROM club)
  GROUP BY alias)"""
MISS = "miss AS (SELECT DISTINCT name FROM deduped WHERE name NOT IN (SELECT alias FROM alias))"
SCORED = f"""scored AS (
  SELECT name, ord, standard_name, {sim('a', 'b')} AS sim
  FROM (SELECT name, {key('name')} AS a FROM miss)
  CROSS JOIN (SELECT ord, standard_name, {key('standard_name')} AS b FROM club))"""
BEST = f"""best AS (
  SELECT name, first(standard_name ORDER BY sim DESC, ord) AS best, {rounded('max(sim)')} AS score
  FROM scored GROUP BY name)"""
GATED = "gated AS (SELECT name, CASE WHEN score > 80 THEN best ELSE 'UNKNOWN' END AS standard_name, score FROM best)"
SILVER = """silver AS (
  SELECT d.name AS raw_name, coalesce(a.standard_name, g.standard_name) AS standard_name, d.league,
    CASE WHEN a.alias IS NOT NULL THEN 100 ELSE g.score END::BIGINT AS match_confidence, d.first_ord
  FROM deduped d LEFT JOIN alias a ON d.name = a.alias LEFT JOIN gated g ON d.name = g.name)"""
REVIEW = """review AS (
  SELECT raw_name AS raw_input, standard_name AS guessed_name, match_confidence AS confidence_score, league
  FROM silver WHERE match_confidence < 100)"""
GOLD = """gold AS (
  SELECT standard_name AS "ClubName", league AS "League", 2025::INT AS "Season Year",
    row_number() OVER (PARTITION BY league ORDER BY first_ord) AS "Positions"
  FROM silver)"""
NAMES = [FEED, CLEANED, DEDUPED]
ALIASED = [*NAMES, CLUB, ALIAS]
MATCHED = [*ALIASED, MISS, SCORED, BEST, GATED]
RESOLVED = [*MATCHED, SILVER]

# Cells of the generated pages, told from the parts they were made of.
DOCS = f"""docs AS (
  SELECT p_type AS league, p_partkey // 300 AS doc, p_partkey % 1000 AS pos, coalesce(cell, '') AS cell,
    row_number() OVER (PARTITION BY p_type, p_partkey // 300 ORDER BY p_partkey) AS ro
  FROM (SELECT *, {NOISE} AS cell FROM part))"""
CELLS = r"""cells AS (
  SELECT league, doc, ro, unnest(row) AS cell, unnest(range(len(row))) AS co
  FROM (SELECT league, doc, ro, CASE doc % 3 WHEN 0 THEN [cell, pos::VARCHAR]
      WHEN 1 THEN [pos::VARCHAR, cell, 'WDL'] ELSE [pos::VARCHAR, cell] END AS row
    FROM (SELECT * REPLACE (regexp_replace(cell, '^[\x{00A0}\s]+|[\x{00A0}\s]+$', '', 'g') AS cell) FROM docs)))"""


def ctes(parts: list[str], body: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + body


def page_cells() -> str:
    pages = "html"
    for old, new in (("<ul>", "<table>"), ("</ul>", "</table>"), ("<li>", "<tr><td>"), ("</li>", "</td></tr>")):
        pages = f"replace({pages}, '{old}', '{new}')"

    def each(source: str, keep: str, index: str, out: str, pattern: str, text: str) -> str:
        found = f"regexp_extract_all({text}, '{pattern}', 1)"
        return (
            f"SELECT {keep}, unnest({found}) AS {out}, generate_subscripts({found}, 1) - 1 AS {index} FROM ({source})"
        )

    tables = each(f"SELECT page_id, {pages} AS h FROM pages", "page_id", "table_idx", "t", "(?is)<table[^>]*>(.*?)</table>", "h")
    rows = each(tables, "page_id, table_idx", "ro", "r", "(?is)<tr[^>]*>(.*?)</tr>", "t")
    cells = each(rows, "page_id, table_idx, ro", "co", "c", "(?is)<t[hd][^>]*>(.*?)</t[hd]>", "r")
    return f"SELECT page_id, table_idx, ro, co, trim(regexp_replace(c, '<[^>]+>', '', 'g')) AS cell FROM ({cells})"


def bit_matches(raw: str, cand: str) -> str:
    """Best match of ``raw`` (id, name) among ``cand`` (ord, standard_name).

    Too many pairs for the textbook rows: the LCS is counted in the bits of a HUGEINT.
    """
    return f"""
        WITH raw AS (SELECT id, name, string_split({key('name')}, '') AS letters FROM ({raw})),
        cand AS (SELECT ord, standard_name, string_split({key('standard_name')}, '') AS letters FROM ({cand})),
        places AS (SELECT ord, letter, sum(1::HUGEINT << (pos - 1)::HUGEINT)::HUGEINT AS bits FROM (
          SELECT ord, unnest(letters) AS letter, generate_subscripts(letters, 1) AS pos FROM cand) GROUP BY ALL),
        masks AS (SELECT ord, map(list(letter), list(bits)) AS m FROM places GROUP BY ord),
        scored AS (
          SELECT id, name, ord, standard_name, len(r.letters) + len(c.letters) AS total,
            (1::HUGEINT << len(c.letters)::HUGEINT) - 1 AS every,
            list_reduce(list_transform(r.letters, lambda l: coalesce(m[l], 0::HUGEINT)),
              lambda v, k: ((v + (v & k)) | (v - (v & k))) & every, every) AS left_over
          FROM raw r CROSS JOIN cand c JOIN masks USING (ord)),
        best AS (
          SELECT id, name, first(standard_name ORDER BY sim DESC, ord) AS best, {rounded('max(sim)')} AS score
          FROM (SELECT *, 200.0::DOUBLE * bit_count(every & ~left_over) / total AS sim FROM scored) GROUP BY ALL)
        SELECT id AS c_custkey, name, CASE WHEN score > 80 THEN best ELSE 'UNKNOWN' END AS standard_name,
          score AS match_confidence
        FROM best"""


def hard_cells() -> str:
    cases = " ".join(
        f"WHEN {i} THEN " + " || n || ".join("'" + x.replace("'", "''") + "'" for x in text.split("{}"))
        for i, (_, text) in enumerate(HARD)
    )
    return f"""
        SELECT p_partkey // 50 AS doc, row_number() OVER (PARTITION BY p_partkey // 50 ORDER BY p_partkey) - 1 AS ro,
          (CASE p_partkey % {len(HARD)} {cases} END) || '|' || p_partkey AS cells
        FROM (SELECT p_partkey, trim(regexp_replace(p_name, '[^a-z ]', '', 'g')) AS n FROM part)"""


ORACLE = {
    "json_feed_explode": ctes(
        [FEED, CLEANED],
        """SELECT doc, dense_rank() OVER (PARTITION BY doc ORDER BY league) - 1 AS league_ord, league,
             row_number() OVER (PARTITION BY doc, league ORDER BY ord) - 1 AS name_ord, name
           FROM (SELECT *, ord // 100 AS doc FROM cleaned)""",
    ),
    "clean_names": ctes([FEED, CLEANED], "SELECT league, ord, name FROM cleaned"),
    "dedup_ordered": ctes(NAMES, "SELECT league, name, first_ord FROM deduped"),
    "first_k_names": ctes(
        NAMES,
        """SELECT league, name, first_ord, row_number() OVER (PARTITION BY league ORDER BY first_ord) AS rn
           FROM deduped QUALIFY rn <= 20""",
    ),
    "names_to_json": ctes(
        [f"feed AS (SELECT CASE WHEN cell = 'Team' THEN 'BLANK' ELSE p_type END AS league, p_partkey AS ord, cell "
         f"FROM (SELECT *, {NOISE} AS cell FROM part))", CLEANED, DEDUPED],
        """SELECT league, part, '{' || to_json(league) || ':' || to_json(list(name ORDER BY first_ord)) || '}' AS names_json
           FROM (SELECT *, (row_number() OVER (PARTITION BY league ORDER BY first_ord) - 1) // 100 AS part FROM deduped)
           GROUP BY league, part
           UNION ALL
           SELECT DISTINCT league, 0, '{' || to_json(league) || ':[]}' FROM feed WHERE league NOT IN (SELECT league FROM deduped)""",
    ),
    "json_feed_roundtrip": ctes(
        NAMES,
        "SELECT league, row_number() OVER (PARTITION BY league ORDER BY first_ord) - 1 AS name_ord, name FROM deduped",
    ),
    "json_documents_read": ctes(
        NAMES,
        "SELECT league, row_number() OVER (PARTITION BY league ORDER BY first_ord) - 1 AS name_ord, name FROM deduped",
    ),
    "json_long_quarantine": ctes(
        [FEED, CLEANED],
        """SELECT doc, CASE WHEN NOT bad THEN n END AS n_names, CASE WHEN NOT bad THEN k - 1 END AS last_league,
             CASE WHEN bad THEN 'not one JSON object of lists of texts' END AS reason
           FROM (SELECT ord // 100 AS doc, ord // 100 % 10 IN (3, 7) AS bad, count(*) AS n, count(DISTINCT league) AS k
             FROM cleaned GROUP BY ALL)""",
    ),
    "feed_tag_league": f"""
        WITH slugs(slug, formal_name) AS (VALUES {', '.join(f"('{s}', '{n}')" for s, n in SLUGS.items())})
        SELECT slug, formal_name, 'raw/' || slug || '/table' AS landing_key, count(*) AS n
        FROM (SELECT regexp_extract(url, '^[a-z]+://[^/]+/([^/?#]+)', 1) AS slug FROM pages) JOIN slugs USING (slug)
        GROUP BY ALL""",
    "alias_flatten": ctes([CLUB, ALIAS], "SELECT alias, standard_name FROM alias"),
    "alias_exact": ctes(
        ALIASED,
        """SELECT league, name, standard_name, CASE WHEN alias IS NOT NULL THEN 100::BIGINT END AS score
           FROM deduped LEFT JOIN alias ON name = alias""",
    ),
    "alias_miss": ctes([*ALIASED, MISS], "SELECT name FROM miss"),
    "normalise_names": ctes(
        [FEED, CLEANED],
        f"""SELECT name, {norm('name')} AS norm, {key('name')} AS token_key FROM (
             SELECT name FROM cleaned UNION SELECT regexp_extract(html, '(?s)<title>(.*?)</title>', 1) FROM pages)""",
    ),
    "token_sort_ratio": ctes(
        [FEED, CLEANED],
        f"""SELECT ord, name, standard_name, {rounded(sim('a', 'b'))} AS score FROM (
             SELECT ord, name, p_name || ' co' AS standard_name, {key('name')} AS a, {key("(p_name || ' co')")} AS b
             FROM cleaned JOIN part ON ord = p_partkey)""",
    ),
    "fuzzy_best": ctes(MATCHED, "SELECT name, best, score FROM best"),
    "fuzzy_entities": bit_matches(
        "SELECT c_custkey AS id, c_name AS name FROM customer",
        "SELECT s_suppkey AS ord, replace(s_name, 'Supplier', 'Customer') AS standard_name FROM supplier",
    ),
    "fuzzy_blocks": bit_matches(
        f"SELECT c_custkey AS id, {CUSTOMER_TEXT.replace('STRING', 'VARCHAR')} AS name FROM customer",
        "SELECT min(p_partkey) AS ord, concat_ws(' ', p_name, p_brand, p_partkey) AS standard_name FROM part GROUP BY 2",
    ),
    "alias_beyond_broadcast": ctes(
        ALIASED,
        """SELECT league, name, standard_name, CASE WHEN alias IS NOT NULL THEN 100::BIGINT END AS score
           FROM deduped LEFT JOIN alias ON name = alias""",
    ),
    "resolve_hot": ctes(
        MATCHED,
        """SELECT league, d.name, coalesce(a.standard_name, g.standard_name) AS standard_name,
             CASE WHEN a.alias IS NOT NULL THEN 100 ELSE g.score END::BIGINT AS match_confidence
           FROM cleaned d LEFT JOIN alias a ON d.name = a.alias LEFT JOIN gated g ON d.name = g.name""",
    ),
    "match_gate": ctes(MATCHED, "SELECT name, standard_name, score FROM gated"),
    "silver_master": ctes(RESOLVED, "SELECT raw_name, standard_name, league, match_confidence FROM silver"),
    "review_log": ctes([*RESOLVED, REVIEW], "SELECT * FROM review"),
    "gold_ranking": ctes([*RESOLVED, GOLD], "SELECT * FROM gold"),
    "gold_snapshot": ctes(
        [*RESOLVED, GOLD],
        """SELECT 'ranking_' || strftime(TIMESTAMP '2026-01-02 03:04:00', '%d%m%Y_%H%M') || '.csv' AS snapshot, "League",
             count(*) AS n, max("Positions") AS last_position
           FROM gold GROUP BY ALL""",
    ),
    "run_metrics": ctes(
        [*RESOLVED, REVIEW],
        """SELECT league, n_before, n_after, coalesce(n_review, 0) AS n_review
           FROM (SELECT league, count(*) AS n_before FROM cleaned GROUP BY league)
           JOIN (SELECT league, count(*) AS n_after FROM deduped GROUP BY league) USING (league)
           LEFT JOIN (SELECT league, count(*) AS n_review FROM review GROUP BY league) USING (league)""",
    ),
    "html_table_cells": ctes(
        [DOCS, CELLS],
        """SELECT league, doc, ro, co, false AS head, cell FROM cells
           UNION ALL
           SELECT DISTINCT league, doc, 0, h.co, true, h.cell
           FROM docs CROSS JOIN (VALUES (0, 'Pos'), (1, 'Team')) h(co, cell)""",
    ),
    "html_hard_cells": hard_cells(),
    "pages_list_cells": page_cells(),
    "probe_column_len": ctes(
        [DOCS, CELLS],
        "SELECT league, doc, min(co) FILTER (WHERE length(cell) > 3) AS col FROM cells GROUP BY league, doc",
    ),
    "probe_column_contains": ctes(
        [DOCS, CELLS],
        """SELECT league, doc, coalesce(min(co) FILTER (WHERE contains(cell, 'Brand#11 ') OR contains(cell, 'Brand#2 ')),
             CASE WHEN max(co) > 1 THEN 2 ELSE 1 END) AS col
           FROM cells GROUP BY league, doc""",
    ),
    "bad_feed_quarantine": """
        SELECT event_id, CASE event_id % 10 WHEN 4 THEN 'a name that is no text' WHEN 5 THEN 'not an object of lists'
          ELSE 'invalid json' END AS reason
        FROM events WHERE event_id % 10 < 6""",
    "pages_quarantine": """
        SELECT page_id, CASE WHEN few THEN 'no table' ELSE 'tables too deep' END AS reason FROM (SELECT page_id,
          NOT contains(html, '<ul>') OR len(string_split(string_split(html, '</ul>')[1], '<li>')) <= 6 AS few FROM pages)
        WHERE few OR page_id % 10 = 4""",
    "inline_table": """
        SELECT team_name, season, league_pos::INT AS league_pos, goals_scored::INT AS goals_scored,
          success_score_preview::DOUBLE AS success_score_preview, n
        FROM (VALUES ('ECONOMY', '2030/31', 1, 40, 7.5), ('SMALL', '2030/31', 2, 35, 6.25),
          ('PROMO', '2030/31', 3, 31, 5.5), ('STANDARD', '2030/31', 4, 28, 5.125))
          t(team_name, season, league_pos, goals_scored, success_score_preview)
        JOIN (SELECT p_type AS team_name, count(*) AS n FROM part GROUP BY 1) USING (team_name)""",
    "csv_roundtrip": ctes(
        [FEED],
        r"""SELECT league, ord, CASE WHEN ord % 3 = 0 AND cell IS NOT NULL THEN cell || ',"q"\NA' || chr(10) || 'next' ELSE cell END AS cell
            FROM feed""",
    ),
    "raw_landing": "SELECT event_id, props AS body FROM events",
}
ORACLE["inline_export"] = ORACLE["inline_table"]
ORACLE["master_export"] = ORACLE["silver_master"]
ORACLE["kept_answers"] = ORACLE["silver_master"]
ORACLE["review_export"] = ctes([*RESOLVED, REVIEW], "SELECT *, 'kept' AS log FROM review")
ORACLE["flow_metrics"] = ORACLE["run_metrics"]
ORACLE["bronze_guard"] = ctes(
    NAMES,
    """SELECT league, n_names, n_aside FROM (SELECT league, count(*) AS n_names FROM deduped GROUP BY league)
       JOIN (SELECT p_type AS league, count(DISTINCT p_partkey // 300) AS n_aside FROM part GROUP BY 1) USING (league)""",
)
# The flow ranks by (page, row of its table); parts of a league come in that same order.
ORACLE["medallion_end_to_end"] = ORACLE["gold_ranking"]

"""DuckDB SQL of the queries that SQL can express, by query name."""

from __future__ import annotations

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP1 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + 4) AS g
  FROM w, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(min(reach.b), d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id, n.n
"""

LINE = r"""
  NOT regexp_matches(x, '[^\x20\x09-\x0D]')
  OR NOT (length(regexp_replace(x, '[^#*$%&|<>]+', '', 'g')) * 10 > length(x)
    OR NOT regexp_matches(x, '[\p{L}\p{N}]')
    OR (length(regexp_replace(x, '[^|»›•·¦]+', '', 'g')) >= 3
      AND length(regexp_replace(x, '[^|»›•·¦]+', '', 'g')) * 4
        >= len(list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda y: y <> '')))
    OR 100 * (length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g'))
        - length(regexp_replace(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g'), '[\p{P}\p{S}]', '', 'g')))
      >= 40 * length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g'))
    OR regexp_matches(lower(trim(x)), '{nav}')
    OR (regexp_matches(lower(trim(x)), '{phrases}')
      AND (length(lower(trim(x))) - length(regexp_replace(lower(trim(x)), '{phrases}', '', 'g'))) * 6 >= length(trim(x))))
"""


def _op2() -> str:
    from pulsekit.llm.quality_rules import BOILERPLATE, NAV_ENTRIES
    line = LINE.replace("{nav}", NAV_ENTRIES).replace("{phrases}", BOILERPLATE)
    return rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
t AS (SELECT doc_id, i, list_slice(w, i, i + 2) AS g FROM w, unnest(range(1, greatest(len(w) - 1, 1))) AS u(i)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS k FROM t) WHERE k > 1),
c AS (SELECT doc_id, count(DISTINCT i + d) AS n FROM r, unnest([0, 1, 2]) AS v(d) GROUP BY doc_id),
b AS (
  SELECT w.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    coalesce(c.n, 0) AS n_repeat_words,
    array_to_string(list_filter(string_split(text, chr(10)), lambda x: {line}), chr(10)) AS clean
  FROM w LEFT JOIN c USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND 100 * length(regexp_replace(clean, '[\x20\x09-\x0D]+', '', 'g')) >= 50 * word_chars AS kept
FROM b
"""


OP7 = """
WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS name, coalesce(text, '') AS content
           FROM conversations WHERE conv_id IS NOT NULL),
p AS (SELECT DISTINCT conv_id, name AS perspective FROM t WHERE name <> 'system'),
r AS (SELECT t.*, perspective, CASE WHEN name = 'system' THEN 'system' WHEN name = perspective THEN 'assistant'
        ELSE 'user' END AS role FROM t JOIN p USING (conv_id)),
h AS (SELECT *, '<|im_start|>' || role || CASE WHEN role = 'user' THEN ' name=' || name ELSE '' END || chr(10) AS head FROM r),
s AS (SELECT *, head || content || '<|im_end|>' || chr(10) AS segment FROM h),
o AS (SELECT *, coalesce(sum(length(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, name, content
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS st FROM s)
SELECT conv_id, perspective, turn, role, name, segment, CASE WHEN role = 'assistant' THEN 1 ELSE 0 END AS mask,
  st AS "start", st + length(segment) AS "end", CASE WHEN role = 'assistant' THEN st + length(head) END AS mask_start,
  CASE WHEN role = 'assistant' THEN st + length(segment) - 1 END AS mask_end
FROM o
"""


OP11 = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
m AS (SELECT text, min(doc_id) AS first FROM d GROUP BY text),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 3 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN d.doc_id > m.first THEN 'E' ELSE '' END AS fails
  FROM d JOIN m USING (text) LEFT JOIN l ON l.doc_id = d.doc_id),
h AS (SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS letter, fails, good, toxic, n,
    length(translate(filter_order[1:step - 1], fails, '')) < step - 1 AS before, contains(fails, filter_order[step]) AS now
  FROM h, o, range(1, 6) AS r(step)),
t AS (
  SELECT part, filter_order, step, letter,
    coalesce(sum(n) FILTER (NOT before AND NOT now), 0) AS kept, coalesce(sum(n) FILTER (NOT before AND now), 0) AS removed,
    coalesce(sum(n) FILTER (before AND now), 0) AS redundant, coalesce(sum(n) FILTER (fails = letter), 0) AS unique_fails,
    coalesce(sum(n) FILTER (NOT before AND now AND good = 1), 0) AS good_lost,
    coalesce(sum(n) FILTER (NOT before AND now AND toxic = 1), 0) AS toxic_lost
  FROM s GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM t
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_jaccard": OP1, "op2_quality_rules": _op2(), "op7_perspective_rotation": OP7,
            "op11_filter_audit": OP11}

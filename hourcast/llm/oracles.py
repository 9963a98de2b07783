"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from hourcast.llm.licenses import (
    COMMON,
    LONG,
    NAMING,
    SHORT,
    TEMPLATES,
    THRESHOLD,
    least_telling,
    set_weights,
    template_idf,
    template_weights,
)
from hourcast.llm.quality import RULES

UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE_WORD = r"[^\x20\x09-\x0D]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

LEDGER = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT r, unnest(regexp_extract_all(text, '{SPACE_WORD}')) AS w,
         generate_subscripts(regexp_extract_all(text, '{SPACE_WORD}'), 1) AS i FROM d
), g AS (
  SELECT r, i, w || ' ' || lead(w) OVER o || ' ' || lead(w, 2) OVER o AS g
  FROM w WINDOW o AS (PARTITION BY r ORDER BY i)
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g WHERE g IS NOT NULL)
  WHERE n > 1
), repeated AS (
  SELECT r, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r
), words AS (SELECT r, count(*) AS n, sum(length(w)) AS chars FROM w GROUP BY r),
line AS (
  SELECT r, l FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '{SPACE_WORD}')
), lines AS (SELECT r, count(*) AS n, count(*) - count(DISTINCT l) AS dup FROM line GROUP BY r),
m AS (
  SELECT doc_id, coalesce(words.n, 0) AS n_words, coalesce(words.chars, 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    length(regexp_replace(text, '[^!]', '', 'g')) AS n_marks,
    coalesce(lines.n, 0) AS n_lines, coalesce(lines.dup, 0) AS n_dup_lines,
    coalesce(repeated.n, 0) AS n_repeat_words
  FROM d LEFT JOIN words USING (r) LEFT JOIN lines USING (r) LEFT JOIN repeated USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (failures & 3) <> 0 AS base_failed, failures = 0 AS kept, failures,
  CASE failures {" ".join(f"WHEN {1 << k} THEN '{rule}'" for k, rule in enumerate(RULES))} END AS only_rule
FROM (SELECT *, ({" + ".join(f"CASE WHEN {rule} THEN {1 << k} ELSE 0 END" for k, rule in enumerate(RULES.values()))})::BIGINT AS failures FROM m)
"""

DECONTAMINATION = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UP}', '{LOW}'), '{WORD}') AS ws FROM documents
), b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UP}', '{LOW}'), '{WORD}') AS ws FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, ws[i:i + least(len(ws), 10) - 1] AS w
  FROM (SELECT *, unnest(generate_series(1, greatest(len(ws) - 9, 1))) AS i FROM b WHERE len(ws) > 0)
), sizes AS (SELECT DISTINCT n FROM win),
cut AS (
  SELECT r, n, i, ws[i:i + n - 1] AS w FROM (
    SELECT r, n, ws, unnest(generate_series(1, len(ws) - n + 1)) AS i FROM d, sizes WHERE len(ws) >= n)
), hit AS (SELECT r, i, n, item_id FROM cut JOIN win USING (n, w)),
pos AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY r),
items AS (
  SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(pos.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(pos.n, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN items USING (r)
"""

SIGNATURE_TREE = rf"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UP}', '{LOW}'), '{SPACE_WORD}') AS ws FROM documents
), s AS (
  SELECT DISTINCT r, array_to_string(ws[i:i + 3], ' ') AS s
  FROM (SELECT r, ws, unnest(generate_series(1, greatest(len(ws) - 3, 1))) AS i FROM d WHERE len(ws) > 0)
), n AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
common AS MATERIALIZED (SELECT a.r AS x, b.r AS y, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.r <> b.r GROUP BY ALL),
link AS (
  SELECT x, y FROM common JOIN n a ON a.r = x JOIN n b ON b.r = y WHERE 100 * c >= 85 * (a.n + b.n - c)
), reach AS (SELECT r AS x, r AS y FROM d UNION SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y)
SELECT a.doc_id, coalesce(n.n, 0) AS n_shingles, min(b.doc_id) AS component_id
FROM reach JOIN d a ON a.r = reach.x JOIN d b ON b.r = reach.y LEFT JOIN n ON n.r = a.r
GROUP BY a.r, a.doc_id, n.n
"""

SOURCE_MIX = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{SPACE_WORD}')) AS size,
    md5('0:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS key FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS s, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM d GROUP BY source
), w AS (SELECT source, s, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM s),
c AS (
  SELECT source, s, w, sum(s) OVER () - coalesce(sum(3 * s) OVER before, 0) AS words,
    sum(w) OVER after AS weight, row_number() OVER (ORDER BY s::DOUBLE / w, source) AS i
  FROM w WINDOW before AS (ORDER BY s::DOUBLE / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    after AS (ORDER BY s::DOUBLE / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), level AS (SELECT words, weight FROM c WHERE 3 * s * weight >= words * w ORDER BY i LIMIT 1),
t AS (
  SELECT source, s, CASE WHEN 3 * s * level.weight < level.words * w THEN (3 * s)::DOUBLE
    ELSE level.words::DOUBLE * w / level.weight::DOUBLE END AS target FROM w, level
), b AS (SELECT *, floor(target + 0.5)::BIGINT AS budget FROM t),
r AS (
  SELECT doc_id, size, s, target, CASE WHEN s > 0 THEN budget // s ELSE 0 END AS epochs, budget,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size::BIGINT AS size, s AS source_size, target,
  (epochs * size + least(greatest(budget - epochs * s - ahead, 0), size))::BIGINT AS taken
FROM r
"""


# Where a comment's or a paragraph's lines end, and how a comment's lines begin.
_BLANK = r"[^ \t\n\x0B\f\r]"
_MARKED = r"^[ \t]*(#|//|;|--|%)"


def _license_matches(rank: int, source: str, templates: dict[str, str], counts: bool) -> str:
    """m{rank}: r, line, license, cosine of the texts in `source` (r, line, x) that match."""
    idf, unknown = template_idf(templates)
    if counts:
        weights = [(w, n, v * idf[w]) for n, own in template_weights(templates).items() for w, v in own.items()]
    else:
        weights = set_weights(templates)
    known = ", ".join(f"('{w}', {v!r}::DOUBLE)" for w, v in idf.items())
    held = ", ".join(
        f"('{n}', '{n.split(' ')[0]}', '{w}', {v!r}::DOUBLE, {w not in COMMON}, {least_telling(templates[n])})"
        for w, n, v in weights
    )
    names = ", ".join(f"'{n}'" for n in NAMING)
    times = "ln(count(*)) + 1" if counts else "1.0"
    return rf"""
idf{rank}(w, v) AS (VALUES {known}),
held{rank}(template, license, w, weight, telling, least) AS (VALUES {held}),
t{rank} AS MATERIALIZED (
  SELECT r, line, w, {times} AS n FROM (
    SELECT r, line, unnest(regexp_extract_all(translate(x, '{UP}', '{LOW}'), '{WORD}')) AS w FROM {source})
  GROUP BY r, line, w
),
norm{rank} AS (
  SELECT r, line, sqrt(sum((n * coalesce(v, {unknown!r})) ** 2)) AS norm FROM t{rank} LEFT JOIN idf{rank} USING (w)
  GROUP BY r, line HAVING bool_or(w IN ({names}))
),
m{rank} AS (
  SELECT r, {rank} AS rank, line, license, round(sum(n * weight) / any_value(norm), 6) AS cosine
  FROM t{rank} JOIN held{rank} USING (w) JOIN norm{rank} USING (r, line) GROUP BY r, line, template, license, least
  HAVING round(sum(n * weight) / any_value(norm), 6) >= {THRESHOLD} AND count_if(telling) >= least
)"""


def _license_sql() -> str:
    """No file is named as a licence here: names are numbers, so ranks begin with the block."""
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    source || '/' || lang || '/' || (doc_id // 1000) AS home FROM documents
), l AS (
  SELECT r, i - 1 AS line, x FROM (
    SELECT r, unnest(ls) AS x, generate_subscripts(ls, 1) AS i FROM (
      SELECT r, list_filter(string_split(text, chr(10)), lambda y: regexp_matches(y, '{SPACE_WORD}')) AS ls FROM d))
), body AS (
  SELECT r, ltrim(regexp_replace(ltrim(text, chr(65279) || ' ' || chr(9) || chr(13) || chr(10)),
    '\A#![^\n]*', ''), ' ' || chr(9) || chr(13) || chr(10)) AS x FROM d
), cut AS (
  SELECT r, x, string_split(x, chr(10)) AS ls, regexp_matches(x, '\A(#|//|;|--|%)') AS marked FROM body
), stop AS (
  SELECT *, coalesce(list_position(list_transform(ls, lambda y: NOT regexp_matches(y,
    CASE WHEN marked THEN '{_MARKED}' ELSE '{_BLANK}' END)), true), 0) AS stop FROM cut
), block AS (
  SELECT r, -1 AS line, CASE WHEN starts_with(x, '/*') THEN split_part(x, '*/', 1)
    WHEN starts_with(x, '<!--') THEN split_part(x, '-->', 1)
    WHEN stop > 0 THEN array_to_string(ls[:stop - 1], chr(10)) ELSE x END AS x FROM stop
), several AS (SELECT * FROM block WHERE contains(x, chr(10))),
bl AS (
  SELECT r, i - 1 AS line, x FROM (
    SELECT r, unnest(ls) AS x, generate_subscripts(ls, 1) AS i FROM (
      SELECT r, list_filter(string_split(x, chr(10)), lambda y: regexp_matches(y, '{SPACE_WORD}')) AS ls FROM block))
),{_license_matches(1, "several", LONG, True)},{_license_matches(2, "l", TEMPLATES, False)},{_license_matches(3, "bl", SHORT, False)},
m AS (SELECT * FROM m1 UNION ALL SELECT * FROM m2 UNION ALL SELECT * FROM m3),
best AS (
  SELECT r, license, cosine FROM m
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY rank, cosine DESC, license, line) = 1
), first AS (
  SELECT r, license FROM m WHERE rank = 2 AND line = 0
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY cosine DESC, license) = 1
), folder AS (
  SELECT home, license FROM (SELECT home, license, count(*) AS n FROM first JOIN d USING (r) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY home ORDER BY n DESC, license) = 1
)
SELECT doc_id, d.home || '/' || doc_id AS path, best.license AS own_license, best.cosine,
  folder.home AS folder, folder.license AS folder_license, coalesce(best.license, folder.license) AS license
FROM d LEFT JOIN best USING (r) LEFT JOIN folder ON folder.home = d.home
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_rule_ledger": LEDGER,
        "op8_signature_tree_join": SIGNATURE_TREE,
        "op9_prefix_filter_decontamination": DECONTAMINATION,
        "op10_license_scan": _license_sql(),
        "op12_source_mix": SOURCE_MIX,
    }

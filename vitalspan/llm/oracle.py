"""DuckDB statements equal to the queries of this subpackage, where SQL can express them."""

from __future__ import annotations

#: Rates of the quality rules: per thousand of; fences as in ``quality_rules.RULES``.
_RULES = """(VALUES ('word_length', 250, true), ('symbols', 12, false), ('marks', 12, false),
    ('capitals', 15, false), ('repeats', 80, false), ('lines_again', 10, false))"""

QUALITY_RULES = f"""
WITH w AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2] AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)
), again AS (
  SELECT doc_id, i FROM windows
  QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), repeats AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM again, (VALUES (0), (1), (2)) AS s(k) GROUP BY doc_id
), s AS (
  SELECT w.doc_id, lang, source, len(words)::BIGINT AS n_words,
    length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (length(t) - length(regexp_replace(t, '[!?]', '', 'g')))::BIGINT AS n_marks,
    (length(t) - length(regexp_replace(t, '[A-ZÀ-ÖØ-Þ]', '', 'g')))::BIGINT AS n_upper,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(repeats.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN repeats USING (doc_id)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s
), rates AS (
  SELECT doc_id, lang, source, base_failed, unnest([
    {{'rule': 'word_length', 'value': 1000 * word_chars // greatest(n_words, 1)}},
    {{'rule': 'symbols', 'value': 1000 * n_symbols // greatest(n_words, 1)}},
    {{'rule': 'marks', 'value': 1000 * n_marks // greatest(n_words, 1)}},
    {{'rule': 'capitals', 'value': 1000 * n_upper // greatest(word_chars, 1)}},
    {{'rule': 'repeats', 'value': 1000 * n_repeat_words // greatest(n_words, 1)}},
    {{'rule': 'lines_again', 'value': 1000 * n_dup_lines // greatest(n_words, 1)}}]) AS r
  FROM b
), v AS (
  SELECT lang, source, r.rule AS rule,
    r.value - r.value % (10 ** greatest(length(r.value::VARCHAR) - 3, 0))::BIGINT AS v
  FROM rates WHERE NOT base_failed
), levels AS (
  SELECT 0 AS level, lang, source, rule, v, count(*) AS n FROM v GROUP BY ALL
  UNION ALL SELECT 1, lang, NULL, rule, v, count(*) FROM v GROUP BY ALL
  UNION ALL SELECT 2, NULL, NULL, rule, v, count(*) FROM v GROUP BY ALL
), cumulated AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, rule ORDER BY v) AS below,
    sum(n) OVER (PARTITION BY level, lang, source, rule) AS total FROM levels
), quartiles AS (
  SELECT level, lang, source, rule, max(total) AS total,
    min(v) FILTER (4 * below >= total) AS q1, min(v) FILTER (4 * below >= 3 * total) AS q3
  FROM cumulated GROUP BY ALL
), chosen AS (
  SELECT o.lang, o.source, o.rule,
    CASE WHEN o.total >= 200 THEN o.q1 WHEN l.total >= 200 THEN l.q1 ELSE c.q1 END AS q1,
    CASE WHEN o.total >= 200 THEN o.q3 WHEN l.total >= 200 THEN l.q3 ELSE c.q3 END AS q3
  FROM quartiles o
  JOIN quartiles l ON l.level = 1 AND o.rule = l.rule AND o.lang IS NOT DISTINCT FROM l.lang
  JOIN quartiles c ON c.level = 2 AND o.rule = c.rule
  WHERE o.level = 0
), fences AS (
  SELECT lang, source, rule,
    CASE WHEN both_sides THEN q1 - 6 * greatest(q3 - q1, spread) END AS low,
    q3 + 6 * greatest(q3 - q1, spread) AS high
  FROM chosen JOIN {_RULES} AS r(rule, spread, both_sides) USING (rule)
), verdicts AS (
  SELECT doc_id, bool_and(coalesce(r.value >= low, true) AND coalesce(r.value <= high, true)) AS ok
  FROM rates LEFT JOIN fences f ON rates.r.rule = f.rule AND rates.lang IS NOT DISTINCT FROM f.lang
    AND rates.source IS NOT DISTINCT FROM f.source
  GROUP BY doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND ok AS kept
FROM b JOIN verdicts USING (doc_id)
"""

PIVOT_INDEX = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank,
    vec_id, score
  FROM scored
)
SELECT * FROM ranked WHERE rank <= 10
"""

CHAT_FORMAT = """
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
    (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM rows
), e AS (
  SELECT *, lag(role) OVER o AS before,
    length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')) AS role_chars,
    length(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')) AS text_chars
  FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
    AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
    FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(text_chars + 13)
    + coalesce(sum(role_chars + 7) FILTER (before IS DISTINCT FROM role), 0))::BIGINT
    AS formatted_chars
FROM e GROUP BY conv_id
"""

FILL_MIDDLE = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x
  FROM documents
), h AS (
  SELECT *, ('0x' || x[1:8])::BIGINT % (n + 1) AS c1, ('0x' || x[9:16])::BIGINT % (n + 1) AS c2,
    ('0x' || x[17:24])::BIGINT % 100 AS h3, ('0x' || x[25:32])::BIGINT % 100 AS h4
  FROM d
), c AS (
  SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b,
    CASE WHEN n = 0 OR h3 >= 90 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
      THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h
), p AS (
  SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix
  FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""

SUBSTRING_DEDUP = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 19], ' ')) AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)
), r AS (
  SELECT doc_id, i FROM s QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1
), gone AS (
  SELECT DISTINCT doc_id, i + k AS i FROM r, unnest(range(0, 20)) AS u(k)
), dropped AS (
  SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string([x FOR x, i IN w IF gone IS NULL OR NOT list_contains(gone, i)], ' '))
    AS kept_sha256
FROM d LEFT JOIN dropped USING (doc_id)
"""

PREFIX_TRIE = r"""
WITH crc AS (
  SELECT DISTINCT conv_id, (list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''),
      lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
      lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))
  )) AS x FROM conversations WHERE conv_id IS NOT NULL
), h AS (
  SELECT conv_id, xor(x, 4294967295) % 4 AS h FROM crc
), t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST,
    md5(length(role)::VARCHAR || ':' || role || text)) AS turns
  FROM t GROUP BY conv_id
), p AS (
  SELECT c.conv_id, list_concat(coalesce(o.turns[1 : h], []), c.turns[h + 1 :]) AS path
  FROM c JOIN h USING (conv_id) LEFT JOIN c AS o ON o.conv_id = c.conv_id - c.conv_id % 20
), m AS (
  SELECT conv_id, len(path) AS len, d, md5(path[1 : d]::VARCHAR) AS k,
    CASE WHEN d > 0 THEN md5(path[1 : d - 1]::VARCHAR) END AS parent,
    CASE WHEN d > 0 THEN len(regexp_extract_all(path[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS w
  FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM p)
), n AS (
  SELECT k, d, any_value(parent) AS parent, any_value(w) AS w, count(*) AS n_convs,
    min(conv_id) AS conv_id,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len = d), '') AS ends
  FROM m GROUP BY k, d
), kids AS (
  SELECT parent AS k, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL
), full_nodes AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (k, d)
), below AS (
  SELECT a.k, a.d, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * w) AS saved
  FROM (SELECT DISTINCT a.k, a.d, b.k AS bk, b.d AS bd
    FROM m AS a JOIN m AS b ON a.conv_id = b.conv_id AND b.d >= a.d) AS a
  JOIN full_nodes ON full_nodes.k = bk AND full_nodes.d = bd
  GROUP BY a.k, a.d
)
SELECT f.conv_id, f.d::BIGINT AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children,
  n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM full_nodes AS f JOIN below USING (k, d) LEFT JOIN full_nodes AS p ON p.k = f.parent AND p.d = f.d - 1
"""

STATEMENTS = {
    "op2_quality_rules": QUALITY_RULES,
    "op9_pivot_index": PIVOT_INDEX,
    "op10_chat_format": CHAT_FORMAT,
    "op11_fill_middle": FILL_MIDDLE,
    "op12_substring_dedup": SUBSTRING_DEDUP,
    "op13_prefix_trie": PREFIX_TRIE,
}

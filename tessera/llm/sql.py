"""DuckDB SQL of the queries that SQL can express, on whole tables."""

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

_OP1 = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), grams AS (
  SELECT doc_id, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), again AS (
  SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), covered AS (
  SELECT doc_id, sum(least(5, coalesce(nxt - i, 5))) AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM again) GROUP BY doc_id
), lines AS (
  SELECT doc_id, source, x, len(x) - len(replace(x, ' ', '')) + 1 AS n
  FROM (SELECT doc_id, source, trim(regexp_replace(lower(unnest(string_split(t, chr(10)))), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS x FROM d)
  WHERE x <> ''
), hosts AS (SELECT source, count(*) AS docs FROM documents GROUP BY source
), frequent AS (
  SELECT f.source, f.x FROM (SELECT source, x, count(DISTINCT doc_id) AS n FROM lines GROUP BY source, x) f
  JOIN hosts h ON f.source IS NOT DISTINCT FROM h.source WHERE f.n > 20 AND f.n > 0.1 * h.docs
), lost AS (
  SELECT doc_id, count(*) AS n_lines, sum(n) AS n_words FROM lines l
  WHERE EXISTS (SELECT 1 FROM frequent f WHERE f.source IS NOT DISTINCT FROM l.source AND f.x = l.x) GROUP BY doc_id
), counts AS (
  SELECT d.doc_id, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
         len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         coalesce(lost.n_lines, 0)::BIGINT AS n_removed_lines, coalesce(lost.n_words, 0)::BIGINT AS removed_words
  FROM d LEFT JOIN covered c USING (doc_id) LEFT JOIN lost USING (doc_id)
)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND removed_words <= 0.5 * n_words AS kept
FROM counts
"""

_OP5 = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_sum([a.q[i] * b.q[i] FOR i IN range(1, least(len(a.q), len(b.q)) + 1)])::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

#: n-gram links only between texts that share a shingle; components by the smallest reachable id.
_OP9 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 80 * (any_value(x.n) + any_value(y.n) - count(*))
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id
"""

#: Phrases of 2 to 5 words with their counts; parts and longer phrases by join.
_OP13 = r"""
WITH w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM w GROUP BY lang
), grams AS (
  SELECT lang, m, w[i:i+m-1] AS g, count(*) AS f
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE len(w) >= m)
  GROUP BY ALL HAVING count(*) >= 100
), inner_ AS (
  SELECT DISTINCT c.lang, c.g FROM grams c JOIN grams d ON d.lang = c.lang AND d.m = c.m + 1 AND 100 * d.f >= 100 * c.f
   AND (d.g[1:c.m] = c.g OR d.g[2:c.m+1] = c.g) WHERE c.m > 1
), cuts AS (
  SELECT c.lang, c.g, c.f AS a, k, l.f AS l, r.f AS r, t.n, (1000::HUGEINT * c.f * t.n) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM grams WHERE m > 1) c JOIN totals t ON t.lang = c.lang
  JOIN grams l ON l.lang = c.lang AND l.g = c.g[1:k] JOIN grams r ON r.lang = c.lang AND r.g = c.g[k+1:]
), best AS (
  SELECT * FROM cuts WHERE NOT EXISTS (SELECT 1 FROM inner_ i WHERE i.lang = cuts.lang AND i.g = cuts.g)
  QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank,
       array_to_string(g, ' ') AS phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM best QUALIFY rank <= 2000
"""

ORACLE = {"op1_line_quality": _OP1, "op5_tiled_topk": _OP5, "op9_ngram_join": _OP9, "op13_stream_phrases": _OP13}

"""DuckDB SQL of the numbered operators that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op10_host_rules"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, w[i:i + 2] AS v FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), repeated AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, v) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY 1
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY 1
), f AS (
  SELECT doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(lines.n, 0)::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f
), hosts AS (
  SELECT source, count(*) AS n, sum(base_failed::INT) AS bad FROM b GROUP BY 1
), prior AS (
  SELECT sum(bad) / sum(n) AS m, avg(n) AS size, var_pop(bad / n) - sum(bad) / sum(n) * (1 - sum(bad) / sum(n)) * avg(1.0 / n) AS v FROM hosts
), rates AS (
  SELECT source, (bad + m * s) / (n + s) AS rate
  FROM (SELECT *, CASE WHEN v > 0 THEN greatest(1.0, m * (1 - m) / v - 1) ELSE size END AS s FROM hosts, prior)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rate <= 0.6 AS kept,
  b.source, round(rate, 9) AS host_rate
FROM b JOIN rates ON b.source IS NOT DISTINCT FROM rates.source
"""

SQL["op6_substrings"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS v FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)
), late AS (
  SELECT doc_id, i FROM windows QUALIFY min(doc_id) OVER (PARTITION BY v) < doc_id
), gone AS (
  SELECT DISTINCT doc_id, i + k AS p FROM late, range(50) AS r(k)
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY 1
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

SQL["op4_pivot_top_k"] = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, x.vec_id, list_dot_product(q.e, x.e)::BIGINT AS score
  FROM v q JOIN v x ON q.vec_id % 20 = 0 AND q.vec_id <> x.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""

_CONTROL = r"'(<|\[)(\\*)(/?s>|sep>|/?INST\])', '\1\\\2\3', 'g'"
SQL["op12_chat"] = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), m AS (
  SELECT *, row_number() OVER w AS p, coalesce(lag(role) OVER w <> role, true) AS opens, coalesce(lead(role) OVER w <> role, true) AS closes
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), f AS (
  SELECT *,
    CASE WHEN opens THEN CASE WHEN role = 'assistant' THEN '<s>' ELSE '<s>[INST] ' END || regexp_replace(role, {_CONTROL}) ELSE '' END
    || '<sep>' || regexp_replace(text, {_CONTROL})
    || CASE WHEN closes THEN CASE WHEN role = 'assistant' THEN '' ELSE ' [/INST]' END || '</s>' || chr(10) ELSE '' END AS part
  FROM m
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY p)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY p) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length(part))::BIGINT AS formatted_chars, count(*) FILTER (WHERE opens) AS n_messages
FROM f GROUP BY 1
"""

SQL["op13_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), t AS (
  SELECT i, lang, source, translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT i, lang, source, unnest(w) AS x FROM d)
), kept AS (
  SELECT lang, term, count(*) AS n FROM t GROUP BY 1, 2 HAVING count(DISTINCT i) >= 3
), c AS (
  SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY 1, 2, 3
), v AS (
  SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY 1
), g AS (
  SELECT DISTINCT lang, source FROM d
), s AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY 1, 2
), p AS (
  SELECT s.lang, s.source, kept.term, c.n AS own, 1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (s.n + v.v)::HUGEINT AS p,
    1 + 1000000000::HUGEINT * (kept.n + 1) // (v.n + v.v)::HUGEINT AS q
  FROM s JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)
), f AS (
  SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY 1, 2, 3
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), both_parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE own > 0 AND p > q
)
SELECT lang, source, part, item, value::BIGINT AS value,
  row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM both_parts QUALIFY part = 'pair' OR rank <= 200
"""

SQL["op11_collocations"] = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), p AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d)
), one AS (
  SELECT lang, w AS x, count(*) AS f FROM (SELECT lang, unnest(w) AS w FROM p) GROUP BY 1, 2
), two AS (
  SELECT lang, w[i] AS x, w[i + 1] AS y, count(*) AS f FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM p) GROUP BY 1, 2, 3
), three AS (
  SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z, count(*) AS f FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM p)
  GROUP BY 1, 2, 3, 4 HAVING count(*) >= 10
), holders AS (
  SELECT lang, x, y, max(f) AS f FROM (SELECT lang, x, y, f FROM three UNION ALL SELECT lang, y, z, f FROM three) GROUP BY 1, 2, 3
), cuts AS (
  SELECT two.lang, two.x || ' ' || two.y AS phrase, two.f AS a, 1 AS k, l.f AS l, r.f AS r
  FROM two JOIN one l ON l.lang = two.lang AND l.x = two.x JOIN one r ON r.lang = two.lang AND r.x = two.y
  LEFT JOIN holders h ON h.lang = two.lang AND h.x = two.x AND h.y = two.y
  WHERE two.f >= 10 AND (h.f IS NULL OR 100 * h.f < 50 * two.f)
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, 1, l.f, r.f
  FROM three t JOIN one l ON l.lang = t.lang AND l.x = t.x JOIN two r ON r.lang = t.lang AND r.x = t.y AND r.y = t.z
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, 2, l.f, r.f
  FROM three t JOIN two l ON l.lang = t.lang AND l.x = t.x AND l.y = t.y JOIN one r ON r.lang = t.lang AND r.x = t.z
), scored AS (
  SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts
), least_cut AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), n AS (
  SELECT lang, sum(f)::BIGINT AS n FROM one GROUP BY 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM least_cut JOIN n USING (lang) QUALIFY rank <= 2000
"""

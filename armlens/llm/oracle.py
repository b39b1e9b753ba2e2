"""DuckDB oracle SQL of the corpus queries that SQL can express on whole tables."""

from __future__ import annotations

FILL_MIDDLE = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
placed AS (
  SELECT doc_id, t, n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS p, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS q,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                   OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT doc_id, t, n, form, least(p, q) AS a, greatest(p, q) - least(p, q) AS b, substr(t, 1, least(p, q)) AS prefix,
         substr(t, least(p, q) + 1, greatest(p, q) - least(p, q)) AS middle, substr(t, greatest(p, q) + 1) AS suffix
  FROM placed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
one AS (SELECT lang, unnest(w) AS phrase FROM lists),
two AS (SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS phrase FROM lists),
three AS (SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS phrase FROM lists),
f AS (SELECT lang, phrase, count(*) AS f FROM (FROM one UNION ALL FROM two UNION ALL FROM three) GROUP BY ALL),
totals AS (SELECT lang, count(*) AS n FROM one GROUP BY lang),
cand AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE f >= 10 AND contains(phrase, ' ')),
cuts AS (
  SELECT lang, phrase, a, w, k, array_to_string(w[:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y
  FROM cand, (VALUES (1), (2)) v(k) WHERE k < len(w)),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.w, c.k, l.f AS l, r.f AS r,
         CAST(CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.x JOIN f r ON r.lang = c.lang AND r.phrase = c.y),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, array_to_string(w[:2], ' ') AS phrase, a FROM cand WHERE len(w) = 3
    UNION ALL SELECT lang, array_to_string(w[2:], ' '), a FROM cand WHERE len(w) = 3) GROUP BY ALL),
kept AS (
  SELECT w.* FROM worst w LEFT JOIN longer g ON g.lang = w.lang AND g.phrase = w.phrase
  WHERE g.a IS NULL OR 100 * g.a < 50 * w.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op11_fill_middle": FILL_MIDDLE,
    "op12_phrases": PHRASES,
}


def oracle_queries() -> dict[str, str]:
    return dict(ORACLES)

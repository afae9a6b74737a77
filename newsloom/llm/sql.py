"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op2_exact_dedup"] = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm,
         length(coalesce(text, '')) AS points
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id NULLS LAST) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id IS NOT DISTINCT FROM first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id NULLS LAST) AS kept,
       sha256(norm) AS text_sha256
FROM n
"""

_QUALITY = r"""
WITH w AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), win AS (
  SELECT doc_id, i, list_slice(words, i, i + 7) AS v
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, v) AS n FROM win) WHERE n >= 2
), covered AS (
  SELECT doc_id, sum(least(8, i - coalesce(before, i - 8)))::BIGINT AS n_repeat_words
  FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM twice) GROUP BY doc_id
), c AS (
  SELECT w.doc_id, lang, source, len(words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN covered ON covered.doc_id = w.doc_id
), m AS (
  SELECT *, n_symbols * 10000 // nullif(word_chars, 0) AS symbols, word_chars * 100 // nullif(n_words, 0) AS length,
         n_dup_lines * 10000 // nullif(n_lines, 0) AS lines
  FROM c
), v AS (
  SELECT lang, source, unnest(['symbols', 'length', 'lines']) AS measure, unnest([symbols, length, lines]) AS v
  FROM m WHERE n_words > 0
), b AS (
  SELECT lang, source, measure, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS b FROM v
), own AS (
  SELECT lang, source, measure, count(*) AS n, quantile_disc(b, 0.25) AS q1, quantile_disc(b, 0.75) AS q3 FROM b GROUP BY ALL
), by_lang AS (
  SELECT lang, measure, count(*) AS n, quantile_disc(b, 0.25) AS q1, quantile_disc(b, 0.75) AS q3 FROM b GROUP BY ALL
), overall AS (
  SELECT measure, quantile_disc(b, 0.25) AS q1, quantile_disc(b, 0.75) AS q3 FROM b GROUP BY ALL
), fence AS (
  SELECT g.lang, g.source, g.measure,
         CASE WHEN g.n >= 200 THEN g.q3 + 3 * (g.q3 - g.q1) WHEN h.n >= 200 THEN h.q3 + 3 * (h.q3 - h.q1)
              ELSE o.q3 + 3 * (o.q3 - o.q1) END
         + CASE g.measure WHEN 'symbols' THEN 200 WHEN 'length' THEN 300 ELSE 3000 END AS most
  FROM own g JOIN by_lang h ON g.lang IS NOT DISTINCT FROM h.lang AND g.measure = h.measure JOIN overall o ON g.measure = o.measure
), f AS (
  SELECT lang, source, max(most) FILTER (measure = 'symbols') AS symbols, max(most) FILTER (measure = 'length') AS length,
         max(most) FILTER (measure = 'lines') AS lines
  FROM fence GROUP BY lang, source
), j AS (
  SELECT m.*, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         coalesce(m.symbols <= f.symbols, true) AND coalesce(m.length <= f.length, true) AND coalesce(m.lines <= f.lines, true) AS within
  FROM m LEFT JOIN f ON m.lang IS NOT DISTINCT FROM f.lang AND m.source IS NOT DISTINCT FROM f.source
)
"""

ORACLE["op8_quality_rules"] = _QUALITY + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND within AS kept FROM j
"""

ORACLE["op12_collocations"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p
), g AS (
  SELECT lang, m, list_slice(words, i, i + m - 1) AS words
  FROM (SELECT lang, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM w, range(1, 6) AS lengths(m) WHERE len(words) >= m)
), f AS (
  SELECT lang, m, words, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100
), total AS (
  SELECT lang, count(*) AS n FROM g WHERE m = 1 GROUP BY lang
), longer AS (
  SELECT lang, part, max(f) AS f
  FROM (SELECT lang, f, unnest([list_slice(words, 1, m - 1), list_slice(words, 2, m)]) AS part FROM f WHERE m > 2) GROUP BY ALL
), cut AS (
  SELECT c.lang, c.words, c.f AS a, unnest(range(1, c.m)) AS k, c.m
  FROM f c LEFT JOIN longer x ON x.lang = c.lang AND x.part = c.words WHERE c.m > 1 AND (x.f IS NULL OR x.f < c.f)
), scored AS (
  SELECT cut.lang, array_to_string(cut.words, ' ') AS phrase, a, k, h.f AS l, t.f AS r, n,
         ((1000::HUGEINT * a * n) // (h.f::HUGEINT * t.f))::BIGINT AS score
  FROM cut JOIN f h ON h.lang = cut.lang AND h.words = list_slice(cut.words, 1, k)
           JOIN f t ON t.lang = cut.lang AND t.words = list_slice(cut.words, k + 1, cut.m)
           JOIN total ON total.lang = cut.lang
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""

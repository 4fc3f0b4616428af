"""SQL that gives the rows of those queries that SQL can express. Patterns and limits are written out once more here."""

_WORD = r"[^\x20\x09-\x0D]+"

MIX = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM d GROUP BY source
), w AS (
  SELECT source, source_size, CAST(place % 3 + 1 AS BIGINT) AS weight, 3 * source_size AS most FROM s
), o AS (
  SELECT *, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS n,
    sum(source_size) OVER () - coalesce(sum(most) OVER (
      ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS budget,
    sum(weight) OVER (
      ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS others
  FROM w
), f AS (
  SELECT *, most * others <= budget * weight AS is_full FROM o
), level AS (
  SELECT arg_min(budget, n) AS budget, arg_min(others, n) AS others FROM f WHERE NOT is_full
), t AS (
  SELECT source, source_size, CASE WHEN is_full THEN CAST(most AS DOUBLE)
    ELSE CAST((SELECT budget FROM level) * weight AS DOUBLE) / (SELECT others FROM level) END AS target FROM f
), r AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t
), c AS (
  SELECT source, h, sum(size) AS size, sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS upto FROM d GROUP BY source, h
), b AS (
  SELECT r.source, arg_min(
      CASE WHEN c.upto - (r.target - r.whole * r.source_size) <= (r.target - r.whole * r.source_size) - (c.upto - c.size)
        THEN c.h ELSE c.h - 1 END, c.h) AS threshold
  FROM r JOIN c ON r.source IS NOT DISTINCT FROM c.source
  WHERE r.target - r.whole * r.source_size > 0 AND c.upto >= r.target - r.whole * r.source_size
  GROUP BY r.source
), x AS (
  SELECT d.doc_id, d.source, d.size, r.source_size, r.target,
    CAST(r.whole + CASE WHEN d.h <= coalesce(b.threshold, -1) THEN 1 ELSE 0 END AS BIGINT) AS copies
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source LEFT JOIN b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, source, size, source_size, target, copies, CAST(size * copies AS BIGINT) AS taken FROM x
"""

_PHRASES = " OR ".join(
    f"contains(lower(line), '{phrase}')"
    for phrase in (
        "accept all cookies|all rights reserved|by continuing to use this site|click here|cookie policy|creative commons"
        "|enable javascript|forgot your password|licensed under|log in to|lorem ipsum|privacy policy|sign up for"
        "|skip to content|subscribe to our|terms of service|terms of use|this site uses cookies|use of cookies"
        "|we use cookies"
    ).split("|")
)
_WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w
  FROM documents
), g AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1
), covered AS (
  SELECT r, count(*) AS n FROM (SELECT DISTINCT r, i + k AS at FROM again, (SELECT unnest(range(5)) AS k)) GROUP BY r
), l AS (
  SELECT r, unnest(string_split(t, chr(10))) AS line FROM d
), m AS (
  SELECT r, line, len(regexp_extract_all(line, '{_WORD}')) AS n, len(regexp_extract_all(line, '[#*$%&|<>]|!!+')) AS marks,
    len(regexp_extract_all(line, '(^|[\x20\x09-\x0D])[|>»›·•/]+($|[\x20\x09-\x0D])')) AS menu
  FROM l
), v AS (
  SELECT *, n >= 4 AND NOT regexp_matches(right(rtrim(line, {_WHITE}), 8), '[.!?…。！？:;][\"''”’»)\]]*$')
      OR marks * 100 > n * 30
      OR menu >= 2 AND menu * 100 > n * 30
      OR {_PHRASES} AS fails
  FROM m
), z AS (
  SELECT r, coalesce(sum(n) FILTER (WHERE fails), 0) AS lost, count(*) FILTER (WHERE NOT fails) AS stay,
    coalesce(sum(length(line)) FILTER (WHERE NOT fails), 0) AS chars
  FROM v GROUP BY r
), q AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')))
      - len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')))) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(lost AS BIGINT) AS lost_words, CAST(chars + greatest(stay - 1, 0) AS BIGINT) AS n_cleaned
  FROM d JOIN z USING (r) LEFT JOIN covered USING (r)
), k AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM q)
SELECT *, NOT base_failed AND 100 * lost_words <= 60 * n_words AS kept FROM k
"""

COLLOCATIONS = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), p AS (
  SELECT lang, row_number() OVER () AS p, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)
), w AS (
  SELECT lang, p, unnest(w) AS w1, unnest(range(len(w))) AS i FROM p
), g AS (
  SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY p ORDER BY i)
), f1 AS (SELECT lang, w1, count(*) AS f FROM g GROUP BY ALL
), f2 AS (SELECT lang, w1, w2, count(*) AS f FROM g WHERE w2 IS NOT NULL GROUP BY ALL
), f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang
), around AS (
  SELECT lang, w1, w2, max(f) AS f FROM (SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL
), cuts AS (
  SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.w1 = f2.w1 JOIN f1 y ON y.lang = f2.lang AND y.w1 = f2.w2
    LEFT JOIN around ON around.lang = f2.lang AND around.w1 = f2.w1 AND around.w2 = f2.w2
  WHERE f2.f >= 10 AND 100 * coalesce(around.f, 0) < 50 * f2.f
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.f, 1, x.f, y.f
  FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.w1 = f3.w1 JOIN f2 y ON y.lang = f3.lang AND y.w1 = f3.w2 AND y.w2 = f3.w3
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.f, 2, x.f, y.f
  FROM f3 JOIN f2 x ON x.lang = f3.lang AND x.w1 = f3.w1 AND x.w2 = f3.w2 JOIN f1 y ON y.lang = f3.lang AND y.w1 = f3.w3
), scored AS (
  SELECT *, CAST(1000000::HUGEINT * a * a // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

TOP_INNER = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.row <> c.row AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

ORACLES: dict[str, str] = {
    "op1_mix_sources": MIX,
    "op6_quality_rules": QUALITY,
    "op11_phrase_collocations": COLLOCATIONS,
    "op13_topk_search": TOP_INNER,
}

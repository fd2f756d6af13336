"""DuckDB twins of the registered queries that SQL can express."""

from __future__ import annotations

from formline.llm.license_scan import NOTICES
from formline.llm.line_frequency import MAX_DOCUMENTS, MIN_LEFT
from formline.llm.mixing import SEED

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

LINE_FREQUENCY = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, source, t, {_WORDS.format("t")} AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
windows AS (SELECT doc_id, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] || ' ' || ws[i+3] || ' ' || ws[i+4] AS g
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n
            FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, source, hash(t) AS th,
                 trim(regexp_replace(regexp_replace(lower(l), '[0-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS nl,
                 len({_WORDS.format("l")}) AS n
          FROM (SELECT doc_id, source, t, unnest(ls) AS l FROM w)),
frequent AS (SELECT source, nl, min(doc_id) AS first_id FROM lines GROUP BY source, nl
             HAVING count(DISTINCT th) > {MAX_DOCUMENTS}),
gone AS (SELECT doc_id, sum(n) AS n FROM lines JOIN frequent USING (source, nl) WHERE doc_id <> first_id GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
             (len(ws) - coalesce(gone.n, 0))::BIGINT AS n_left
      FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN gone USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_left >= {MIN_LEFT}::DOUBLE * n_words AS kept, n_left FROM b
"""

POISSON_MIX = f"""
WITH mass AS (SELECT source, sum(length(coalesce(text, '')))::DOUBLE AS m FROM documents GROUP BY source),
rates AS (SELECT source, CASE WHEN m > 0 THEN sqrt(m) / sum(sqrt(m)) OVER () * sum(m) OVER () / m ELSE 1.0 END AS rate FROM mass),
drawn AS (
  SELECT d.*, rate, (('0x' || substring(md5('{SEED}:' || doc_id), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents d JOIN rates ON d.source IS NOT DISTINCT FROM rates.source),
terms AS (SELECT source, rate, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p
          FROM rates, range(0, 400) r(k) WHERE rate > 0),
steps AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms),
counts AS (SELECT doc_id, count(*) FILTER (c < u) AS n
           FROM drawn JOIN steps ON drawn.source IS NOT DISTINCT FROM steps.source GROUP BY doc_id)
SELECT doc_id, text, lang, source, n_chars, round(rate, 9) AS rate, copy::INT AS copy, md5('{SEED}:' || doc_id || ':' || copy) AS shuffle_key
FROM (SELECT drawn.*, unnest(range(0, n)) AS copy FROM drawn JOIN counts USING (doc_id))
"""

_TEMPLATES = ", ".join(f"('{name}', '{text.replace(chr(39), chr(39) * 2)}')" for name, text in NOTICES.items())
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SHINGLES = (
    "SELECT DISTINCT id, size, array_to_string(ws[i:i + size - 1], ' ') AS g"
    " FROM (SELECT id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM {} WHERE len(ws) >= size)"
)

LICENSE_SCAN = f"""
WITH templates(id, t) AS (VALUES {_TEMPLATES}),
tw AS (SELECT id, ws, least(5, len(ws)) AS size FROM (SELECT id, {_WORDS.format(_LOWER.format("t"))} AS ws FROM templates)),
dw AS (SELECT id, ws, size FROM (SELECT doc_id AS id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS ws FROM documents),
       (SELECT DISTINCT size FROM tw)),
ts AS ({_SHINGLES.format("tw")}),
ds AS ({_SHINGLES.format("dw")}),
sizes AS (SELECT id, count(*) AS n FROM ts GROUP BY id)
SELECT ds.id AS doc_id, ts.id AS template_id, count(*)::DOUBLE / any_value(sizes.n) AS containment
FROM ds JOIN ts USING (g, size) JOIN sizes ON ts.id = sizes.id
GROUP BY ds.id, ts.id HAVING count(*) >= 0.8 * any_value(sizes.n)
"""

CAPTURE_INDEX = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM p)
SELECT page_id, n AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 100 AND first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND first_id < page_id THEN first_id END AS refers_to
FROM f
"""

PROJECTION_COLLISIONS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
          AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id, vec_id AS c FROM embeddings
          UNION SELECT links.b, reach.c FROM reach JOIN links ON links.a = reach.vec_id),
parts AS (SELECT vec_id, min(c) AS component_id FROM reach GROUP BY vec_id),
degrees AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT p.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, p.vec_id = component_id AS kept
FROM parts p LEFT JOIN degrees USING (vec_id)
"""

SUFFIX_SORT = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS w
            FROM (SELECT doc_id, h, unnest(range(0, (len(h) // 2 - 49)::BIGINT)) AS i FROM d WHERE len(h) >= 100)),
repeated AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY w) AS first_id FROM windows) WHERE first_id < doc_id),
edges AS (SELECT doc_id, i, max(i) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM repeated),
runs AS (SELECT *, sum((before IS NULL OR i > before + 50)::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM edges),
spans AS (SELECT doc_id, run, min(i) AS b, max(i) + 50 AS e FROM runs GROUP BY doc_id, run),
listed AS (SELECT doc_id, sum(e - b) AS n_removed, count(*) AS n_spans,
                  list_concat([0], list(e ORDER BY b)) AS froms, list(b ORDER BY b) AS tos FROM spans GROUP BY doc_id),
cut AS (SELECT d.doc_id, h, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
               coalesce(froms, [0]) AS froms, list_append(coalesce(tos, []), len(h) // 2) AS tos
        FROM d LEFT JOIN listed USING (doc_id))
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, n_removed, n_spans,
       sha256(unhex(array_to_string(list_transform(range(1, len(froms) + 1), lambda k: substr(h, 2 * froms[k] + 1, 2 * (tos[k] - froms[k]))), ''))) AS kept_sha256
FROM cut
"""

COLLOCATIONS = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
                       unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM pieces),
grams AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
          FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, range(1, 5) r(k) WHERE len(ws) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2 AND f >= 30),
cuts AS (SELECT lang, k, phrase, a, j, array_to_string(ws[1:j], ' ') AS p1, array_to_string(ws[j + 1:], ' ') AS p2
         FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
scored AS (SELECT cuts.*, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f + y.f))::BIGINT AS score
           FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = p1 JOIN f y ON y.lang = cuts.lang AND y.phrase = p2),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_phrases AS (
  SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, a AS longer
  FROM (SELECT lang, ws, a, m, unnest(range(1, k - m + 2)) AS i FROM c, range(2, 4) q(m) WHERE m < k)),
nested AS (SELECT DISTINCT best.lang, best.phrase FROM best JOIN inner_phrases USING (lang, phrase) WHERE 100 * longer >= 80 * a),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score
           FROM best ANTI JOIN nested USING (lang, phrase))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

ORACLE = {
    "op4_line_frequency": LINE_FREQUENCY,
    "op5_poisson_mix": POISSON_MIX,
    "op6_license_scan": LICENSE_SCAN,
    "op8_projection_collisions": PROJECTION_COLLISIONS,
    "op10_capture_index": CAPTURE_INDEX,
    "op12_suffix_sort": SUFFIX_SORT,
    "op13_collocations": COLLOCATIONS,
}

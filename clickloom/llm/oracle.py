"""DuckDB SQL for the queries that SQL can express."""

from clickloom.llm.licenses import APART, COVERED, GRAM, PHRASES, TEMPLATES

_LINES = r"""
WITH lines AS (
  SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
shared AS (SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (SELECT l.doc_id, l.i, l.line, s.owner IS NOT NULL AND s.owner <> l.doc_id AS gone FROM lines l LEFT JOIN shared s ON l.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_MIX = r"""
WITH sized AS (SELECT doc_id, source, md5(text) AS print,
                      CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
placed AS (SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS weight FROM sources),
sums AS (SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total, CAST(sum(weight) OVER () AS BIGINT) AS weights,
         CAST(coalesce(sum(2 * source_size) OVER w, 0) AS BIGINT) AS stops, CAST(coalesce(sum(weight) OVER w, 0) AS BIGINT) AS before
         FROM placed WINDOW w AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT max((total * CAST(1.5 AS DOUBLE) - CAST(stops AS DOUBLE)) / CAST(weights - before AS DOUBLE)) AS l FROM sums),
targets AS (SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), CAST(weight AS DOUBLE) * l) AS target FROM sums, level),
budgets AS (SELECT *, CAST(floor(target + CAST(0.5 AS DOUBLE)) AS BIGINT) AS budget FROM targets),
epochs AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM budgets),
running AS (SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id, print
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM sized)
SELECT r.doc_id, r.size, e.source_size, e.target,
       CAST(e.epochs * r.size + greatest(0, least(r.size, e.budget - e.epochs * e.source_size - r.before)) AS BIGINT) AS taken
FROM running r JOIN epochs e ON r.source IS NOT DISTINCT FROM e.source
"""

_MANIFEST = r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, source, lang, n_chars, text,
         (list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
            lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]),
                                     lambda y, z: xor(y // 2, 3988292384 * (y % 2)))) % 4294967296) AS crc
  FROM documents),
leaves AS (
  SELECT doc_id, source, xor(crc, 4294967295) % 5 = 0 AS chosen,
         concat(CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END,
                CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END,
                CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END,
                CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END) AS head,
         CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END AS body,
         CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END AS lowered
  FROM fields),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS idx
  FROM (SELECT doc_id, source, sha256(head || body) AS leaf, sha256(head || CASE WHEN chosen THEN lowered ELSE body END) AS altered FROM leaves)),
lower AS (
  SELECT source, CAST(0 AS BIGINT) AS level, CAST(idx AS BIGINT) AS idx, leaf AS digest FROM ranked
  UNION ALL
  SELECT source, level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY source) AS nodes FROM lower) WHERE nodes > 1 GROUP BY source, level, idx // 16),
subroots AS (
  SELECT source, level AS height, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place
  FROM (SELECT * FROM lower QUALIFY level = max(level) OVER (PARTITION BY source))),
upper AS (
  SELECT CAST(0 AS BIGINT) AS level, CAST(place AS BIGINT) AS idx, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER () AS nodes FROM upper) WHERE nodes > 1 GROUP BY level, idx // 16),
runs AS (
  SELECT l.source, level, idx // 16 AS run, list(digest ORDER BY idx) AS held
  FROM lower l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source AND l.level < s.height GROUP BY ALL),
top_runs AS (
  SELECT level, idx // 16 AS run, list(digest ORDER BY idx) AS held
  FROM upper WHERE level < (SELECT max(level) FROM upper) GROUP BY ALL),
folded AS (
  SELECT doc_id, source, leaf, CAST(0 AS BIGINT) AS level, CAST(idx AS BIGINT) AS idx, altered AS digest, '' AS proof FROM ranked
  UNION ALL
  SELECT f.doc_id, f.source, f.leaf, f.level + 1, f.idx // 16,
         sha256(array_to_string(r.held[:f.idx % 16] || [f.digest] || r.held[f.idx % 16 + 2:], '')),
         f.proof || array_to_string(r.held[:f.idx % 16] || r.held[f.idx % 16 + 2:], '')
  FROM folded f JOIN runs r ON f.source IS NOT DISTINCT FROM r.source AND f.level = r.level AND f.idx // 16 = r.run),
through AS (
  SELECT f.doc_id, f.leaf, s.subroot, CAST(0 AS BIGINT) AS level, CAST(s.place AS BIGINT) AS idx, f.digest, f.proof
  FROM folded f JOIN subroots s ON f.source IS NOT DISTINCT FROM s.source AND f.level = s.height
  UNION ALL
  SELECT t.doc_id, t.leaf, t.subroot, t.level + 1, t.idx // 16,
         sha256(array_to_string(r.held[:t.idx % 16] || [t.digest] || r.held[t.idx % 16 + 2:], '')),
         t.proof || array_to_string(r.held[:t.idx % 16] || r.held[t.idx % 16 + 2:], '')
  FROM through t JOIN top_runs r ON t.level = r.level AND t.idx // 16 = r.run)
SELECT doc_id, leaf, subroot, top.digest AS root, sha256(proof) AS proof_sha256, t.digest AS folded_root, t.digest = top.digest AS verified
FROM through t JOIN (SELECT level, digest FROM upper QUALIFY level = max(level) OVER ()) top ON t.level = top.level
"""

_PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, unnest([w[i:i + k - 1] FOR i IN range(1, len(w) - k + 2)]) AS g
  FROM split, (SELECT unnest([1, 2, 3]) AS k)),
counts AS MATERIALIZED (SELECT lang, len(g) AS size, array_to_string(g, ' ') AS phrase, any_value(g) AS g, count(*) AS f FROM grams GROUP BY 1, 2, 3),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang),
often AS MATERIALIZED (SELECT * FROM counts WHERE f >= 10),
parts AS MATERIALIZED (
  SELECT lang, phrase, f AS a, k, array_to_string(g[:k], ' ') AS head, array_to_string(g[k + 1:], ' ') AS tail
  FROM often, (SELECT unnest([1, 2]) AS k) WHERE k < size),
cuts AS (
  SELECT o.lang, o.phrase, o.a, o.k, l.f AS l, r.f AS r,
         CAST((CAST(1000000 AS HUGEINT) * o.a * o.a) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM parts o JOIN often l ON l.lang = o.lang AND l.phrase = o.head JOIN often r ON r.lang = o.lang AND r.phrase = o.tail),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, inner_phrase AS phrase, max(f) AS f FROM (
    SELECT lang, f, unnest([array_to_string(g[:2], ' '), array_to_string(g[2:], ' ')]) AS inner_phrase FROM often WHERE size = 3) GROUP BY ALL),
kept AS (
  SELECT c.* FROM lowest c LEFT JOIN longer o ON o.lang = c.lang AND o.phrase = c.phrase WHERE o.f IS NULL OR 100 * o.f < 50 * c.a),
ranked AS (
  SELECT lang, phrase, a, l, r, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

_QUOTED = [(label, text.replace("'", "''")) for label, text in TEMPLATES]
_LICENSES = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
phrases AS (SELECT string_split(phrase, ' ') AS p, label FROM (VALUES %(phrases)s) AS v(phrase, label)),
words AS (SELECT doc_id, w, unnest(range(len(w))) AS i FROM split),
base AS (SELECT doc_id, i, label FROM words, phrases WHERE w[i + 1] = p[1] AND w[i + 1:i + len(p)] = p),
told AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list_sort(list(DISTINCT label)) AS own FROM base GROUP BY doc_id),
notices AS (
  SELECT template, label, regexp_extract_all(lower(text), '[0-9a-z]+') AS w FROM (VALUES %(templates)s) AS v(template, label, text)),
placed AS (SELECT template, label, len(w) AS size, i AS place, array_to_string(w[i + 1:i + %(gram)d], ' ') AS g
       FROM (SELECT *, unnest(range(len(w) - %(gram)d + 1)) AS i FROM notices)),
grams AS (SELECT doc_id, i AS pos, array_to_string(w[i + 1:i + %(gram)d], ' ') AS g FROM words WHERE i + %(gram)d <= len(w)),
lines AS (SELECT doc_id, template, label, size, pos - place AS diagonal, list(DISTINCT place) AS places FROM grams JOIN placed USING (g) GROUP BY ALL),
spans AS (
  SELECT a.doc_id, a.template, a.label, a.diagonal,
         len(list_distinct(flatten([[x + j FOR j IN range(%(gram)d)] FOR x IN flatten(list(b.places))]))) / CAST(a.size AS DOUBLE) AS covered,
         min(b.diagonal + list_min(b.places)) AS first
  FROM lines a JOIN lines b ON a.doc_id = b.doc_id AND a.template = b.template AND b.diagonal BETWEEN a.diagonal AND a.diagonal + %(apart)d
  GROUP BY a.doc_id, a.template, a.label, a.size, a.diagonal),
local AS (
  SELECT s.* FROM spans s WHERE NOT EXISTS (
    SELECT 1 FROM spans o WHERE o.doc_id = s.doc_id AND o.template = s.template AND o.diagonal BETWEEN s.diagonal - %(apart)d AND s.diagonal + %(apart)d
    AND (o.covered > s.covered OR o.covered = s.covered AND o.diagonal < s.diagonal))),
best AS (SELECT * FROM local QUALIFY covered = max(covered) OVER (PARTITION BY doc_id, first)),
votes AS (
  SELECT doc_id, coalesce(list(DISTINCT label) FILTER (WHERE covered >= %(covered)s), []) AS found, max(covered) AS covered FROM best GROUP BY doc_id)
SELECT s.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(own, ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(coalesce(own, []) || coalesce(found, []))), ',') AS labels,
       CASE WHEN n_base > 0 THEN CAST(1 AS DOUBLE) ELSE coalesce(covered, CAST(0 AS DOUBLE)) END AS score
FROM split s LEFT JOIN told t ON s.doc_id = t.doc_id LEFT JOIN votes v ON s.doc_id = v.doc_id
""" % {"phrases": ", ".join(f"('{p}', '{label}')" for p, label in PHRASES.items()), "gram": GRAM, "apart": APART, "covered": COVERED,
       "templates": ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(_QUOTED))}

SQL = {"op4_line_dedup": _LINES, "op7_mixing": _MIX, "op11_phrase_collocations": _PHRASES, "op12_merkle_manifest": _MANIFEST,
       "op13_license_scan": _LICENSES}

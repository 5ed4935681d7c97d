"""DuckDB SQL for the queries whose whole result SQL can express."""

from ledgerloom.llm.licenses import DICE, TEMPLATES

_WORDS = r"""CASE WHEN text IS NULL THEN [] ELSE list_filter(
  regexp_split_to_array({text}, '{split}'), lambda x: x <> '') END"""

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(text="text", split="[ \\t\\n\\v\\f\\r]+")} AS w FROM documents),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
win AS (SELECT doc_id, i, list_slice(w, i, i + 12) AS g FROM d, unnest(range(1, len(w) - 11)) AS t(i)),
earliest AS (SELECT g, min(doc_id) AS m FROM win GROUP BY g),
hit AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN earliest USING (g) WHERE m < doc_id),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
  FROM word ANTI JOIN hit USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

NEAR_DEDUP = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_WORDS.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')",
                                split="[ \t\n\v\f\r]+")} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN w ELSE list_slice(w, i, i + 3) END AS g
  FROM d, unnest(range(1, greatest(2, len(w) - 2))) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM common JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
  WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT doc_id, doc_id AS r FROM d UNION SELECT reach.doc_id, b FROM reach JOIN link ON r = a)
SELECT doc_id, any_value(coalesce(n, 0))::BIGINT AS n_shingles, min(r) AS component_id, min(r) = doc_id AS kept
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

_PLAIN = _WORDS.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')",
                       split="[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_PLAIN} AS w FROM documents),
b AS (SELECT item_id, {_PLAIN} AS w FROM benchmark),
g AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS g
  FROM b, unnest(range(1, greatest(2, len(w) - 8))) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT len(g) AS n FROM g),
win AS (SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS g FROM d, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)),
hit AS (SELECT doc_id, i, n, item_id FROM win JOIN g USING (g)),
covered AS (
  SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, covered.n IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_NOTICES = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in TEMPLATES)
_UNIT_WORDS = _PLAIN.replace("text", "unit")

LICENSES = f"""
WITH notice(license, text) AS (VALUES {_NOTICES}),
b AS (
  SELECT license, n, unnest(range(1, len(w))) AS i, w
  FROM (SELECT license, row_number() OVER () AS n, {_PLAIN} AS w FROM notice)),
bb AS (SELECT DISTINCT license, n, w[i] || ' ' || w[i + 1] AS g FROM b),
nb AS (SELECT license, n, count(*) AS b FROM bb GROUP BY ALL),
u AS (
  SELECT DISTINCT doc_id, unit FROM (
    SELECT doc_id, unnest(list_concat(regexp_split_to_array(text, '[\\n\\r]+'),
                                      regexp_split_to_array(text, '[\\n\\r]+|[.!?][ \\t]+'))) AS unit
    FROM documents WHERE text <> '')),
uw AS (SELECT doc_id, unit, {_UNIT_WORDS} AS w FROM u),
ub AS (SELECT DISTINCT doc_id, unit, w[i] || ' ' || w[i + 1] AS g FROM uw, unnest(range(1, len(w))) AS t(i)),
na AS (SELECT doc_id, unit, count(*) AS a FROM ub GROUP BY ALL),
c AS (SELECT doc_id, unit, license, n, count(*) AS c FROM ub JOIN bb USING (g) GROUP BY ALL),
dice AS (
  SELECT doc_id, license, max(2 * c / (a + b)) AS dice FROM c JOIN na USING (doc_id, unit) JOIN nb USING (license, n)
  WHERE 2 * c / (a + b) >= {DICE} GROUP BY ALL),
found AS (
  SELECT doc_id, count(*) AS n, string_agg(license, ',' ORDER BY license) AS l, max(dice) AS best FROM dice GROUP BY ALL)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_licenses, coalesce(l, '') AS licenses, best AS best_dice
FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL) LEFT JOIN found USING (doc_id)
"""

# One round: every part's nearest entry, then the entries' floored means.
_ASSIGN = """
a{r} AS (
  SELECT vec_id, part, min(far * 64 + e) % 64 AS e, min(far * 64 + e) // 64 AS far FROM (
    SELECT vec_id, part, e,
      list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS far
    FROM p JOIN c{r} c USING (part)) GROUP BY ALL)"""
_AVERAGE = """,
m{r} AS (
  SELECT part, e, i, sum(x[i]) AS s, count(*)::HUGEINT AS n FROM a{r} JOIN p USING (vec_id, part), unnest(range(1, len(x) + 1)) AS t(i)
  GROUP BY ALL),
f{r} AS (SELECT part, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS x FROM m{r} GROUP BY ALL),
c{n} AS (SELECT part, e, coalesce(f.x, c.x) AS x FROM c{r} c LEFT JOIN f{r} f USING (part, e))"""

VECTOR_CODES = f"""
WITH k AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT vec_id, part, list_slice(v, part * (len(v) // 16) + 1, (part + 1) * (len(v) // 16)) AS x
  FROM k, unnest(range(16)) AS t(part)),
c0 AS (SELECT part, e, x FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM k) USING (vec_id) WHERE e < 64),
{_ASSIGN.format(r=0)}{_AVERAGE.format(r=0, n=1)},
{_ASSIGN.format(r=1)}{_AVERAGE.format(r=1, n=2)},
{_ASSIGN.format(r=2)},
o AS (SELECT vec_id, string_agg(printf('%02x', e::INTEGER), '' ORDER BY part) AS code, sum(far)::BIGINT AS error FROM a2 GROUP BY vec_id),
l AS (SELECT label, sum(error)::BIGINT AS label_error FROM o JOIN k USING (vec_id) GROUP BY label),
b AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM c2)
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM o JOIN k USING (vec_id) JOIN l ON k.label IS NOT DISTINCT FROM l.label, b
"""

SOURCE_DIVERGENCE = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
t AS (SELECT lang, source, id, unnest(w) AS term FROM d),
v AS (SELECT lang, term, count(*) AS c FROM t GROUP BY ALL HAVING count(DISTINCT id) >= 10),
s AS (SELECT lang, count(*) AS v, sum(c) AS n FROM v GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM t SEMI JOIN v USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
n AS (SELECT lang, source, coalesce(sum(c.c), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (
  SELECT lang, source, term, coalesce(c.c, 0) AS c,
    1 + 1000000000::HUGEINT * (coalesce(c.c, 0) + 2) // (n.n + 2 * s.v)::HUGEINT AS p,
    1 + 1000000000::HUGEINT * (v.c + 2) // (s.n + 2 * s.v)::HUGEINT AS q
  FROM n JOIN s USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
pairs AS (
  SELECT lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE c > 0 AND p > q)
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts)
WHERE part = 'pair' OR rank <= 10
"""

LLM_SQL = {
    "op2_substring_dedup": SUBSTRING_DEDUP,
    "op6_minhash_near_dedup": NEAR_DEDUP,
    "op9_license_scan": LICENSES,
    "op10_benchmark_decontamination": DECONTAMINATION,
    "op12_dual_tree_codes": VECTOR_CODES,
    "op13_source_divergence": SOURCE_DIVERGENCE,
}

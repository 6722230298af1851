"""SQL with the same rows as the queries that SQL can express."""

_WORDS = r"list_filter(regexp_split_to_array({0}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p : p + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM w WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM s AS a JOIN s AS b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN n AS na ON na.doc_id = a.doc_id JOIN n AS nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))
),
r AS (SELECT doc_id AS d, doc_id AS r FROM documents UNION SELECT e.b, r.r FROM r JOIN e ON e.a = r.d),
c AS (SELECT d, min(r) AS component_id FROM r GROUP BY d)
SELECT documents.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, documents.doc_id = component_id AS kept
FROM documents JOIN c ON c.d = documents.doc_id LEFT JOIN n ON n.doc_id = documents.doc_id
"""

OP2 = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0
    AND len(list_filter(embedding, lambda y: y <> 0)) > 0
),
e AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.9
),
r AS (SELECT vec_id AS d, vec_id AS r FROM embeddings UNION SELECT e.b, r.r FROM r JOIN e ON e.a = r.d),
c AS (SELECT d, min(r) AS component_id FROM r GROUP BY d),
k AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT vec_id, coalesce(k.n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN c ON c.d = vec_id LEFT JOIN k ON k.a = vec_id
"""

_BIT = "(ascii(substr(bits, 5 * i + {0}, 1)) - 48) * {1}"

OP4 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, h, from_hex(sha1(h))::BIT::VARCHAR AS bits, max(page_id) OVER (PARTITION BY h) AS m FROM p)
SELECT page_id, strlen(h) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (1 + {" + ".join(_BIT.format(k + 1, 16 >> k) for k in range(5))})::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id < m THEN m END AS refers_to
FROM d
"""

OP10 = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, {_WORDS.format("t")} AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d
),
p AS (SELECT row, p, array_to_string(w[p : p + 4], ' ') AS s FROM (SELECT row, w, unnest(range(1, len(w) - 3)) AS p FROM w WHERE len(w) > 4)),
c AS (SELECT row, p FROM p QUALIFY count(*) OVER (PARTITION BY row, s) > 1),
r AS (SELECT row, count(DISTINCT q) AS n FROM (SELECT row, unnest(range(p, p + 5)) AS q FROM c) GROUP BY row),
m AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
    len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM w LEFT JOIN r USING (row)
),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 25 * n_words OR 2 * (n_lines - n_dup_lines) < n_lines
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM f
"""

OP11 = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  first_value(doc_id) OVER stays AS keep_id, row_number() OVER stays = 1 AS kept
FROM d WINDOW stays AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""

OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
o AS (SELECT row, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM o GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM o JOIN k USING (lang, term) GROUP BY ALL),
s AS (SELECT g.lang, g.source, term, coalesce(n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
a AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang, source) + v)::HUGEINT AS p FROM s JOIN v USING (lang)),
l AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term),
b AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang) + v)::HUGEINT AS q FROM l JOIN v USING (lang)),
pairs AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
  FROM a AS x JOIN a AS y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
r AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0) AS value
  FROM g AS x JOIN g AS y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN pairs ON pairs.lang = x.lang AND pairs.source = x.source AND pairs.item = y.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM a JOIN b USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM r QUALIFY part = 'pair' OR rank <= 200
"""

OP13 = """
WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list({'r': r, 'x': x} ORDER BY turn NULLS FIRST, sha256(length(r) || ':' || r || x)) AS l FROM t GROUP BY c),
z AS (SELECT c, l, c - c % 5 AS base, list_reduce([4294967295::BIGINT] || list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT),
  lambda a, b: list_reduce([xor(a, b)] || range(8), lambda m, k: CASE WHEN m % 2 = 1 THEN xor(m // 2, 3988292384) ELSE m // 2 END)) AS crc FROM o),
h AS (SELECT c, l, base, xor(crc, 4294967295) % 9 AS h FROM z),
w AS (SELECT h.c, coalesce(b.l[1 : h], []) || h.l[h + 1 :] AS l FROM h LEFT JOIN o AS b ON b.c = h.base),
m AS (SELECT c, d, l[1 : d] AS k, len(l) AS n FROM (SELECT c, l, unnest(range(len(l) + 1)) AS d FROM w)),
g AS (SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, max(n) AS longest,
  sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '')) AS ends FROM m GROUP BY k, d),
i AS (SELECT m.c, m.d, g.conv_id AS v, g.n_convs, g.longest, CASE WHEN m.d > 0 THEN strlen(m.k[m.d].x) ELSE 0 END AS b FROM m JOIN g ON g.k = m.k AND g.d = m.d),
u AS (SELECT DISTINCT a.v, a.d, e.v AS v2, e.d AS d2, e.n_convs, e.b, e.longest FROM i AS a JOIN i AS e ON e.c = a.c AND e.d >= a.d),
s AS (SELECT v, d, count(*) FILTER (d2 = d + 1) AS n_children, count(*) FILTER (longest = d2) AS n_leaves, sum((n_convs - 1) * b) AS saved FROM u GROUP BY v, d),
p AS (SELECT DISTINCT a.v, a.d, e.v AS parent FROM i AS a JOIN i AS e ON e.c = a.c AND e.d = a.d - 1)
SELECT g.conv_id, g.d::BIGINT AS depth, parent AS parent_conv_id, g.n_convs, n_children, n_leaves, saved::BIGINT AS saved_tokens, ends AS ends_sha256
FROM g JOIN s ON s.v = g.conv_id AND s.d = g.d LEFT JOIN p ON p.v = g.conv_id AND p.d = g.d
"""

SQL = {
    "op1_minhash_dedup": OP1, "op2_lattice_dedup": OP2, "op4_warc": OP4, "op10_quality_rules": OP10,
    "op11_exact_dedup": OP11, "op12_source_divergence": OP12, "op13_prefix_trie": OP13,
}

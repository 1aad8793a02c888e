"""DuckDB SQL of those training-data queries that SQL can express."""

ORACLE_SQL = {
    # huge integers keep the arithmetic exact
    "op11_source_divergence": r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
tokens AS (SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
per_doc AS (SELECT d, lang, source, term, count(*) AS n FROM tokens GROUP BY ALL),
kept AS (SELECT lang, term FROM per_doc GROUP BY lang, term HAVING count(*) >= 10),
held AS (SELECT lang, source, term, sum(n)::HUGEINT AS n FROM per_doc SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
totals AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM held GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(h.n, 0) + 2)) // (coalesce(t.total, 0) + 2 * s.v) AS p
  FROM groups g JOIN kept k USING (lang) JOIN sizes s USING (lang)
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term),
whole AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v) AS q
  FROM (SELECT lang, term, sum(n)::HUGEINT AS n FROM held GROUP BY ALL)
  JOIN (SELECT lang, sum(n)::HUGEINT AS total FROM held GROUP BY ALL) USING (lang) JOIN sizes USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, ((p - q) * (p - q)) // (p + q)
  FROM p JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
SELECT * FROM (
  SELECT lang, source, part, item, value::BIGINT AS value,
         row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM found)
WHERE part = 'pair' OR rank <= 10""",
    # every pair of a label, which SQL can afford on the small tables
    "op12_lattice_dedup": r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(b, vec_id)) AS kept
FROM embeddings LEFT JOIN counts c ON c.a = vec_id LEFT JOIN least l ON l.a = vec_id""",
    # crc32 byte by byte with its table made from the polynomial; near words share
    # a form with one letter (or none) left out; form_n is a double because that is
    # how pandas holds a long column with nulls
    "op13_spelling_variants": r"""
WITH RECURSIVE steps(i, c, k) AS (
  SELECT i, i::UBIGINT, 0 FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents),
counted AS (SELECT doc, run, count(*) AS n, hex(encode(doc || ':' || run)) AS hx FROM runs WHERE length(run) >= 6 GROUP BY doc, run),
checked AS (
  SELECT run, n, xor(4294967295::UBIGINT, list_reduce(
           list_transform(range(0, length(hx) // 2), lambda j: ('0x' || substr(hx, (2 * j + 1)::INT, 2))::UBIGINT),
           lambda s, x: xor(s >> 8, t[(xor(s, x) & 255)::INT + 1]), 4294967295::UBIGINT)) AS h
  FROM counted, crc),
forms AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM checked),
words AS (SELECT word, sum(n)::BIGINT AS n FROM forms WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (
  SELECT word, n, 0 AS gap, word AS rest FROM words
  UNION ALL SELECT word, n, j::INT, substr(word, 1, j::INT - 1) || substr(word, j::INT + 1)
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS j FROM words)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, a.n, b.n AS n_other FROM cut a JOIN cut b ON a.rest = b.rest AND a.word <> b.word
  WHERE (a.gap > 0 AND a.gap = b.gap) OR (a.gap = 0 AND b.gap > 0) OR (a.gap > 0 AND b.gap = 0)),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n_other DESC, other) AS other, max(n_other) AS n_other FROM near GROUP BY word),
named AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN n_other >= 5 * w.n THEN other END AS form,
         CASE WHEN n_other >= 5 * w.n THEN n_other::DOUBLE END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
chain(word, tip, k) AS (
  SELECT word, word, 0 FROM named UNION ALL SELECT c.word, f.form, k + 1 FROM chain c JOIN named f ON f.word = c.tip WHERE f.form IS NOT NULL)
SELECT n.word, n, n_near, form, form_n, root FROM named n JOIN (SELECT word, arg_max(tip, k) AS root FROM chain GROUP BY word) r ON r.word = n.word""",
}

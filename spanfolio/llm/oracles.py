"""SQL of the text queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LETTERS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SUFFIX = """WITH d AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s
        FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS i FROM d)),
later AS (SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
bytes AS (SELECT doc_id, unnest(range(0, length(h) // 2)) AS p, unnest(regexp_extract_all(h, '..')) AS b FROM d),
flagged AS (
    SELECT b.doc_id, b.p, b.b, l.i IS NOT NULL AND b.p < l.i + 100 AS gone
    FROM bytes b ASOF LEFT JOIN later l ON b.doc_id = l.doc_id AND b.p >= l.i),
runs AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), false) AS begins FROM flagged),
found AS (
    SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) FILTER (WHERE begins) AS n_spans,
           string_agg(b, '' ORDER BY p) FILTER (WHERE NOT gone) AS kept
    FROM runs GROUP BY doc_id)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN found USING (doc_id)"""

SUBSTRING = f"""WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 19], ' ') AS s
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d)),
later AS (SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
words AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS w FROM d),
found AS (
    SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, string_agg(w, ' ' ORDER BY p) FILTER (WHERE NOT gone) AS kept
    FROM (SELECT x.doc_id, x.p, x.w, l.i IS NOT NULL AND x.p < l.i + 20 AS gone
          FROM words x ASOF LEFT JOIN later l ON x.doc_id = l.doc_id AND x.p >= l.i) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN found USING (doc_id)"""

DECONTAMINATION = f"""WITH d AS (SELECT doc_id, {_LETTERS} AS ws FROM documents),
b AS (SELECT item_id, ws, least(10, len(ws)) AS n FROM (SELECT item_id, {_LETTERS} AS ws FROM benchmark) WHERE len(ws) > 0),
asked AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS s
          FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM b)),
win AS (SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS s
        FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM b))),
hit AS (SELECT doc_id, i, n, item_id FROM win JOIN asked USING (n, s)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM hit GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""

TRIE = r"""WITH c AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
         {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS t
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, conv_id - conv_id % 20 AS block, list(t ORDER BY pos) AS turns,
         xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::UBIGINT)),
             lambda a, x: list_reduce(list_prepend(xor(a, x), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
                 lambda v, z: xor(v >> 1, (v & 1) * 3988292384))), 4294967295::UBIGINT)::BIGINT % 4 AS h
  FROM c GROUP BY conv_id
), paths AS (
  SELECT o.conv_id, coalesce(list_slice(b.turns, 1, o.h), []) || coalesce(list_slice(o.turns, o.h + 1, len(o.turns)), []) AS turns
  FROM own o LEFT JOIN own b ON b.conv_id = o.block
), steps AS (
  SELECT conv_id, len(turns) AS n, unnest(range(0, len(turns) + 1)) AS depth, turns FROM paths
), members AS (
  SELECT conv_id, n, depth, list_slice(turns, 1, depth) AS node FROM steps
), nodes AS (
  SELECT node, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(n) = any_value(depth) AS leaf,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = depth), '') AS ends
  FROM members GROUP BY node
), valued AS (
  SELECT *, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(node[depth].text, '[^\x20\x09-\x0D]+')) END AS saved FROM nodes
), up AS (
  SELECT list_slice(node, 1, d) AS node, sum(CASE WHEN leaf THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens,
         count(*) FILTER (WHERE depth = d + 1) AS n_children
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM valued) GROUP BY 1
)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, u.n_children, CAST(u.n_leaves AS BIGINT) AS n_leaves,
       CAST(u.saved_tokens AS BIGINT) AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM valued v JOIN up u ON v.node = u.node LEFT JOIN valued p ON v.depth > 0 AND p.depth = v.depth - 1 AND p.node = list_slice(v.node, 1, v.depth - 1)"""

COLLOCATIONS = rf"""WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
ws AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM ws GROUP BY lang),
grams AS (SELECT lang, list_slice(w, i, i + k - 1) AS g
          FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM ws, (VALUES (1), (2), (3), (4)) t(k) WHERE len(w) >= k)),
f AS (SELECT lang, g, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
cuts AS (SELECT lang, g, f AS a, unnest(range(1, len(g))) AS k FROM f WHERE len(g) > 1),
scored AS (SELECT c.lang, c.g, c.a, c.k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a // (x.f + y.f))::BIGINT AS score
           FROM cuts c JOIN f x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, c.k)
                       JOIN f y ON y.lang = c.lang AND y.g = list_slice(c.g, c.k + 1, len(c.g))),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_parts AS (SELECT lang, f, list_slice(g, i, i + k - 1) AS g
    FROM (SELECT lang, f, g, k, unnest(range(1, len(g) - k + 2)) AS i FROM f, (VALUES (2), (3)) t(k) WHERE len(g) > k)),
held AS (SELECT lang, g, max(f) AS held FROM inner_parts GROUP BY ALL),
kept AS (SELECT b.*, array_to_string(b.g, ' ') AS phrase FROM best b LEFT JOIN held h ON h.lang = b.lang AND h.g = b.g
         WHERE h.held IS NULL OR 100 * h.held < 80 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000"""

ORACLES = {
    "op12_phrase_collocations": COLLOCATIONS,
    "op13_conversation_trie": TRIE,
    "op2_suffix_array_dedup": SUFFIX,
    "op3_benchmark_decontamination": DECONTAMINATION,
    "op9_substring_dedup": SUBSTRING,
}

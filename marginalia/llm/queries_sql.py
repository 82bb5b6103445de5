"""DuckDB SQL of the queries that SQL can express over whole tables."""

from __future__ import annotations

OP7 = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""

OP1 = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [ws]
             ELSE list_transform(range(1, len(ws) - 3), lambda i: list_slice(ws, i, i + 4)) END)) AS grams FROM w),
e AS (SELECT CASE WHEN len(grams) = 0 THEN [[doc_id::VARCHAR, '']] ELSE grams END AS k, min(doc_id) AS id, count(*) AS n_copies, len(any_value(grams)) AS size FROM s GROUP BY 1),
g AS (SELECT id, size, n_copies, unnest(k) AS gram FROM e WHERE size > 0),
c AS (SELECT a.id AS a, b.id AS b, any_value(b.n_copies) AS bc, count(*) AS n, any_value(a.size) AS sa, any_value(b.size) AS sb FROM g a JOIN g b ON a.gram = b.gram AND a.id <> b.id GROUP BY 1, 2),
l AS (SELECT a, b, bc FROM c WHERE 9 * n >= 4 * (sa + sb)),
r(id, root) AS (SELECT id, id FROM e UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id),
m AS (SELECT id, min(root) AS class_id FROM r GROUP BY id),
t AS (SELECT a AS id, count(*) AS n_links, sum(bc) AS d FROM l GROUP BY a)
SELECT s.doc_id, m.class_id, e.id AS text_class_id, e.n_copies, coalesce(t.n_links, 0)::BIGINT AS n_links, (coalesce(t.d, 0) + e.n_copies - 1)::BIGINT AS n_linked_docs, s.doc_id = m.class_id AS kept
FROM s JOIN e ON e.k = CASE WHEN len(s.grams) = 0 THEN [[s.doc_id::VARCHAR, '']] ELSE s.grams END JOIN m USING (id) LEFT JOIN t USING (id)
"""

OP3 = r"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM conversations),
r AS (SELECT conv_id, pos, role, text, '<|im_start|>' || replace(replace(replace(role, chr(10), ' '), '<\', '<\\'), '<|', '<\|') || chr(10) || replace(replace(text, '<\', '<\\'), '<|', '<\|') || '<|im_end|>' || chr(10) AS one FROM t),
p AS (SELECT conv_id, pos, max(pos) OVER (PARTITION BY conv_id) AS n,
             list({'role': role, 'text': text}) OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM r),
w AS (SELECT upto, n, min(conv_id) AS conv_id, count(*) AS n_copies FROM p WHERE pos = n GROUP BY upto, n),
k AS (SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.pos < p.n AND p.upto = w.upto))
SELECT k.conv_id, k.n AS n_turns, k.n_copies, string_agg(r.one, '' ORDER BY r.pos) AS chat FROM k JOIN r ON r.conv_id = k.conv_id GROUP BY k.conv_id, k.n, k.n_copies
"""

FEATURES = r"""
t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM {docs}),
w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
g AS (SELECT doc_id, i, list_slice(ws, i, i + 7) AS gram FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM r) GROUP BY doc_id),
f AS (SELECT w.doc_id, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(c.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN c USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f),
h AS (SELECT source AS host, count(*)::DOUBLE AS d, sum(base_failed::INT)::DOUBLE AS x FROM b WHERE source IS NOT NULL GROUP BY source),
s AS (SELECT sum(d) AS n, sum(x) / sum(d) AS m, count(*)::DOUBLE AS h, sum(x * x / d) AS q FROM h),
v AS (SELECT n, m, q / n - m * m - m * (1 - m) * h / n AS spread FROM s),
k AS (SELECT m, CASE WHEN m <= 0 OR m >= 1 THEN 1 WHEN spread <= 0 THEN 1e6 ELSE greatest(1, least(1e6, m * (1 - m) / spread - 1)) END AS k FROM v),
hr AS (SELECT host, (x + m * k) / (d + k) AS rate, d + k AS w FROM h, k),
hv AS (SELECT host, rate - 1.645 * sqrt(rate * (1 - rate) / (w + 1)) > 0.5 AS rejected FROM hr),
quality AS (SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(rejected, false) AS kept
            FROM b LEFT JOIN hv ON b.source = hv.host)
"""

OP12 = r"""
WITH t AS (SELECT coalesce(master_id, client_id) AS c, client_id, updated_at AS u, nation_id, balance,
    CASE source WHEN 'crm' THEN 0 WHEN 'web' THEN 1 WHEN 'store' THEN 2 WHEN 'partner' THEN 3 ELSE 4 END AS trust,
    CASE WHEN regexp_matches(name, '[^\x20\x09-\x0D]') THEN name END AS name, CASE WHEN regexp_matches(email, '[^\x20\x09-\x0D]') THEN email END AS email,
    CASE WHEN regexp_matches(city, '[^\x20\x09-\x0D]') THEN city END AS city, CASE WHEN regexp_matches(segment, '[^\x20\x09-\x0D]') THEN segment END AS segment FROM clients),
r AS (SELECT *, u IS NULL OR max(u) OVER (PARTITION BY c) - u > INTERVAL 1440 HOUR AS stale, (city IS NOT NULL)::INT + (nation_id IS NOT NULL)::INT AS filled FROM t),
n AS (SELECT c, count(*) AS n_records, count(*) FILTER (WHERE stale) AS n_stale FROM r GROUP BY c),
s AS (SELECT c, segment, client_id AS segment_from FROM r WHERE segment IS NOT NULL QUALIFY row_number() OVER (PARTITION BY c ORDER BY u DESC NULLS LAST, trust, client_id) = 1),
e AS (SELECT c, email, client_id AS email_from FROM r WHERE email IS NOT NULL QUALIFY row_number() OVER (PARTITION BY c ORDER BY stale, trust, u DESC NULLS LAST, client_id) = 1),
m AS (SELECT c, name, client_id AS name_from FROM r WHERE name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY c ORDER BY length(name) DESC, stale, trust, u DESC NULLS LAST, client_id) = 1),
a AS (SELECT c, city, nation_id, CASE WHEN filled > 0 THEN client_id END AS address_from FROM r QUALIFY row_number() OVER (PARTITION BY c ORDER BY filled DESC, stale, trust, u DESC NULLS LAST, client_id) = 1),
b AS (SELECT r.c, balance, client_id AS balance_from FROM r LEFT JOIN s ON s.c = r.c WHERE balance IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY r.c ORDER BY r.segment IS DISTINCT FROM s.segment AND s.segment IS NOT NULL, u DESC NULLS LAST, trust, client_id) = 1)
SELECT n.c AS cluster_id, n_records, n_stale, name, email, segment, city, nation_id, floor(100 * balance + 0.5)::BIGINT AS balance_cents, name_from, email_from, segment_from, balance_from, address_from
FROM n LEFT JOIN s ON s.c = n.c LEFT JOIN e ON e.c = n.c LEFT JOIN m ON m.c = n.c LEFT JOIN a ON a.c = n.c LEFT JOIN b ON b.c = n.c
"""

OP13 = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [ws]
             ELSE list_transform(range(1, len(ws) - 2), lambda i: list_slice(ws, i, i + 3)) END)) AS grams FROM w),
e AS (SELECT CASE WHEN len(grams) = 0 THEN [[doc_id::VARCHAR, '']] ELSE grams END AS k, min(doc_id) AS id, len(any_value(grams)) AS size FROM s GROUP BY 1),
g AS (SELECT id, size, unnest(k) AS gram FROM e WHERE size > 0),
c AS (SELECT a.id AS a, b.id AS b, count(*) AS n, any_value(a.size) AS sa, any_value(b.size) AS sb FROM g a JOIN g b ON a.gram = b.gram AND a.id <> b.id GROUP BY 1, 2),
l AS (SELECT a, b FROM c WHERE 100 * n >= 80 * (sa + sb - n)),
r(id, root) AS (SELECT id, id FROM e UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id),
m AS (SELECT id, min(root) AS component_id FROM r GROUP BY id)
SELECT s.doc_id, len(s.grams)::BIGINT AS n_shingles, m.component_id, s.doc_id = m.component_id AS kept
FROM s JOIN e ON e.k = CASE WHEN len(s.grams) = 0 THEN [[s.doc_id::VARCHAR, '']] ELSE s.grams END JOIN m USING (id)
"""

SQL = {
    "op1_ngram_jaccard": OP1,
    "op3_chat_formatting": OP3,
    "op7_exact_dedup": OP7,
    "op9_quality_rules": "WITH " + FEATURES.replace("{docs}", "documents") + " SELECT * FROM quality",
    "op12_golden_record": OP12,
    "op13_minhash_dedup": OP13,
}

"""DuckDB SQL for the corpus queries whose rows SQL can give."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP3 = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
n AS (SELECT doc_id, octet_length(b) AS n, lower(hex(b)) AS h FROM d),
w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 100)) AS w FROM n, unnest(range(n - 49)) AS t(i)),
m AS (SELECT w, min(doc_id) AS first_id FROM w GROUP BY w),
hit AS (SELECT doc_id, i FROM w JOIN m USING (w) WHERE first_id < doc_id),
ends AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next_i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS last_i FROM hit),
marks AS (SELECT doc_id, i, coalesce(least(next_i, i + 50), i + 50) AS upto, last_i IS NULL OR last_i + 50 < i AS opens FROM ends),
gone AS (SELECT doc_id, sum(upto - i)::BIGINT AS n_removed, sum(opens::INT)::BIGINT AS n_spans FROM marks GROUP BY doc_id),
cover AS (SELECT doc_id, unnest(range(i, upto)) AS i FROM marks),
left_over AS (SELECT n.doc_id, string_agg(substr(h, 2 * t.i + 1, 2), '' ORDER BY t.i) AS kept FROM n, unnest(range(n)) AS t(i)
  ANTI JOIN cover c ON c.doc_id = n.doc_id AND c.i = t.i GROUP BY n.doc_id)
SELECT n.doc_id, n.n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM n LEFT JOIN gone USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""

OP8 = f"""
WITH d AS (SELECT doc_id, {WORDS} AS a FROM documents),
w AS (SELECT doc_id, i, md5(array_to_string(a[i + 1 : i + 13], ' ')) AS w FROM d, unnest(range(len(a) - 12)) AS t(i)),
m AS (SELECT w, min(doc_id) AS first_id FROM w GROUP BY w),
hit AS (SELECT DISTINCT doc_id, i + j AS i FROM w JOIN m USING (w), unnest(range(13)) AS t(j) WHERE first_id < doc_id),
gone AS (SELECT doc_id, count(*) AS n_removed FROM hit GROUP BY doc_id),
left_over AS (SELECT d.doc_id, string_agg(a[t.i + 1], ' ' ORDER BY t.i) AS kept FROM d, unnest(range(len(a))) AS t(i)
  ANTI JOIN hit h ON h.doc_id = d.doc_id AND h.i = t.i GROUP BY d.doc_id)
SELECT d.doc_id, len(a)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""

FOLDED = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP10 = f"""
WITH d AS (SELECT doc_id, {FOLDED} AS a FROM documents),
b AS (SELECT item_id, {FOLDED} AS a FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(a), 10) AS n, array_to_string(a[i + 1 : i + least(len(a), 10)], ' ') AS w FROM b, unnest(range(greatest(len(a) - 9, least(len(a), 1)))) AS t(i)),
dw AS (SELECT doc_id, i, k.n, array_to_string(a[i + 1 : i + k.n], ' ') AS w FROM d, (SELECT DISTINCT n FROM bw) AS k, unnest(range(len(a) - k.n + 1)) AS t(i)),
hit AS (SELECT doc_id, item_id, i, n FROM dw JOIN bw USING (n, w)),
places AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM hit, unnest(range(n)) AS t(j) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(a)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""

BASE32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(h, {5 * i + 1}, 5))::INT >> {b}) & 31) + 1, 1)" for i in range(8) for b in (15, 10, 5, 0))

OP4 = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS h, coalesce(html, '') AS html FROM pages),
t AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, {BASE32} AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id < top THEN top END AS refers_to
FROM t
"""

OP9 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS} AS a FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(a[i + 1 : i + least(len(a), 5)], ' ') AS g FROM d, unnest(range(greatest(len(a) - 4, least(len(a), 1)))) AS t(i)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS u, y.doc_id AS v, count(*) AS i FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT u, v FROM p JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 9 * i >= 4 * (a.n + b.n)),
r AS (SELECT u, v FROM l UNION SELECT r.u, l.v FROM r JOIN l ON r.v = l.u),
c AS (SELECT u, min(v) AS low FROM r GROUP BY u),
k AS (SELECT u, count(*) AS n_links FROM l GROUP BY u)
SELECT doc_id, coalesce(least(doc_id, low), doc_id) AS class_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM documents LEFT JOIN c ON c.u = doc_id LEFT JOIN k ON k.u = doc_id
"""

#: crc32 of decimal digits, bit by bit: DuckDB has none.
_BYTE = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
CRC = f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ord(s)::BIGINT)), lambda c, b: {_BYTE}), 4294967295)"

OP11 = f"""
WITH RECURSIVE t AS (SELECT conv_id, md5(md5(coalesce(role, '')) || md5(coalesce(text, ''))) AS k, length(coalesce(text, '')) AS size,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(coalesce(role, '')), md5(coalesce(text, ''))) - 1 AS pos FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {CRC} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS own, pos, k, size FROM c JOIN t ON t.conv_id = base WHERE pos < h UNION ALL SELECT conv_id, 1, pos, k, size FROM c JOIN t USING (conv_id) WHERE pos >= h),
n AS (SELECT conv_id, k, size, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS depth FROM r),
p AS (SELECT conv_id, depth, size, md5(string_agg(k, '' ORDER BY depth) OVER (PARTITION BY conv_id ORDER BY depth)) AS key FROM n UNION ALL SELECT conv_id, 0, 0, 'root' FROM c),
q AS (SELECT *, lag(key) OVER (PARTITION BY conv_id ORDER BY depth) AS up, max(depth) OVER (PARTITION BY conv_id) AS last FROM p),
v AS (SELECT key, depth, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size, max(last) = depth AS leaf,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE last = depth), '')) AS ends_sha256 FROM q GROUP BY key, depth),
u AS (SELECT key AS top, key FROM v UNION ALL SELECT top, v.key FROM u JOIN v ON v.up = u.key),
s AS (SELECT top, sum(leaf::INT)::BIGINT AS n_leaves, sum((n_convs - 1) * size)::BIGINT AS saved_tokens FROM u JOIN v USING (key) GROUP BY top),
k AS (SELECT up, count(*) AS n_children FROM v GROUP BY up)
SELECT v.conv_id, v.depth, w.conv_id AS parent_conv_id, v.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, v.ends_sha256
FROM v JOIN s ON s.top = v.key LEFT JOIN v w ON w.key = v.up LEFT JOIN k ON k.up = v.key
"""

OP13 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS g FROM documents),
h AS (SELECT *, len(u) AS n, ('0x' || substr(g, 1, 8))::BIGINT AS h1, ('0x' || substr(g, 9, 8))::BIGINT AS h2, ('0x' || substr(g, 17, 8))::BIGINT AS h3, ('0x' || substr(g, 25, 8))::BIGINT AS h4 FROM d),
f AS (SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
  least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM h),
c AS (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m, coalesce(array_to_string(u[b + 1:], ''), '') AS s FROM f)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM c
"""

ALL = {"op11_prefix_trie": OP11, "op13_fill_in_middle": OP13, "op9_jaccard_join": OP9, "op4_warc": OP4, "op10_decontaminate": OP10, "op3_suffix_dedup": OP3, "op8_substring_dedup": OP8}

"""The results of the operators that SQL can express, for an engine that knows nothing of this package."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACE_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
PLAIN_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SUBSTRING_DEDUP = f"""WITH d AS (SELECT doc_id, {SPACE_WORDS} AS w FROM documents),
wins AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d WHERE len(w) >= 50)),
own AS (SELECT h, min(doc_id) AS o FROM wins GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS q FROM wins JOIN own USING (h) WHERE o < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS q FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY q) AS t FROM words ANTI JOIN gone USING (doc_id, q) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"""

DECONTAMINATION = f"""WITH d AS (SELECT doc_id, {PLAIN_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {PLAIN_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT item, n, w[p:p + n - 1] AS win FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, p, n, w[p:p + n - 1] AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT DISTINCT doc_id, p, n, item FROM dw JOIN bw USING (n, win)),
cov AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)"""

JACCARD_JOIN = f"""WITH RECURSIVE t AS (SELECT text, min(doc_id) AS id, count(*) AS n_copies, {SPACE_WORDS} AS w FROM documents GROUP BY text),
sh AS (SELECT DISTINCT id, CASE WHEN len(w) >= 5 THEN array_to_string(w[p:p + 4], ' ') ELSE len(w) || ':' || array_to_string(w, ' ') END AS s FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM t WHERE len(w) > 0)),
size AS (SELECT id, count(*) AS n FROM sh GROUP BY id),
pairs AS (SELECT a.id AS a, b.id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.id < b.id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM pairs JOIN size x ON x.id = a JOIN size y ON y.id = b WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9),
linked AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM linked UNION SELECT reach.a, linked.b FROM reach JOIN linked ON reach.b = linked.a)
SELECT doc_id, least(t.id, coalesce((SELECT min(b) FROM reach WHERE a = t.id), t.id)) AS class_id, (SELECT count(*) FROM linked WHERE a = t.id) AS n_links, t.id AS text_id, t.n_copies
FROM documents JOIN t ON t.text = documents.text"""

# The checksum of a list of bytes, by its table of 256 values.
CRC_TABLE = "SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i], range(8)), lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(i))"


def crc32_of(codes: str) -> str:
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295)"


# Latin-1 letters are two bytes each.
RUN_CODES = "flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [195, CAST(unicode(x) AS BIGINT) - 64] END))"

SPELLING_VARIANTS = f"""WITH RECURSIVE crc AS ({CRC_TABLE}),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[a-zÀ-ÿ]+')) AS r FROM documents),
per AS (SELECT doc_id, r, count(*) AS n FROM runs WHERE length(r) >= 6 GROUP BY ALL),
hashed AS (SELECT r, n, {crc32_of(RUN_CODES)} AS h FROM per, crc),
v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word, n FROM hashed) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
d AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
pairs AS (SELECT x.word AS a, y.word AS b FROM d x JOIN d y USING (i, rest) WHERE x.word != y.word UNION SELECT d.word, v.word FROM d JOIN v ON v.word = d.rest UNION SELECT v.word, d.word FROM d JOIN v ON v.word = d.rest),
ranked AS (SELECT a, b, v.n AS b_n, count(*) OVER (PARTITION BY a) AS n_near, row_number() OVER (PARTITION BY a ORDER BY v.n DESC, b) AS k FROM pairs JOIN v ON v.word = b),
f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN b_n >= 5 * v.n THEN b END AS form, CASE WHEN b_n >= 5 * v.n THEN b_n END AS form_n FROM v LEFT JOIN ranked ON a = v.word AND k = 1),
steps(word, here, k) AS (SELECT word, word, 0 FROM f UNION ALL SELECT steps.word, f.form, k + 1 FROM steps JOIN f ON f.word = steps.here WHERE f.form IS NOT NULL)
SELECT f.word, form, arg_max(steps.here, k) AS root, any_value(f.n) AS n, CAST(any_value(n_near) AS BIGINT) AS n_near, any_value(form_n) AS form_n FROM f JOIN steps USING (word) GROUP BY f.word, form"""

CONV_CODES = "list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(unicode(x) AS BIGINT))"

PREFIX_TRIE = f"""WITH crc AS ({CRC_TABLE}),
o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, n, conv_id - conv_id % 5 AS base, {crc32_of(CONV_CODES)} % 9 AS h FROM (SELECT conv_id, count(*) AS n FROM o GROUP BY conv_id), crc),
rebuilt AS (SELECT c.conv_id, p, r, x FROM c JOIN o ON o.conv_id = c.base WHERE p <= h UNION ALL SELECT o.conv_id, 9 + p, r, x FROM c JOIN o USING (conv_id) WHERE p > h),
l AS (SELECT c.conv_id, coalesce(any_value(t), []) AS t FROM c LEFT JOIN (SELECT conv_id, list(struct_pack(r := r, x := x) ORDER BY p) AS t FROM rebuilt GROUP BY conv_id) USING (conv_id) GROUP BY c.conv_id),
prefixes AS (SELECT conv_id, len(t) AS n, d, t[:d] AS seq FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS d FROM l)),
node AS MATERIALIZED (SELECT d, seq, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '') AS ends FROM prefixes GROUP BY d, seq),
under AS (SELECT conv_id AS below, d AS below_d, n_convs, octet_length(encode(seq[d].x)) AS bytes, seq[:u] AS seq, u FROM (SELECT *, unnest(range(0, d + 1)) AS u FROM node)),
leaf AS (SELECT n.conv_id, n.d FROM node n ANTI JOIN (SELECT d - 1 AS d, seq[:d - 1] AS seq FROM node WHERE d > 0) k ON k.d = n.d AND k.seq = n.seq),
folded AS (SELECT u AS d, seq, sum(CASE WHEN below_d > 0 THEN (n_convs - 1) * bytes ELSE 0 END) AS saved, count(leaf.conv_id) AS n_leaves, count(*) FILTER (below_d = u + 1) AS n_children FROM under LEFT JOIN leaf ON leaf.conv_id = below AND leaf.d = below_d GROUP BY u, seq)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM node n JOIN folded f ON f.d = n.d AND f.seq = n.seq LEFT JOIN node p ON p.d = n.d - 1 AND p.seq = n.seq[:n.d - 1]"""

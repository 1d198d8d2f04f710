"""DuckDB SQL of the queries that SQL can express, over whole tables and texts."""

from __future__ import annotations

_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _words(text: str) -> str:
    """The list of a text's words."""
    return f"list_filter(string_split(translate({text}, {_SPACE.replace('chr(32) || ', '')}, repeat(' ', 5)), ' '), lambda x: x <> '')"


#: Base 32 of a SHA-1 in hex: every five bits lie in two neighbouring digits.
_BASE32 = """array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + ((((instr('0123456789abcdef', substr(x, (5 * i) // 4 + 1, 1)) - 1) * 16 + greatest(instr('0123456789abcdef', substr(x || '0', (5 * i) // 4 + 2, 1)) - 1, 0)) >> (3 - (5 * i) % 4)) & 31)::INT, 1)), '')"""

#: Of bytes: the checksum's table, and the unsigned CRC-32 of every string k of a table ``{strings}`` as ``crc`` (k, c).
_CRC = """
b AS (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) t(i)),
y AS (SELECT k, i, (instr('0123456789ABCDEF', substr(x, 2 * i + 1, 1)) - 1) * 16 + instr('0123456789ABCDEF', substr(x, 2 * i + 2, 1)) - 1 AS byte FROM (SELECT k, hex(encode(k)) AS x, unnest(range(0, strlen(k))) AS i FROM {strings})),
z AS (SELECT k, 0 AS i, 4294967295 AS a FROM {strings} UNION ALL SELECT z.k, z.i + 1, xor(a >> 8, b.v) FROM z JOIN y ON y.k = z.k AND y.i = z.i JOIN b ON b.i = xor(a & 255, y.byte)),
crc AS (SELECT k, xor(arg_max(a, i), 4294967295) AS c FROM z GROUP BY k)"""

ORACLE_SQL = {
    "op4_remove_repeats": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_words("coalesce(text, '')")} AS ws FROM documents),
p AS (SELECT r, doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i, len(ws) AS n FROM d),
s AS (SELECT r, doc_id, i, md5(array_to_string(ws[i : i + 49], ' ')) AS h FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d WHERE len(ws) >= 50)),
f AS (SELECT h, min(doc_id) AS low FROM s GROUP BY h),
g AS (SELECT r, i FROM s JOIN f USING (h) WHERE low < doc_id),
m AS (SELECT p.*, max(CASE WHEN g.i IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY p.r ORDER BY p.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM p LEFT JOIN g ON p.r = g.r AND p.i = g.i),
k AS (SELECT r, CAST(sum(gone) AS BIGINT) AS n_removed, sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0), '')) AS kept_sha256 FROM m GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, coalesce(kept_sha256, sha256('')) AS kept_sha256 FROM d LEFT JOIN k USING (r)""",
    "op8_capture_index": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, h, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first = page_id THEN NULL ELSE first END AS refers_to FROM q""",
    "op9_dedup_lines": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (SELECT r, i, line, translate(trim(line, {_SPACE}), {_LOWER}) AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
s AS (SELECT r, string_agg(line, chr(10) ORDER BY i) AS kept, count(*) AS n FROM k WHERE key NOT IN (SELECT key FROM f) GROUP BY r)
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - coalesce(n, 0) AS BIGINT) AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (r)""",
    "op10_jaccard_groups": f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {_words(f"translate(coalesce(text, ''), {_LOWER})")} AS ws FROM documents),
s AS MATERIALIZED (SELECT DISTINCT r, md5_number_lower(unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END)) AS h FROM d),
n AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
c AS (SELECT a.r AS a, b.r AS b, count(*) AS shared FROM s a JOIN s b ON a.h = b.h AND a.r < b.r GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM c JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * shared >= 90 * (x.n + y.n - shared)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
w AS (SELECT DISTINCT a AS r, a AS m FROM e UNION SELECT w.r, e.b FROM w JOIN e ON w.m = e.a),
g AS (SELECT w.r, min(doc_id) AS low FROM w JOIN d ON d.r = w.m GROUP BY w.r)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(low, doc_id) AS component_id FROM d LEFT JOIN n USING (r) LEFT JOIN g USING (r)""",
    "op11_resample": f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
e AS MATERIALIZED (SELECT regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
f AS MATERIALIZED (SELECT r, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS k FROM d),
g AS MATERIALIZED (SELECT unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) AS k FROM e),
u AS MATERIALIZED (SELECT k FROM f UNION SELECT k FROM g),{_CRC.format(strings="u")},
h AS MATERIALIZED (SELECT k, c % 10000 AS bucket FROM crc),
s AS (SELECT bucket, count(*) AS n FROM f JOIN h USING (k) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM g JOIN h USING (k) GROUP BY bucket),
w AS (SELECT range AS bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain FROM range(10000) LEFT JOIN s ON s.bucket = range LEFT JOIN t ON t.bucket = range),
m AS (SELECT r, count(*) AS n_features, floor(sum(gain) / count(*))::BIGINT AS weight FROM f JOIN h USING (k) JOIN w USING (bucket) GROUP BY r),
o AS (SELECT r, doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, ('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT AS h FROM d LEFT JOIN m USING (r)),
p AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM o),
q AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM p WHERE n_words >= 20)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN place <= (SELECT 25 * count(*) // 100 FROM q) THEN place END AS rank FROM p LEFT JOIN q USING (r)""",
    "op12_spelling_variants": f"""
WITH RECURSIVE r AS MATERIALIZED (SELECT doc_id || ':' || run AS k, run FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[A-Za-zÀ-ÿ]+')) AS run FROM documents)),
u AS MATERIALIZED (SELECT DISTINCT k FROM r),{_CRC.format(strings="u")},
o AS (SELECT CASE WHEN c % 97 = 0 THEN substr(run, 1, c % length(run)) || substr(run, c % length(run) + 2) ELSE run END AS word FROM r JOIN crc USING (k)),
v AS MATERIALIZED (SELECT word, count(*) AS n FROM o WHERE length(word) >= 5 GROUP BY word HAVING count(*) >= 3),
p AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || '_' || substr(word, i + 1) AS masked, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
e AS (SELECT a.word, b.word AS near, b.n AS near_n FROM p a JOIN p b ON a.masked = b.masked AND a.i = b.i AND a.word <> b.word
  UNION SELECT p.word, v.word, v.n FROM p JOIN v ON v.word = p.cut UNION SELECT v.word, p.word, p.n FROM p JOIN v ON v.word = p.cut),
g AS (SELECT word, count(*) AS n_near, max(near_n) AS most FROM e GROUP BY word),
f AS MATERIALIZED (SELECT v.word, v.n, n_near, CASE WHEN most >= 2 * v.n THEN most END AS form_n, (SELECT min(encode(near)) FROM e WHERE e.word = v.word AND near_n = most AND most >= 2 * v.n) AS form FROM v LEFT JOIN g USING (word)),
t AS (SELECT word, word AS root, 0 AS i FROM f UNION ALL SELECT t.word, decode(f.form), i + 1 FROM t JOIN f ON f.word = t.root WHERE f.form IS NOT NULL),
x AS (SELECT word, arg_max(root, i) AS root FROM t GROUP BY word)
SELECT word, decode(form) AS form, root, n, coalesce(n_near, 0) AS n_near, form_n FROM f JOIN x USING (word)""",
}

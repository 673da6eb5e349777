"""Check SQL (for DuckDB) of the queries that SQL can express."""

from __future__ import annotations

# The text of a document as an array of words; ASCII blanks part them.
_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

_KDTREE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 20 = 0),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank
  FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""

_ARCHIVES = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (
  SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS h,
    min(page_id) OVER (PARTITION BY sha256(b), octet_length(b)) AS first
  FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS INT) >> (15 - 5 * (i % 4))) & 31 AS INT) + 1, 1)), '')
    AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d"""

_FMINDEX = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s AS (
  SELECT doc_id, i, w[i:i + 12] AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM s),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM f, range(13) t(k) WHERE first < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id"""

# Bytes as hexadecimal digits, two each.
_SUFFIXES = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
s AS (
  SELECT doc_id, i, substr(x, 2 * i + 1, 100) AS s
  FROM (SELECT doc_id, x, unnest(range(length(x) // 2 - 49)) AS i FROM d WHERE length(x) >= 100)),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS first FROM s),
g AS (
  SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS opens
  FROM f WHERE first < doc_id),
n AS (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM g),
r AS (SELECT doc_id, k, min(i) AS a, max(i) + 50 AS b FROM n GROUP BY ALL),
c AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM r),
t AS (
  SELECT d.doc_id, any_value(x) AS x, count(a) AS n_spans, coalesce(sum(b - a), 0) AS n_removed,
    coalesce(string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a), '') AS front,
    coalesce(max(b), 0) AS last
  FROM d LEFT JOIN c ON d.doc_id = c.doc_id GROUP BY d.doc_id)
SELECT doc_id, length(x) // 2 AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, n_spans,
  sha256(unhex(front || substr(x, 2 * last + 1))) AS kept_sha256
FROM t"""


def _threshold(rounds: int = 5) -> str:
    """Every vector against every centroid; whole numbers below 2^53, so doubles are exact."""
    parts = [
        """v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h, e) - 1 AS INT) AS c, e
  FROM (SELECT e, sha256('2:' || vec_id) AS h FROM v WHERE vec_id IS NOT NULL ORDER BY h, e LIMIT 40))""",
    ]
    nearest = """(
  SELECT r, min(struct_pack(d := list_inner_product(v.e, v.e) - 2 * list_inner_product(v.e, c.e)
    + list_inner_product(c.e, c.e), c := c.c)) AS m
  FROM v, c{n} c GROUP BY r)"""
    for n in range(rounds):
        parts.append(f"a{n} AS MATERIALIZED " + nearest.format(n=n))
        parts.append(
            f"""s{n} AS (
  SELECT m.c AS c, i, sum(CAST(e[i] AS HUGEINT)) AS s, count(*) AS n
  FROM a{n} JOIN v USING (r), range(1, 65) t(i) GROUP BY ALL),
m{n} AS (
  SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY i) AS e FROM s{n} GROUP BY c),
c{n + 1} AS MATERIALIZED (SELECT c{n}.c, coalesce(m{n}.e, c{n}.e) AS e FROM c{n} LEFT JOIN m{n} USING (c))"""
        )
    parts.append("a AS MATERIALIZED " + nearest.format(n=rounds))
    return f"""
WITH {", ".join(parts)}
SELECT vec_id, m.c AS cluster, CAST(m.d AS BIGINT) AS distance,
  CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia, CAST(sum(m.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(c.e, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM a JOIN v USING (r) JOIN c{rounds} c ON c.c = a.m.c"""


# CRC-32 of every distinct run of words, byte by byte with the polynomial's table.
_CRC_TABLE = """(SELECT list(list_reduce([i] || range(8), lambda c, k:
  CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) FROM range(256) r(i))"""
_IMPORTANCE = f"""
WITH crc AS MATERIALIZED (SELECT {_CRC_TABLE} AS t),
x AS (
  SELECT row_number() OVER () AS r, TRUE AS ours, doc_id, text FROM documents
  UNION ALL SELECT NULL, FALSE, NULL, text FROM benchmark),
w AS MATERIALIZED (
  SELECT r, ours, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM x),
f AS MATERIALIZED (
  SELECT r, ours, f, count(*) AS n FROM (
    SELECT r, ours, unnest(list_transform(range(1, len(w) + 2 - k), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS f
    FROM w, range(1, 4) t(k) WHERE len(w) >= k) GROUP BY ALL),
h AS (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM f)),
b AS MATERIALIZED (
  SELECT f, xor(list_reduce([4294967295] || list_transform(range(length(h) // 2), lambda i:
    CAST('0x' || substr(h, CAST(2 * i + 1 AS INT), 2) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[CAST((xor(c, b) & 255) + 1 AS INT)])), 4294967295) % 10000 AS b
  FROM h, crc),
c AS (
  SELECT b, coalesce(sum(n) FILTER (WHERE ours), 0) AS s, coalesce(sum(n) FILTER (WHERE NOT ours), 0) AS t
  FROM f JOIN b USING (f) GROUP BY b),
g AS MATERIALIZED (
  SELECT b, floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(sum(s) OVER () + 10000 AS DOUBLE)
    / (CAST(s + 1 AS DOUBLE) * CAST(sum(t) OVER () + 10000 AS DOUBLE)))) AS g FROM c),
k AS (
  SELECT r, sum(n) AS n, sum(n * g) AS weight FROM f JOIN b USING (f) JOIN g USING (b) WHERE ours GROUP BY r),
d AS (
  SELECT r, doc_id, len(w) AS words, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) AS h
  FROM w LEFT JOIN k USING (r) WHERE ours),
e AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM d),
p AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () * 5 // 100 AS most
  FROM e WHERE words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= most THEN rank END AS rank FROM e LEFT JOIN p USING (r)"""

ORACLES = {
    "op3_kdtree": _KDTREE,
    "op7_suffixes": _SUFFIXES,
    "op8_archives": _ARCHIVES,
    "op10_fmindex": _FMINDEX,
    "op11_threshold": _threshold(),
    "op12_importance": _IMPORTANCE,
}

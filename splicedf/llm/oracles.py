"""The queries that SQL can express, as DuckDB SQL over the same tables."""

from __future__ import annotations

from splicedf.llm import license_scan, mixing, simplex_clusters, vector_codes

WORD = r"[^\x20\x09-\x0D]+"
TEST_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = f"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, '{WORD}') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 3], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce((SELECT min(b) FROM reach WHERE a = d.doc_id), d.doc_id)) AS component_id FROM d LEFT JOIN n USING (doc_id)"""

OP4 = f"""WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '{TEST_WORD}') AS w FROM documents), b AS (SELECT item_id, regexp_extract_all({LOWER}, '{TEST_WORD}') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM b WHERE len(w) > 0)),
grams AS (SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, k, grams.n, item_id FROM grams JOIN win USING (n, g)),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hit) GROUP BY 1),
item AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN word USING (doc_id) LEFT JOIN item USING (doc_id)"""

FILL = "OVER (ORDER BY n * 3 / CAST(weight AS DOUBLE), source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
OP8 = f"""WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS n FROM d GROUP BY source), w AS (SELECT source, n, CAST([5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS BIGINT) AS weight FROM s),
f AS (SELECT *, sum(n) OVER () AS words, sum(weight) OVER () AS weights, 3 * coalesce(sum(n) {FILL}, 0) AS full_, coalesce(sum(weight) {FILL}, 0) AS spent FROM w),
g AS (SELECT *, n * 3 * (weights - spent) <= weight * (words - full_) AS is_full FROM f),
h AS (SELECT *, words - sum(CASE WHEN is_full THEN 3 * n ELSE 0 END) OVER () AS rest, weights - sum(CASE WHEN is_full THEN weight ELSE 0 END) OVER () AS open_ FROM g),
t AS (SELECT source, n, CASE WHEN is_full THEN CAST(3 * n AS DOUBLE) ELSE CAST(weight * rest AS DOUBLE) / CAST(open_ AS DOUBLE) END AS target FROM h),
r AS (SELECT d.*, t.n, t.target, CASE WHEN t.n > 0 THEN t.target / t.n ELSE CAST(0 AS DOUBLE) END AS rate, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':{mixing.SEED}'), 1, 13) AS BIGINT) / CAST(4503599627370496 AS DOUBLE) AS u FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, n AS source_size, target, size * CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken FROM r"""

OP10 = """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), q AS (SELECT *, CAST(strlen(h) AS BIGINT) AS n, max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest, CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM last AND last IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM last THEN last END AS refers_to, true AS whole FROM q"""


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def license_sql() -> str:
    known = ", ".join(f"({quoted(s)}, {quoted(i)})" for i, of in license_scan.SENTENCES.items() for s in of)
    parts = [
        "d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents)", f"known(s, i) AS (VALUES {known})",
        f"cut AS (SELECT rid, string_split_regex(regexp_replace(text, '{license_scan.WRAPPED.replace(chr(92) + 'n', chr(10))}', '\\1 \\2', 'g'), '[.!?;:]+[ \\t\\r\\n]+|\\n+') AS l FROM d WHERE regexp_matches(text, '{license_scan.HINT}'))",
        "part AS (SELECT rid, generate_subscripts(l, 1) AS k, unnest(l) AS x FROM cut)",
        "norm AS (SELECT rid, k, trim(regexp_replace(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g')) AS s FROM part)",
        "seq AS (SELECT rid, string_agg(i, '>>' ORDER BY k) AS q, string_agg(i, ',' ORDER BY k) AS ids FROM norm JOIN known USING (s) GROUP BY rid)",
        "r0 AS (SELECT rid, ids, '>' || q || '>' AS l, '' AS names, CAST(NULL AS VARCHAR) AS kind FROM seq)",
    ]
    for n, (name, kind, ids) in enumerate(license_scan.RULES):
        want = quoted(">" + ">>".join(ids) + ">")
        new = f"strpos(l, {want}) > 0"
        parts.append(f"r{n + 1} AS (SELECT rid, ids, CASE WHEN {new} THEN substr(l, 1, strpos(l, {want}) - 1) || '<' || substr(l, strpos(l, {want}) + length({want})) ELSE l END AS l, CASE WHEN {new} AND NOT list_contains(string_split(names, ','), {quoted(name)}) THEN names || CASE WHEN names = '' THEN '' ELSE ',' END || {quoted(name)} ELSE names END AS names, CASE WHEN {new} THEN coalesce(kind, {quoted(kind)}) ELSE kind END AS kind FROM r{n})")
    last = f"r{len(license_scan.RULES)}"
    return f"WITH {', '.join(parts)} SELECT doc_id, coalesce(ids, '') AS sentence_ids, coalesce(names, '') AS licenses, coalesce(kind, 'none') AS license_class, CAST(CASE WHEN coalesce(names, '') = '' THEN 0 ELSE len(string_split(names, ',')) END AS BIGINT) AS n_licenses FROM d LEFT JOIN {last} USING (rid)"


SOUND = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
#: s / n rounded down, for integers of either sign.
FLOOR_DIV = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"


def vector_code_sql(parts: int, entries: int, rounds: int, scale: int) -> str:
    """Vectors of one length that parts divides; the number of a nearest entry rides below its distance."""
    gap = "list_sum(list_transform(range(1, len(v.x) + 1), lambda i: CAST((v.x[i] - b.x[i]) * (v.x[i] - b.x[i]) AS BIGINT)))"
    steps = [
        f"k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE {SOUND})",
        f"v AS MATERIALIZED (SELECT vec_id, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS x FROM (SELECT vec_id, v, unnest(range({parts})) AS p FROM k))",
        f"b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM v WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT {entries}))",
    ]
    for r in range(rounds + 1):
        steps.append(f"a{r} AS MATERIALIZED (SELECT v.vec_id, v.p, min(CAST({gap} AS BIGINT) * {entries} + b.e) AS m FROM v JOIN b{r} b ON v.p = b.p GROUP BY v.vec_id, v.p)")
        if r < rounds:
            steps.append(f"m{r} AS (SELECT p, m % {entries} AS e, i, {FLOOR_DIV} AS t FROM (SELECT v.p, a.m % {entries} AS m, i, CAST(sum(v.x[i]) AS BIGINT) AS s, count(*) AS n FROM a{r} a JOIN (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM v) v ON a.vec_id = v.vec_id AND a.p = v.p GROUP BY v.p, a.m % {entries}, i))")
            steps.append(f"b{r + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(n.x, b.x) AS x FROM b{r} b LEFT JOIN (SELECT p, e, list(t ORDER BY i) AS x FROM m{r} GROUP BY p, e) n ON b.p = n.p AND b.e = n.e)")
    steps.append(f"o AS (SELECT k.vec_id, k.label, string_agg(format('{{:02x}}', a.m % {entries}), '' ORDER BY a.p) AS code, CAST(sum(a.m // {entries}) AS BIGINT) AS error FROM a{rounds} a JOIN k ON k.vec_id = a.vec_id GROUP BY k.vec_id, k.label)")
    books = f"(SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM b{rounds})"
    return f"WITH {', '.join(steps)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, {books} AS codebooks_sha256 FROM o"


def cluster_sql(clusters: int, rounds: int, dims: int, scale: int, seed: int) -> str:
    gap = "list_sum(list_transform(range(1, len(k.v) + 1), lambda i: CAST((k.v[i] - c.x[i]) * (k.v[i] - c.x[i]) AS BIGINT)))"
    steps = [
        f"k AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE {SOUND} AND len(embedding) = {dims})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || CAST(vec_id AS VARCHAR))) - 1 AS c, v AS x FROM k ORDER BY sha256('{seed}:' || CAST(vec_id AS VARCHAR)) LIMIT {clusters})",
    ]
    for r in range(rounds + 1):
        steps.append(f"a{r} AS MATERIALIZED (SELECT k.vec_id, min(CAST({gap} AS BIGINT) * {clusters} + c.c) AS m FROM k CROSS JOIN c{r} c GROUP BY k.vec_id)")
        if r < rounds:
            steps.append(f"m{r} AS (SELECT c, i, {FLOOR_DIV} AS t FROM (SELECT a.m % {clusters} AS c, i, CAST(sum(k.v[i]) AS BIGINT) AS s, count(*) AS n FROM a{r} a JOIN (SELECT *, unnest(range(1, len(v) + 1)) AS i FROM k) k ON a.vec_id = k.vec_id GROUP BY a.m % {clusters}, i))")
            steps.append(f"c{r + 1} AS MATERIALIZED (SELECT o.c, coalesce(n.x, o.x) AS x FROM c{r} o LEFT JOIN (SELECT c, list(t ORDER BY i) AS x FROM m{r} GROUP BY c) n ON o.c = n.c)")
    return f"WITH {', '.join(steps)} SELECT vec_id, CAST(a.m % {clusters} AS INT) AS cluster, a.m // {clusters} AS distance, CAST(sum(a.m // {clusters}) OVER (PARTITION BY a.m % {clusters}) AS BIGINT) AS cluster_inertia, CAST(sum(a.m // {clusters}) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256 FROM a{rounds} a JOIN c{rounds} c ON c.c = a.m % {clusters}"


ORACLE_SQL = {
    "op3_jaccard_join": OP3, "op4_decontamination": OP4, "op7_license_scan": license_sql(), "op8_source_mixing": OP8, "op10_warc_segments": OP10,
    "op12_vector_codes": vector_code_sql(vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS, vector_codes.SCALE),
    "op13_simplex_clusters": cluster_sql(simplex_clusters.CLUSTERS, simplex_clusters.ROUNDS, simplex_clusters.DIMS, simplex_clusters.SCALE, simplex_clusters.SEED),
}

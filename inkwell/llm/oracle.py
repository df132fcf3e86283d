"""DuckDB SQL of the queries that SQL can express, written from their contracts by plain means."""

from __future__ import annotations

#: Fixed value: the words of a text, as a DuckDB pattern.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_SPANS = """
again AS (SELECT w.doc_id, w.i FROM w JOIN (SELECT k, min(doc_id * 4294967296 + i) AS m FROM w GROUP BY k) f USING (k) WHERE w.doc_id * 4294967296 + w.i > f.m),
islands AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM
  (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= {window} THEN 0 ELSE 1 END AS fresh FROM again)),
spans AS (SELECT doc_id, min(i) AS s, max(i) + {window} AS e FROM islands GROUP BY doc_id, island)"""

OP1 = (
    """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, length(hex(encode(coalesce(text, '')))) // 2 AS n FROM documents),
c AS (SELECT doc_id, n, j, substr(h, 200 * j + 1, 400) AS c FROM (SELECT doc_id, h, n, unnest(range(n // 100 + 1)) AS j FROM d)),
w AS (SELECT doc_id, 100 * j + o AS i, md5_number(substr(c, 2 * o + 1, 200)) AS k FROM (SELECT doc_id, n, j, c, unnest(range(100)) AS o FROM c) WHERE 100 * j + o <= n - 100),"""
    + _SPANS.format(window=100)
    + """,
pieces AS (SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS p FROM spans),
cut AS (SELECT d.doc_id, sum(e - s) AS removed, count(*) AS spans, string_agg(substr(h, (2 * p + 1)::BIGINT, (2 * (s - p))::BIGINT), '' ORDER BY s) AS kept, max(e) AS last
  FROM d JOIN pieces USING (doc_id) GROUP BY d.doc_id)
SELECT d.doc_id, d.n AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept || substr(h, (2 * last + 1)::BIGINT), h))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)"""
)

OP5 = (
    f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
v AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS i FROM d),
w AS (SELECT doc_id, i, k FROM (SELECT doc_id, i, md5_number(string_agg(word, ' ') OVER f) AS k, count(*) OVER f AS n FROM v
  WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)) WHERE n = 20),"""
    + _SPANS.format(window=20)
    + """,
kept AS (SELECT v.doc_id, string_agg(word, ' ' ORDER BY v.i) AS t, count(*) AS n FROM v LEFT JOIN spans ON v.doc_id = spans.doc_id AND v.i >= s AND v.i < e WHERE s IS NULL GROUP BY v.doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"""
)

OP8 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
v AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
pairs AS (SELECT doc_id, word || ' ' || lead(word) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM v),
grams AS (SELECT DISTINCT doc_id, g FROM pairs WHERE g IS NOT NULL UNION ALL SELECT doc_id, ws[1] FROM d WHERE len(ws) = 1),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
reach(doc_id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT links.b, reach.c FROM reach JOIN links ON links.a = reach.doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(c) AS component_id, min(c) = d.doc_id AS kept FROM d JOIN reach USING (doc_id) LEFT JOIN sizes USING (doc_id) GROUP BY d.doc_id, n"""

#: Weights, water filling and quotients as in the contract; blocks of 16 words, shards of 200,000 and seed 7 as in the query.
OP10 = f"""
WITH r AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size, sha256('7:' || coalesce(doc_id::VARCHAR, '-') || ':' || coalesce(text, '')) AS h FROM documents),
d AS (SELECT doc_id, source, size, ('0x' || substr(h, 1, 15))::BIGINT AS draw, ('0x' || substr(h, 16, 15))::BIGINT AS deal FROM r),
s AS (SELECT source, sum(size)::BIGINT AS source_size, (1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3)::DOUBLE AS weight FROM d GROUP BY source),
f AS (SELECT *, (sum(source_size) OVER () - 3.0::DOUBLE * coalesce(sum(source_size) OVER up, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER up, 0)) AS level FROM s
  WINDOW up AS (ORDER BY source_size / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, (SELECT arg_min(level, (source_size / weight, coalesce(source, chr(1114111)))) FROM f WHERE level <= 3.0::DOUBLE * source_size / weight) AS final FROM f),
t AS (SELECT source, source_size, least(3.0::DOUBLE * source_size, weight * coalesce(final, 0.0::DOUBLE)) AS target FROM g),
e AS (SELECT *, CASE WHEN source_size > 0 THEN least(3, floor(target / source_size + 1e-9::DOUBLE)) ELSE 0 END::BIGINT AS epochs FROM t),
v AS (SELECT *, greatest(target - epochs * source_size, 0.0::DOUBLE) AS votes, greatest(1, ceil(source_size / 200000.0::DOUBLE))::BIGINT AS shards FROM e),
seats AS (SELECT round(sum(votes) / 16)::BIGINT AS n FROM v),
won AS (SELECT source, count(*) AS quota FROM (SELECT source, row_number() OVER (ORDER BY votes / (k + 0.5::DOUBLE) DESC, source ASC NULLS LAST, k) AS turn
  FROM (SELECT source, votes, unnest(range((SELECT n FROM seats))) AS k FROM v WHERE votes > 0)) WHERE turn <= (SELECT n FROM seats) GROUP BY source),
dealt AS (SELECT d.doc_id, d.source, d.size, d.draw, d.deal % v.shards AS shard, source_size, target, epochs, coalesce(quota, 0) AS quota
  FROM d JOIN v ON d.source IS NOT DISTINCT FROM v.source LEFT JOIN won ON won.source IS NOT DISTINCT FROM v.source),
p AS (SELECT source, shard, sum(size)::DOUBLE AS votes, max(quota) AS quota FROM dealt GROUP BY source, shard),
got AS (SELECT source, shard, count(*) * 16 AS words FROM (SELECT source, shard, quota, row_number() OVER (PARTITION BY source ORDER BY votes / (k + 0.5::DOUBLE) DESC, shard, k) AS turn
  FROM (SELECT source, shard, quota, votes, unnest(range(quota)) AS k FROM p WHERE votes > 0)) WHERE turn <= quota GROUP BY source, shard),
laid AS (SELECT dealt.*, coalesce(words, 0) AS words, sum(size) OVER (PARTITION BY dealt.source, dealt.shard ORDER BY draw) AS reach,
  sum(size) OVER (PARTITION BY dealt.source, dealt.shard, draw) AS own, count(*) OVER (PARTITION BY dealt.source, dealt.shard, draw) AS equal
  FROM dealt LEFT JOIN got ON got.source IS NOT DISTINCT FROM dealt.source AND got.shard = dealt.shard)
SELECT doc_id, source, size, source_size, target,
  (epochs * size + CASE WHEN reach <= words THEN size WHEN reach - own >= words THEN 0 ELSE least(size, floor((words - reach + own) / equal)) END)::BIGINT AS taken FROM laid"""



def clusters(k: int = 8, rounds: int = 10, seed: int = 3, dims: int = 64, scale: int = 1024) -> str:
    """Rounds of exact k-means, one after the other: every distance is worked out."""
    nearest = "SELECT vec_id, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT v.vec_id, c.c, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS d FROM v JOIN c{0} c USING (i) GROUP BY v.vec_id, c.c) GROUP BY vec_id"
    moved = """SELECT c.c, c.i, coalesce(m.x, c.x) AS x FROM c{0} c LEFT JOIN (SELECT c, i, ((s - ((s % n) + n) % n) // n)::BIGINT AS x
  FROM (SELECT a.c, v.i, sum(v.x)::BIGINT AS s, count(*) AS n FROM a{0} a JOIN v USING (vec_id) GROUP BY a.c, v.i)) m USING (c, i)"""
    steps = [
        f"e AS MATERIALIZED (SELECT vec_id, embedding FROM embeddings WHERE len(embedding) = {dims} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)",
        f"v AS MATERIALIZED (SELECT vec_id, generate_subscripts(embedding, 1) AS i, floor({scale} * unnest(embedding)::DOUBLE)::BIGINT AS x FROM e)",
        f"f AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c FROM e)",
        f"c0 AS MATERIALIZED (SELECT f.c, v.i, v.x FROM f JOIN v USING (vec_id) WHERE f.c < {k})",
    ]
    for r in range(rounds):
        steps += [f"a{r} AS MATERIALIZED ({nearest.format(r)})", f"c{r + 1} AS MATERIALIZED ({moved.format(r)})"]
    steps.append(f"a AS MATERIALIZED ({nearest.format(rounds)})")
    steps.append(f"h AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS sha FROM c{rounds} GROUP BY c)")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, a.c::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, sha AS centroid_sha256 FROM a JOIN h USING (c)"""


ORACLE_SQL = {"op1_suffix_dedup": OP1, "op5_substring_dedup": OP5, "op8_near_dedup": OP8, "op10_source_mix": OP10, "op13_centroid_clusters": clusters()}

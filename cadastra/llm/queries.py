"""One registered query per operator, and its SQL where SQL can express it."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm import (
    collocations, kronecker, mixing, ngram_join, packing, page_diff, pii, resampling, sketch, suffix_arrays, tokens,
    url_filter, vafile, wavelet,
)

TOKENIZER = "byte_bpe_50k.json"

# fixed values: the rules by host and path
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def op1_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_diff.extract(_table(spark, sf_dir, "pages"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).drop("source")


def op3_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(_table(spark, sf_dir, "documents"))


def op4_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokens.public_path(TOKENIZER)
    return wavelet.read_shards(wavelet.write_shards(_table(spark, sf_dir, "documents"), path, end_id=2))


def op5_vector_approximation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op6_bottom_k_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.against_next(_table(spark, sf_dir, "documents"))


def op7_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokens.public_path(TOKENIZER)
    return packing.pack(_table(spark, sf_dir, "documents"), path, end_id=1, with_ids=False)


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = resampling.select(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return s.scored.withColumn("selected", s.selected()).drop("text_hash")


def listed_feed(pages: DataFrame) -> DataFrame:
    """Stands in for an outside feed of listed URLs.

    The list holds the pages whose canonical URL has a digest starting with 0, each written in another
    spelling (scheme, ``www.``, slash, tracking parameter, fragment), and as many URLs that no page has.
    """
    name = url_filter.canonical(F.col("url"))
    some = pages.select(name.alias("name")).where("name <> ''").withColumn("digit", F.substring(F.md5("name"), 1, 1))
    tail = F.when(F.contains("name", F.lit("?")), "&ref=feed#top").otherwise("/?utm_source=feed#top")
    return some.where("digit IN ('0', '1')").select(
        F.when(F.col("digit") == "0", F.concat(F.lit("HTTPS://WWW."), "name", tail))
        .otherwise(F.concat(F.lit("http://absent."), "name")).alias("url"))


def op10_url_bloom_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return url_filter.judge(pages, listed_feed(pages), URL_RULES)


def op11_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_arrays.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_count_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_kronecker_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return kronecker.mine(_table(spark, sf_dir, "embeddings"), vec_id % 100 == 0, moved)


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    -ln((CAST('0x' || substr(md5('23:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT)
         + CAST(0.5 AS DOUBLE)) / CAST(4503599627370496 AS DOUBLE))
    / (CAST(0.05 AS DOUBLE) + CAST(0.95 AS DOUBLE) * coalesce(
         length(regexp_replace(text, '[^\p{L} ]', '', 'g')) / nullif(length(text), 0), CAST(0 AS DOUBLE))) AS key
  FROM documents),
s AS (SELECT source, sum(size) AS ss FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM s),
r AS (SELECT *, 3 * ss AS cap, CAST(3 * ss AS DOUBLE) / w AS r FROM w),
h AS (SELECT *, row_number() OVER (ORDER BY r, source NULLS LAST) AS i,
        CAST((SELECT sum(ss) FROM s) - coalesce(sum(cap) OVER b, 0) AS DOUBLE)
        / ((SELECT sum(w) FROM w) - coalesce(sum(w) OVER b, 0)) AS share
      FROM r WINDOW b AS (ORDER BY r, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, ss, least(CAST(cap AS DOUBLE),
        coalesce((SELECT arg_min(share, i) FROM h WHERE share <= r), 0) * w) AS target FROM h),
e AS (SELECT *, CASE WHEN ss > 0 THEN CAST(floor(target / ss) AS BIGINT) ELSE 0 END AS epochs FROM t),
f AS (SELECT *, target - epochs * ss AS rest FROM e),
c AS (SELECT d.*, f.ss, f.target, f.epochs, f.rest,
        sum(size) OVER (PARTITION BY d.source ORDER BY key) AS upto
      FROM d JOIN f ON d.source IS NOT DISTINCT FROM f.source)
SELECT doc_id, size, CAST(ss AS BIGINT) AS source_size, target,
  CAST(size * (epochs + CASE WHEN rest > 0 AND (upto <= rest
    OR (upto - size < rest AND upto - rest <= rest - (upto - size))) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c
"""

OP5_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""

OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE
    WHEN len(ws) >= 5 THEN list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')]
    ELSE [] END AS sh
  FROM w),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n FROM s),
u AS (SELECT doc_id, unnest(sh) AS g FROM s),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
      FROM u x JOIN u y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM o JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * c >= 80 * (na.n + nb.n - c)),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT n.doc_id, n.n AS n_shingles, least(n.doc_id, coalesce(m.low, n.doc_id)) AS component_id
FROM n LEFT JOIN (SELECT a, min(b) AS low FROM r GROUP BY a) m ON m.a = n.doc_id
"""

OP10_SQL = r"""
WITH p AS (
  SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
h AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
         regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS query, url
  FROM p),
k AS (
  SELECT *, list_sort(list_filter(string_split(query, '&'), lambda q: q <> '' AND
    NOT regexp_matches(q, '^(utm_[^=]*|ref|fbclid|gclid|mc_cid|mc_eid)(=|$)'))) AS kept FROM h),
c AS (
  SELECT page_id, host, path,
    coalesce(regexp_replace(regexp_replace(host, '^[^@]*@', ''), '^www\.|:(80|443)$', '', 'g')
      || regexp_replace(path, '/+$', '')
      || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END, '') AS name
  FROM k),
l AS (SELECT DISTINCT name FROM c WHERE substr(md5(name), 1, 1) = '0' AND name <> ''),
rules(rhost, rpath, rverdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
f AS (
  SELECT page_id, host, path, name, (SELECT arg_max({'r': rhost || rpath, 'v': rverdict}, length(rhost || rpath)) FROM rules
    WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)) AS hit
  FROM c)
SELECT page_id, host, path, hit.r AS rule,
  coalesce(hit.v, CASE WHEN name IN (SELECT name FROM l) THEN 'block' ELSE 'allow' END) AS verdict,
  name IN (SELECT name FROM l) AS listed
FROM f
"""

OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS win
  FROM (SELECT item_id, ws, least(len(ws), 10) AS k, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i
        FROM b WHERE len(ws) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (
  SELECT row, k, i, array_to_string(ws[i:i + k - 1], ' ') AS win
  FROM (SELECT row, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d JOIN ks ON len(ws) >= k)),
hit AS (SELECT dw.row, dw.i, dw.k, bw.item_id FROM dw JOIN bw USING (k, win)),
words AS (SELECT row, count(DISTINCT w) AS n_hit FROM (
            SELECT DISTINCT row, unnest(range(i, i + k)) AS w FROM (SELECT DISTINCT row, i, k FROM hit)) GROUP BY row),
names AS (SELECT row, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
          FROM (SELECT DISTINCT row, item_id FROM hit) GROUP BY row)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (row) LEFT JOIN names USING (row)
"""

OP12_SQL = r"""
WITH p AS (
  SELECT row_number() OVER () AS piece, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
n AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM p GROUP BY lang),
o AS (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM p, (VALUES (1), (2), (3), (4)) s(k) WHERE len(ws) >= k),
f AS (SELECT lang, ws[i:i + k - 1] AS w, k, count(*) AS f FROM o GROUP BY ALL HAVING count(*) >= 30),
c AS (
  SELECT c.lang, c.w, c.k, c.f AS a, x.f AS l, y.f AS r, cut,
    CAST((2000000 * CAST(c.f AS HUGEINT)) // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM f WHERE k >= 2) c
  JOIN f x ON x.lang = c.lang AND x.w = c.w[1:cut]
  JOIN f y ON y.lang = c.lang AND y.w = c.w[cut + 1:]),
best AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, cut) = 1),
inner_ AS (
  SELECT DISTINCT lang, w[i:i + m - 1] AS w, f
  FROM (SELECT lang, w, f, m, unnest(range(1, k - m + 2)) AS i FROM f, (VALUES (2), (3)) s(m) WHERE k > m)),
gone AS (SELECT DISTINCT b.lang, b.w FROM best b JOIN inner_ i ON i.lang = b.lang AND i.w = b.w
         WHERE 100 * CAST(i.f AS HUGEINT) >= 80 * CAST(b.a AS HUGEINT)),
t AS (SELECT b.*, array_to_string(b.w, ' ') AS phrase FROM best b LEFT JOIN gone g ON g.lang = b.lang AND g.w = b.w
      WHERE g.w IS NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM t)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
  CAST(r AS BIGINT) AS r, n, score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

OP13_SQL = r"""
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, c.row, c.vec_id, a.label = c.label AS same,
    CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score
  FROM v a JOIN v c ON a.row <> c.row WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor, anchor_id, row AS positive, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, row) <= 5),
g AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.vec_id, s.row) AS rank
  FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same
  WHERE 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM g WHERE rank <= 10
"""

QUERIES = {f.__name__: f for f in (
    op1_page_differencing, op2_source_mixing, op3_pii_boosting, op4_wavelet_shards, op5_vector_approximation,
    op6_bottom_k_sketch, op7_binary_packing, op8_ngram_jaccard_join, op9_importance_resampling, op10_url_bloom_join,
    op11_suffix_arrays, op12_count_streams, op13_kronecker_negatives)}
SQL = {
    "op2_source_mixing": OP2_SQL,
    "op5_vector_approximation": OP5_SQL,
    "op8_ngram_jaccard_join": OP8_SQL,
    "op10_url_bloom_join": OP10_SQL,
    "op11_suffix_arrays": OP11_SQL,
    "op12_count_streams": OP12_SQL,
    "op13_kronecker_negatives": OP13_SQL,
}

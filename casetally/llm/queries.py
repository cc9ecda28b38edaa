"""The queries of this subpackage over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from casetally.llm.bpe import WORD_CHUNKS, token_digests
from casetally.llm.decontamination import contamination
from casetally.llm.divergence import source_divergence
from casetally.llm.exact_dedup import exact_duplicates
from casetally.llm.lattice_lm import lattice_scores
from casetally.llm.mixing import mix
from casetally.llm.near_dup import near_duplicates
from casetally.llm.ranked_search import ranked_search
from casetally.llm.secret_scan import span_digests
from casetally.llm.sharding import byte_shards
from casetally.llm.topk import quantised, top_k
from casetally.llm.toxicity import toxicity
from casetally.llm.warc import archived_pages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages"))


@query
def op2_threshold_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(table(spark, sf_dir, "embeddings"))
    return top_k(vectors.filter("vec_id % 50 = 0"), vectors, k=5)


@query
def op3_structural_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digests(table(spark, sf_dir, "documents"))


@query
def op4_prefix_dp_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN, WORD_CHUNKS,
    )


@query
def op5_weighted_fair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, most=2)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op6_lsh_forest_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "class_size", "links", "copies")


@query
def op7_quotient_filter_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query
def op8_subword_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return lattice_scores(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )


@query
def op9_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_prefix_sum_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_shards(table(spark, sf_dir, "documents"), shards=16)


@query
def op11_count_cell_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"), least_docs=30, most_terms=50)


@query
def op12_accumulator_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


@query
def op13_wu_manber_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=10)


ORACLE["op1_warc_transactions"] = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest,
         min(page_id) OVER (PARTITION BY payload) AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM d
"""

ORACLE["op2_threshold_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS vec
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.vec, v.vec) AS BIGINT) AS score
  FROM v AS q, v WHERE q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

ORACLE["op5_weighted_fair_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS ord,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS no
  FROM d GROUP BY source
), w AS (
  SELECT *, CASE (no - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM s
), r AS (
  SELECT *, 2.0::DOUBLE * source_size / weight AS level,
         1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) AS budget FROM w
), q AS (
  SELECT *, row_number() OVER o AS rank,
         (budget - 2 * coalesce(CAST(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE), 0))
         / CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS common
  FROM r WINDOW o AS (ORDER BY level, source NULLS LAST)
), t AS (
  SELECT source, source_size,
         least(2.0::DOUBLE * source_size,
               coalesce((SELECT common FROM q WHERE common <= level ORDER BY rank LIMIT 1) * weight,
                        2.0::DOUBLE * source_size)) AS target
  FROM q
), c AS (
  SELECT doc_id, size, d.source, (upto + lap * source_size) / target AS finish
  FROM (SELECT *, CAST(sum(size) OVER (PARTITION BY source ORDER BY ord, doc_id ROWS UNBOUNDED PRECEDING)
                       AS BIGINT) AS upto FROM d) AS d
  JOIN t ON d.source IS NOT DISTINCT FROM t.source, (VALUES (0), (1)) AS laps(lap)
  WHERE size > 0 AND target > 0
), f AS (
  SELECT doc_id, CAST(count(*) AS BIGINT) AS copies FROM (
    SELECT doc_id, sum(size) OVER (ORDER BY finish, source NULLS LAST ROWS UNBOUNDED PRECEDING) AS used FROM c
  ) WHERE used <= (SELECT sum(target) FROM t) + 0.5 GROUP BY doc_id
)
SELECT d.doc_id, d.size, t.source_size, t.target, coalesce(f.copies, 0) * d.size AS taken
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN f ON d.doc_id = f.doc_id
"""

ORACLE["op7_quotient_filter_dedup"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER best = 1 AS kept, sha256(norm) AS text_sha256
FROM d WINDOW best AS (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST)
"""

# The checksum goes four bits at a time through a table of 16, made from its polynomial.
ORACLE["op10_prefix_sum_shards"] = r"""
WITH t AS (
  SELECT list_transform(range(16), lambda i: list_reduce(
    range(4), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS four
), d AS (
  SELECT doc_id, encode(coalesce(text, '')) AS bytes FROM documents
), c AS (
  SELECT doc_id, octet_length(bytes) + 1 AS size, xor(4294967295::BIGINT, list_reduce(
    list_transform(regexp_extract_all(hex(bytes), '..'), lambda h: CAST('0x' || h AS BIGINT)),
    lambda c, b: xor(xor(c, b) >> 8, xor(
      four[(xor(xor(c, b) >> 4, four[(xor(c, b) & 15) + 1]) & 15) + 1], four[(xor(c, b) & 15) + 1] >> 4)),
    4294967295::BIGINT)) AS text_crc32
  FROM d, t
), l AS (
  SELECT *, CAST(sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto,
         CAST(sum(size) OVER () AS BIGINT) AS total
  FROM c
), s AS (
  SELECT *, CAST(((2 * upto - size) * 16) // (2 * total) AS INTEGER) AS shard FROM l
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY upto) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM s
"""

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE["op11_count_cell_divergence"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), t AS (
  SELECT row_no, lang, source, translate(term, {_LOWER}) AS term
  FROM (SELECT row_no, lang, source, unnest(terms) AS term FROM d)
), k AS (
  SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT row_no) >= 30
), v AS (
  SELECT lang, CAST(count(*) AS HUGEINT) AS v, CAST(sum(n) AS HUGEINT) AS total FROM k GROUP BY lang
), c AS (
  SELECT t.lang, source, t.term, count(*) AS n FROM t SEMI JOIN k ON t.lang = k.lang AND t.term = k.term GROUP BY ALL
), g AS (
  SELECT s.lang, s.source, coalesce(CAST(sum(c.n) AS HUGEINT), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) AS s LEFT JOIN c ON s.lang = c.lang AND s.source = c.source GROUP BY ALL
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.total + 5 * v.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 5)) // (v.total + 5 * v.v) AS q
  FROM g JOIN v ON g.lang = v.lang JOIN k ON g.lang = k.lang
  LEFT JOIN c ON g.lang = c.lang AND g.source = c.source AND k.term = c.term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(sum(abs(x.p - y.p)), 0) AS BIGINT) AS value
  FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p AS x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p AS y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL
), r AS (
  SELECT lang, source, 'pair' AS part, item, value,
         row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, CAST(p - q AS BIGINT),
         row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term) FROM p WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 50
"""

ORACLE["op12_accumulator_ranked_search"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         regexp_extract_all(translate(text, {_LOWER}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL
), s AS (
  SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS words FROM d WHERE len(terms) > 0
), t AS (
  SELECT row_no, term, count(*) AS tf FROM (SELECT row_no, unnest(terms) AS term FROM d) GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM t, s GROUP BY term
), b AS (
  SELECT row_number() OVER () AS item_no, item_id,
         regexp_extract_all(translate(text, {_LOWER}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM benchmark
), q AS (
  SELECT item_no, item_id, term, count(*) AS times
  FROM (SELECT item_no, item_id, unnest(terms) AS term FROM b) GROUP BY ALL
), x AS (
  SELECT item_no, item_id, t.row_no, d.doc_id, CAST(sum(
    times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(d.terms) * s.docs) // s.words)))
  ) AS BIGINT) AS score
  FROM q JOIN w ON q.term = w.term JOIN t ON q.term = t.term JOIN d ON t.row_no = d.row_no, s
  GROUP BY ALL
), r AS (
  SELECT *, row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM x WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 20
"""

ORACLE["op13_wu_manber_decontamination"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), p AS (
  SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS words
  FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0
), g AS (
  SELECT row_no, i, k, array_to_string(w[i:i + k - 1], ' ') AS words
  FROM d, (SELECT DISTINCT k FROM p) AS k, unnest(range(1, len(w) - k + 2)) AS t(i) WHERE len(w) >= k
), h AS (
  SELECT g.row_no, item, g.i, g.k FROM g JOIN p ON g.k = p.k AND g.words = p.words
), n AS (
  SELECT row_no, count(DISTINCT place) AS n_hit
  FROM (SELECT row_no, unnest(range(i, i + k)) AS place FROM (SELECT DISTINCT row_no, i, k FROM h)) GROUP BY row_no
), m AS (
  SELECT row_no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row_no, item FROM h) GROUP BY row_no
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON d.row_no = n.row_no LEFT JOIN m ON d.row_no = m.row_no
"""

"""Corpus queries: every operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.operators.lineage import new_folder
from patronlens.llm.common import reachable
from patronlens.llm import divergence, exact_dedup, fingerprints, hard_negatives, html_text, language_id, mixing, ngram_join, packing, pii, substring_dedup, topk_search, warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SQL_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"


def _query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reachable(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return function


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


@_query
def op1_pii(spark, sf_dir):
    return pii.report(documents(spark, sf_dir))


@_query
def op2_substring_dedup(spark, sf_dir):
    return substring_dedup.report(documents(spark, sf_dir))


@_query
def op3_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir))


ORACLES["op3_packing"] = rf"""
WITH RECURSIVE rows AS (
  SELECT doc_id, {SQL_WORDS}::BIGINT AS n, md5(doc_id::VARCHAR) AS key FROM documents
), binned AS (
  SELECT *, CASE WHEN n <= {packing.EXACT} THEN n
    ELSE (ceil(n / pow(2, length(bin(n)) - {packing.DIGITS})) * pow(2, length(bin(n)) - {packing.DIGITS}))::BIGINT END AS bin
  FROM rows
), histogram AS (
  SELECT row_number() OVER (ORDER BY bound) AS j, bound, sum(c) OVER (ORDER BY bound)::BIGINT AS c, sum(t) OVER (ORDER BY bound)::BIGINT AS t
  FROM (SELECT max(n) AS bound, count(*) AS c, sum(n) AS t FROM binned GROUP BY bin)
), best AS (
  SELECT 1 AS k, j, bound * c - t AS cost, [bound] AS ends FROM histogram
  UNION ALL
  SELECT k + 1, j, min(cost), arg_min(ends, (cost, i)) FROM (
    SELECT b.k, h.j, b.j AS i, b.cost + h.bound * (h.c - p.c) - (h.t - p.t) AS cost, list_append(b.ends, h.bound) AS ends
    FROM best b JOIN histogram p ON p.j = b.j JOIN histogram h ON h.j > b.j WHERE b.k < {packing.BUCKETS}
  ) GROUP BY k, j
), chosen AS (
  SELECT ends FROM best WHERE j = (SELECT max(j) FROM histogram) ORDER BY cost, k LIMIT 1
), placed AS (
  SELECT doc_id, n, key, len(list_filter(ends, lambda e: e < n)) + 1 AS bucket, list_min(list_filter(ends, lambda e: e >= n)) AS bucket_len
  FROM binned, chosen
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY key, doc_id, n) - 1 AS place,
    greatest(1, {packing.BUDGET} // greatest(1, bucket_len)) AS capacity
  FROM placed
)
SELECT doc_id, n AS n_tokens, bucket::INTEGER AS bucket, bucket_len, place // capacity AS batch, place % capacity AS slot,
  bucket_len - n AS padding
FROM numbered
"""


@_query
def op4_mixing(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source")


ORACLES["op4_mixing"] = rf"""
WITH rows AS (
  SELECT doc_id, source, {SQL_WORDS}::BIGINT AS size, md5(doc_id::VARCHAR) AS key FROM documents
), sources AS (
  SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM rows GROUP BY source)
), by_room AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(2 * sum(source_size) OVER before, 0))
      / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
  FROM sources
  WINDOW before AS (ORDER BY 2.0 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), leveled AS (
  SELECT *, (SELECT b.level FROM by_room b WHERE b.level * b.w <= 2 * b.source_size
    ORDER BY 2.0 * b.source_size / b.w, b.source NULLS LAST LIMIT 1) AS final FROM by_room
), aims AS (
  SELECT source, source_size, CASE WHEN final * w > 2 * source_size THEN (2 * source_size)::DOUBLE ELSE final * w END AS target
  FROM leveled
), placed AS (
  SELECT r.*, a.source_size, a.target, floor(a.target)::BIGINT AS budget,
    sum(size) OVER (PARTITION BY r.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT - size AS before
  FROM rows r JOIN aims a ON r.source IS NOT DISTINCT FROM a.source
)
SELECT doc_id, size, source_size, target, source,
  CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
    + greatest(0, least(size, budget % source_size - before)) END::BIGINT AS taken
FROM placed
"""


@_query
def op5_exact_dedup(spark, sf_dir):
    docs = documents(spark, sf_dir)
    decided = exact_dedup.decide(docs, exact_dedup.new_index(spark), batches=2)
    return decided.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLES["op5_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@_query
def op6_warc(spark, sf_dir):
    folder = new_folder(spark, "archive")
    warc.write(pages(spark, sf_dir), folder)
    return warc.read(spark, folder)


ORACLES["op6_warc"] = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages
)
SELECT page_id, strlen(payload) AS payload_bytes, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to,
  array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      ((('0x' || substr(sha1(payload), (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INTEGER + 1, 1)), '') AS payload_digest
FROM payloads
"""


@_query
def op7_topk_search(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return topk_search.search(docs, docs.where("doc_id % 50 = 0"))


@_query
def op8_html_text(spark, sf_dir):
    return html_text.extract(pages(spark, sf_dir))


@_query
def op9_language_id(spark, sf_dir):
    return language_id.identify(documents(spark, sf_dir))


@_query
def op10_ngram_join(spark, sf_dir):
    return ngram_join.components(documents(spark, sf_dir)).drop("k1", "k2")


@_query
def op11_hard_negatives(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


ORACLES["op11_hard_negatives"] = f"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {hard_negatives.POSITIVES}
)
SELECT anchor_id, positive_id, row_number() OVER best::INTEGER AS rank, other AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER best <= {hard_negatives.NEGATIVES}
"""


@_query
def op12_fingerprints(spark, sf_dir):
    return fingerprints.report(documents(spark, sf_dir))


@_query
def op13_source_divergence(spark, sf_dir):
    return divergence.audit(documents(spark, sf_dir))


ORACLES["op13_source_divergence"] = rf"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, list_transform(
    regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'),
    lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS terms
  FROM documents
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), kept AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM docs)
  GROUP BY lang, term HAVING count(*) >= {divergence.LEAST_DOCS}
), counts AS (
  SELECT lang, source, term, count(*)::HUGEINT AS n
  FROM (SELECT lang, source, unnest(terms) AS term FROM docs) JOIN kept USING (lang, term) GROUP BY lang, source, term
), sizes AS (
  SELECT lang, source, (SELECT count(*) FROM kept k WHERE k.lang = g.lang)::HUGEINT * 2
    + coalesce((SELECT sum(n) FROM counts c WHERE c.lang = g.lang AND c.source = g.source), 0) AS size FROM groups g
), shares AS (
  SELECT s.lang, s.source, k.term, coalesce(n, 0) AS n, 1 + 1000000000 * (coalesce(n, 0) + 2) // size AS p
  FROM sizes s JOIN kept k ON k.lang = s.lang LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), whole AS (
  SELECT lang, term, 1 + 1000000000 * (sum(n) + 2) // (sum(sum(n)) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS q
  FROM counts GROUP BY lang, term
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source
), terms AS (
  SELECT lang, source, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
  FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term', item, value, row_number() OVER best::INTEGER FROM terms
WINDOW best AS (PARTITION BY lang, source ORDER BY value DESC, item)
QUALIFY row_number() OVER best <= {divergence.TOP}
"""

"""The queries of this subpackage: each reads its tables, applies its operator with production parameters and returns the digest columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from .bpe import bpe_digests
from .common import scratch, table
from .compaction import compacted
from .jaccard_join import ORACLE as JOIN_ORACLE
from .jaccard_join import components
from .licences import ORACLE as LICENCE_ORACLE
from .licences import licence_rows
from .mixing import ORACLE as MIX_ORACLE
from .mixing import mix
from .quality import ORACLE as QUALITY_ORACLE
from .quality import quality
from .token_counts import token_counts
from .topk import top_k
from .toxicity import toxicity
from .warc import round_trip


def op1_top_k(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0).drop("scored")


def op2_quality(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents"))


def op3_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_bpe(spark, sf_dir):
    return bpe_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_compaction(spark, sf_dir):
    """All documents, appended in four arrivals, compacted after each and read back from the latest manifest."""
    docs = table(spark, sf_dir, "documents")
    store = compacted(docs, scratch(spark, "shards"), F.pmod(F.xxhash64("doc_id"), F.lit(4)), 4)
    return store.read().select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("text_sha256"), "lang", "source", "n_chars")


def op6_licences(spark, sf_dir):
    return licence_rows(table(spark, sf_dir, "documents"))


def op7_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark, sf_dir):
    return components(table(spark, sf_dir, "documents"))


def op10_warc(spark, sf_dir):
    return round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {f.__name__: f for f in (op1_top_k, op2_quality, op3_token_counts, op4_bpe, op5_compaction, op6_licences, op7_toxicity, op8_mixing, op9_jaccard_join, op10_warc)}
ORACLE_SQL: dict[str, str] = {
    "op1_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
              FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
    """,
    "op2_quality": QUALITY_ORACLE,
    "op5_compaction": "SELECT doc_id, CAST(strlen(text) AS BIGINT) AS n_bytes, sha256(text) AS text_sha256, lang, source, n_chars FROM documents",
    "op6_licences": LICENCE_ORACLE,
    "op8_mixing": MIX_ORACLE,
    "op9_jaccard_join": JOIN_ORACLE,
    "op10_warc": """
        WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
        g AS (SELECT payload_digest, max(page_id) AS first_id FROM p WHERE payload_bytes >= 1000 GROUP BY 1 HAVING count(*) > 1)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
               CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first_id <> page_id THEN first_id END AS refers_to
        FROM p LEFT JOIN g ON p.payload_digest = g.payload_digest AND payload_bytes >= 1000
    """,
}

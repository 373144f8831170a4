"""The operators' registered queries, each over its whole table, and the SQL
for those that DuckDB can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import (alignment, bpe, histsort, langid, minhash, packing, quality, resampling, syncmers,
                         token_counts, urlrules, warc)
from stratum.llm.common import table
from stratum.llm.digest_index import DigestIndex, by_descending_id
from stratum.sinks import materialize

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
MULTI_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return langid.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op2_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.compare(table(spark, sf_dir, "documents"))


# fixed values: the listed rules (verdict, host, path)
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op3_urlrules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urlrules.judge(pages, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "mined_tokens", "mined_confidence")


def op4_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    # in batches from the largest doc_id down, so that the index decides about all but the first
    index = DigestIndex.create(spark)
    decided = index.ingest_all(by_descending_id(table(spark, sf_dir, "documents").select("doc_id", "text"), 3))
    index.close()
    return decided


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", *quality.OUT)


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(table(spark, sf_dir, "documents"), minhash.MinHashConfig(words=2))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE, window=1024).drop("ids")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.round_trip(docs, MULTI_RANKS, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_histsort(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # the texts move to their shards and are written there; what follows is read from those rows
    written = materialize(histsort.shard(docs, shards=40), "histsort_shards")
    text = F.coalesce("text", F.lit(""))
    return written.select(
        "doc_id", (F.octet_length(text).cast("bigint") + histsort.FRAME).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_quality(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", F.col("rank").cast("bigint").alias("rank"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count(table(spark, sf_dir, "documents"), WORD_BPE)
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_langid": op1_langid,
    "op2_syncmers": op2_syncmers,
    "op3_urlrules": op3_urlrules,
    "op4_digest_index": op4_digest_index,
    "op5_quality": op5_quality,
    "op6_minhash": op6_minhash,
    "op7_packing": op7_packing,
    "op8_bpe": op8_bpe,
    "op9_histsort": op9_histsort,
    "op10_warc": op10_warc,
    "op11_alignment": op11_alignment,
    "op12_resampling": op12_resampling,
    "op13_token_counts": op13_token_counts,
}

ORACLE_SQL: dict[str, str] = {
    "op4_digest_index": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, text_sha256
        FROM (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
        WINDOW same AS (PARTITION BY text_sha256)""",
    "op6_minhash": r"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x20\x09-\x0D]+') AS ws FROM documents),
        sh AS MATERIALIZED (
          SELECT doc_id, unnest(list_distinct(
                   CASE WHEN len(ws) >= 2 THEN list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])
                        ELSE ws END)) AS s FROM w),
        n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
        links AS MATERIALIZED (
          SELECT x, y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i
                            FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2)
          JOIN n na ON na.doc_id = x JOIN n nb ON nb.doc_id = y WHERE 100 * i >= 80 * (na.n + nb.n - i)),
        edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reach(doc_id, root) AS (
          SELECT doc_id, doc_id FROM documents
          UNION SELECT e.y, r.root FROM reach r JOIN edges e ON e.x = r.doc_id)
        SELECT doc_id, coalesce(n.n, 0) AS n_shingles, min(root) AS component_id, min(root) = doc_id AS kept
        FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id, n.n""",
    "op10_warc": """
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN 'revisit'
                    ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id > first_id THEN first_id END AS refers_to
        FROM (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
                     sha256(coalesce(html, '')) AS payload_digest,
                     min(page_id) OVER (PARTITION BY sha256(coalesce(html, ''))) AS first_id
              FROM pages)""",
}

"""Corpus pipeline: quality, language, exact dedup, near dedup, packing.

``STAGES`` lists (name, function).  Each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and read again as the next
one's docs.  All but the last return the columns of ``documents``.

- quality: the co-trained classifier, fitted on ``labels``; rejected rows go.
- language: naive Bayes, fitted on the rows that came in; rows without a
  letter, or far less likely in their language than its own texts are, go.
- exact_dedup: of equal texts the row with the largest doc_id stays.
- near_dedup: of documents linked at 0.8 on sets of five-word shingles, the one
  with the smallest doc_id stays.
- packing: sequences of 1,024 tokens, a row for each piece with its ids and its
  place in its sequence (``packing.sequences`` puts them together).

Empty input passes through every stage and gives no piece; null and empty texts
have no letter and go with the language stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stratum.llm import digest_index, langid, minhash, packing, quality as quality_classifier
from stratum.llm.common import table
from stratum.sinks import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return digest_index.exact_dedup(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), window=1024)


STAGES = [("quality", quality), ("language", language), ("exact_dedup", exact_dedup),
          ("near_dedup", near_dedup), ("packing", pack)]

# classifiers, MinHash and BPE have no SQL: tests hold run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs

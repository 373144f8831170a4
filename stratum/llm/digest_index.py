"""Exact dedup with a persistent digest index (operator 4, native).

The index is a table with one row per distinct text digest, bucketed and
sorted by the digest.  A batch is pre-aggregated to one row per digest, a
sort-merge anti-join with the index leaves the digests never seen before, and
those are appended.  Rows are then decided by an equi-join with the index.

Index rows carry the id of the batch that brought them.  A batch that is run
again after a failure, under the same id, meets only the rows of other batches
and appends what is still missing, so it decides as it did the first time.

Defined results: a null text counts as empty; equal texts are byte-identical;
of equal texts in one batch the row with the largest doc_id stays (a null
doc_id sorts below all others; among rows that repeat a doc_id one stays); a text
that an earlier batch brought keeps that batch's doc_id.  An empty batch
appends nothing.  Long texts are digested whole.  The batch's other columns,
whatever their names, never reach the index.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import by_group, whole
from stratum.session import scratch_path
from stratum.sinks import materialize
from stratum.sources.files import create_text_file, read_text_file

NO_ID = -(1 << 63)         # stands for a null doc_id in a join key


ROW = "text_sha256 string, keep_id bigint, group_size bigint, batch string"


@dataclass(frozen=True)
class DigestIndex:
    """A digest index stored under ``path`` (a shared folder) as the catalog
    table ``name``; ``buckets`` should be about the index's bytes / 1 GB."""

    spark: SparkSession
    path: str
    name: str
    buckets: int

    @classmethod
    def create(cls, spark: SparkSession, path: str | None = None, name: str | None = None,
               buckets: int | None = None) -> DigestIndex:
        """A new, empty index.  Its buckets default to the session's shuffle
        partitions, so that the anti-join needs no exchange of the index."""
        name = name or f"digest_index_{uuid.uuid4().hex[:12]}"
        path = (path or scratch_path(spark, "digest_index")).rstrip("/")
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        index = cls(spark, path, name, buckets)
        index._append(spark.createDataFrame([], ROW))
        if not create_text_file(spark, f"{path}/_buckets", str(buckets)):
            raise ValueError(f"{path} holds an index already; open() it")
        return index

    @classmethod
    def open(cls, spark: SparkSession, path: str, name: str | None = None) -> DigestIndex:
        """The index that ``create`` made under ``path``, perhaps in another
        session or cluster: the table is entered in this session's catalog."""
        path = path.rstrip("/")
        buckets = read_text_file(spark, f"{path}/_buckets")
        if not buckets:
            raise FileNotFoundError(f"no digest index under {path}")
        name = name or f"digest_index_{uuid.uuid4().hex[:12]}"
        if not spark.catalog.tableExists(name):
            spark.sql(f"CREATE TABLE {name} ({ROW}) USING parquet CLUSTERED BY (text_sha256) "
                      f"SORTED BY (text_sha256) INTO {buckets} BUCKETS LOCATION '{path}'")
        return cls(spark, path, name, int(buckets))

    def close(self) -> None:
        """Take the table out of the catalog; the index stays under its path."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def _append(self, fresh: DataFrame) -> None:
        (fresh.repartition(self.buckets, "text_sha256").sortWithinPartitions("text_sha256")
         .write.mode("append").format("parquet").option("path", self.path)
         .bucketBy(self.buckets, "text_sha256").sortBy("text_sha256").saveAsTable(self.name))

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def ingest(self, batch: DataFrame, doc_id: str = "doc_id", text: str = "text",
               batch_id: str | None = None) -> DataFrame:
        """Append the batch's new digests; one decision per row of the batch:
        ``doc_id, keep_id, group_size, kept, text_sha256``.  ``group_size``
        counts the equal rows of the batch.  Give ``batch_id`` so that the batch
        may be run again."""
        may_repeat, batch_id = batch_id is not None, batch_id or uuid.uuid4().hex
        rows = materialize(batch.select(
            F.col(doc_id).cast("bigint").alias("doc_id"),
            F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("text_sha256"),
            F.monotonically_increasing_id().alias("_row")), "digest_rows")
        salted, groups = by_group(
            rows, ["text_sha256"], ["_row"],
            {"_best": (F.max, F.struct("doc_id", "_row"), F.max),
             "group_size": (F.count, F.lit(1), F.sum)})
        groups = materialize(groups, "digest_groups")
        per_digest = (groups.groupBy("text_sha256")
                      .agg(F.first("_best").alias("_best"), F.first("group_size").alias("group_size")))
        other, own = (self.table().where(condition) for condition in
                      (F.col("batch") != batch_id, F.col("batch") == batch_id))
        fresh = per_digest.hint("merge").join(other.select("text_sha256"), "text_sha256", "left_anti")
        if may_repeat and not own.isEmpty():        # the batch has been here before, whole or in part
            fresh = fresh.hint("merge").join(own.select("text_sha256"), "text_sha256", "left_anti")
        fresh = materialize(fresh, "digest_fresh")
        known = materialize(groups.select("text_sha256").distinct().join(
            other.select("text_sha256", F.col("keep_id").alias("_old"), F.lit(True).alias("_known")),
            "text_sha256"), "digest_known")
        verdict = groups.join(known, "text_sha256", "left")
        self._append(fresh.select("text_sha256", F.col("_best.doc_id").alias("keep_id"), "group_size",
                                  F.lit(batch_id).alias("batch")))
        # rows of one doc_id and digest are alike, so any of them may be the one that stays
        return (salted.join(verdict, ["text_sha256", "_salt"])
                .select("doc_id",
                        F.when(F.col("_known"), F.col("_old")).otherwise(F.col("_best.doc_id"))
                        .alias("keep_id"),
                        "group_size",
                        (F.col("_known").isNull() & (F.col("_row") == F.col("_best._row"))).alias("kept"),
                        "text_sha256"))

    def ingest_all(self, batches: Sequence[DataFrame], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """Ingest several batches in order; ``group_size`` counts the equal rows
        of all of them."""
        decided = [materialize(self.ingest(b, doc_id, text), "digest_decided") for b in batches]
        rows, sizes = by_group(reduce(DataFrame.union, decided).drop("group_size"), ["text_sha256"],
                               ["doc_id", F.monotonically_increasing_id()],
                               {"group_size": (F.count, F.lit(1), F.sum)})
        return rows.join(sizes, ["text_sha256", "_salt"]).select(
            "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def by_descending_id(docs: DataFrame, batches: int, doc_id: str = "doc_id") -> list[DataFrame]:
    """``docs`` in ranges of doc_id of equal width, the largest first, rows
    without one last: in this order the largest doc_id of equal texts comes first."""
    ends = docs.agg(F.min(doc_id).alias("low"), F.max(doc_id).alias("high")).first()
    if ends["low"] is None:
        return [docs]
    cuts = [ends["low"] + (ends["high"] - ends["low"] + 1) * k // batches for k in range(1, batches)]
    place = sum((F.col(doc_id) >= c).cast("int") for c in cuts) if cuts else F.lit(0)
    place = F.coalesce(place, F.lit(-1))
    return [docs.where(place == k if k else place <= 0) for k in reversed(range(batches))]


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """Documents whose text no earlier batch and no row with a larger doc_id
    has; all columns of ``docs``."""
    index, own = (index, False) if index else (DigestIndex.create(docs.sparkSession), True)
    decided = index.ingest(docs)
    if own:
        index.close()
    keep = (decided.where("kept")
            .select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")))
    keep = keep.select(F.coalesce("_id", F.lit(NO_ID)).alias("_key"), F.col("_sha").alias("_text_sha"))
    keyed = whole(docs).withColumns({
        "_key": F.coalesce(F.col("_row.doc_id").cast("bigint"), F.lit(NO_ID)),
        "_text_sha": F.sha2(F.coalesce(F.col("_row.text"), F.lit("")), 256)})
    # rows that repeat both doc_id and text are one document; the join's
    # partitioning and order serve dropDuplicates as they are
    return (keyed.join(keep, ["_key", "_text_sha"], "left_semi")
            .dropDuplicates(["_key", "_text_sha"]).select("_row.*"))

"""Sinks and materialisation (SNK3, SNK5, SNK6, SNK7).

``materialize`` writes an intermediate to the shared checkpoint folder and
reads it back: it cuts lineage (a lost executor recomputes from the files,
not from the sources) and lets several consumers share one computation.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators.cdc import latest_per_key
from stratum.session import scratch_path
from stratum.sources.files import (create_text_file, delete_path, files_in, folder_bytes, list_names,
                                   partition_values, read_text_file)


def materialize(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, "materialized", name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize_keyed(df: DataFrame, name: str, key: str) -> DataFrame:
    """``materialize`` for rows under a hexadecimal key in lower case, which is
    written in binary: half the bytes."""
    rows = materialize(df.withColumn(key, F.unhex(key)), name)
    return rows.withColumn(key, F.lower(F.hex(key)))


def write_table(df: DataFrame, target: str, comment: str | None = None, mode: str = "overwrite",
                partition_by: Sequence[str] = (), dynamic: bool = False) -> None:
    """Path targets (contain ``/``) are parquet folders; other targets are
    catalog tables, optionally commented.  ``dynamic=True`` overwrites only
    the partitions present in ``df`` (upsert of touched buckets)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if "/" in target:
        w.parquet(target)
        return
    w.format("parquet").saveAsTable(target)
    if comment:
        esc = comment.replace("'", "\\'")
        df.sparkSession.sql(f"COMMENT ON TABLE {target} IS '{esc}'")


BUCKET = "__bucket"
_END = "end"


class MergeConflict(RuntimeError):
    """Another writer has committed the version that this one was about to."""


class MergeTable:
    """A stored table in ``buckets`` hash buckets of its key, that batches are
    merged into (latest ``seq`` wins; without ``seq`` the update wins).

    Data files lie in ``data/<folder>/__bucket=<b>``; ``manifest/<n>`` lists for
    each bucket the folder that holds it in version n.  A merge writes the
    buckets that its updates touch into a new folder and then creates the next
    manifest, which must not exist: that commits it.  Until then the table is
    what it was, so a merge that fails at any step leaves the old version, and a
    second writer gets ``MergeConflict``.  A manifest cut short by a failure has
    no last line and counts as none.  A replayed merge changes nothing.

    Buckets that no update touches are neither read nor written.  Of the others
    the stored rows aren't shuffled if the updates are small (their files say
    so): they meet the broadcast keys where they are read.  ``buckets`` should
    be about the table's bytes / 1 GB times the inverse share that a batch
    touches, if batches come clustered by key.  A bucket that has come to more
    than ``max_files`` files is written as one.  With ``evolving``, updates may
    bring new columns; older rows read NULL there.  ``bucket_by`` may name some of
    the keys, so that rows that agree there share a bucket.  ``vacuum`` deletes the folders
    that no kept version names."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], seq: Sequence[str] = (),
                 buckets: int | None = None, broadcast_bytes: int = 64 << 20, max_files: int = 8,
                 evolving: bool = False, bucket_by: Sequence[str] = ()):
        self.spark, self.root, self.keys, self.seq = spark, root.rstrip("/"), list(keys), list(seq)
        self.bucket_by = list(bucket_by) or self.keys
        self.broadcast_bytes, self.max_files, self.evolving = broadcast_bytes, max_files, evolving
        self.buckets = self._fixed_buckets(buckets)

    def _fixed_buckets(self, wanted: int | None) -> int:
        """The number of buckets is fixed when the table is first opened."""
        path = f"{self.root}/buckets"
        have = read_text_file(self.spark, path)
        if not have:
            n = wanted or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            if create_text_file(self.spark, path, f"{n}\n{_END}"):
                return n
            have = read_text_file(self.spark, path)
        lines = have.split("\n")
        if lines[-1] != _END:
            raise RuntimeError(f"{path} is cut short; delete it if the table is empty")
        return int(lines[0])

    def _manifests(self) -> list[int]:
        return sorted(int(n) for n in list_names(self.spark, f"{self.root}/manifest") if n.isdigit())

    def _manifest(self, n: int) -> dict[int, str] | None:
        lines = (read_text_file(self.spark, f"{self.root}/manifest/{n}") or "").split("\n")
        if lines[-1] != _END:
            return None
        return {int(b): folder for b, folder in (line.split("\t") for line in lines[:-1])}

    def _latest(self) -> tuple[int, dict[int, str]]:
        for n in reversed(self._manifests()):
            live = self._manifest(n)
            if live is not None:
                return n, live
        return 0, {}

    def version(self) -> int:
        return self._latest()[0]

    def _paths(self, live: dict[int, str], only: Sequence[int] | None = None) -> list[str]:
        chosen = live if only is None else [b for b in only if b in live]
        return [f"{self.root}/data/{live[b]}/{BUCKET}={b}" for b in chosen]

    def read(self, version: int | None = None) -> DataFrame | None:
        """The table's latest (or an earlier, not yet vacuumed) version."""
        live = self._latest()[1] if version is None else self._manifest(version)
        paths = self._paths(live or {})
        return self._load(paths) if paths else None

    def _load(self, paths: list[str]) -> DataFrame:
        return self.spark.read.option("mergeSchema", self.evolving).parquet(*paths)

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int"))

    def buckets_of(self, rows: DataFrame) -> DataFrame | None:
        """The stored rows of all buckets that ``rows`` (with the columns of
        ``bucket_by``) fall into; None without any."""
        touched = [r[0] for r in self._bucketed(rows.select(*self.bucket_by)).select(BUCKET).distinct().collect()]
        paths = self._paths(self._latest()[1], sorted(touched))
        return self._load(paths) if paths else None

    def _write(self, rows: DataFrame, folder: str) -> None:
        rows.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.root}/data/{folder}")

    def merge(self, updates: DataFrame) -> DataFrame | None:
        """Merge ``updates`` (several rows of a key: the latest, or any one)."""
        n, live = self._latest()
        last = max(self._manifests(), default=0)
        best = (latest_per_key(updates, self.keys, self.seq) if self.seq
                else updates.dropDuplicates(self.keys))
        staged = f"staged-{uuid.uuid4().hex}"
        # one row for each key now, so its hash deals the rows evenly
        self._write(self._bucketed(best).repartition(BUCKET), staged)
        touched = partition_values(self.spark, f"{self.root}/data/{staged}", BUCKET)
        if not touched:
            return self.read()
        new = self.spark.read.parquet(f"{self.root}/data/{staged}")
        old = self._paths(live, touched)
        folder = staged
        if old:
            folder = f"v-{uuid.uuid4().hex}"
            # many updates that win are compared with the stored rows in their buckets
            dealt = not self.seq and folder_bytes(self.spark, f"{self.root}/data/{staged}") > self.broadcast_bytes
            stored = self._bucketed(self._load(old))
            merged = self._replaced(stored, new) if dealt else self._merged(stored, new, f"{self.root}/data/{staged}")
            # rows stay where they are read, so each merge leaves a file more in its buckets
            folders = {live[b] for b in touched if b in live}
            if max(files_in(self.spark, f"{self.root}/data/{f}") for f in folders) > self.max_files and not dealt:
                merged = merged.repartition(BUCKET)
            self._write(merged, folder)
        lines = [f"{b}\t{f}" for b, f in sorted({**live, **dict.fromkeys(touched, folder)}.items())]
        if not create_text_file(self.spark, f"{self.root}/manifest/{last + 1}", "\n".join([*lines, _END])):
            raise MergeConflict(f"version {last + 1} of {self.root} exists; merge again")
        return self.read()

    def _merged(self, stored: DataFrame, new: DataFrame, staged: str) -> DataFrame:
        """``stored`` less what ``new`` replaces, and ``new`` less what a later
        stored row beats.  Keys are compared as structs, in which NULLs agree."""
        small = folder_bytes(self.spark, staged) <= self.broadcast_bytes
        side = F.broadcast if small else (lambda df: df.hint("merge"))
        stored, new = (df.withColumn("__k", F.struct(*self.keys)) for df in (stored, new))
        if self.seq:
            marks = new.select("__k", F.struct(*self.seq).alias("__new"))
            beaten = materialize(stored.join(side(marks), "__k").where(F.struct(*self.seq) >= F.col("__new"))
                                 .select("__k"), "merge_beaten")
            new = new.join(side(beaten), "__k", "left_anti")
        kept = stored.join(side(new.select("__k")), "__k", "left_anti")
        return kept.unionByName(new, allowMissingColumns=True).drop("__k")

    def _replaced(self, stored: DataFrame, new: DataFrame) -> DataFrame:
        """The same for many updates that win: both are dealt to the buckets, where
        they are to be written, and compared there, so the stored rows are
        shuffled once."""
        both = stored.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True)
        keys = [BUCKET, *self.keys]
        rest = [c for c in both.columns if c not in (*keys, "__new")]
        row = F.max_by(F.struct(F.lit(1).alias("__"), *rest), "__new").alias("__row")
        return both.repartition(BUCKET).groupBy(*keys).agg(row).select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])

    def vacuum(self, keep: int = 1) -> int:
        """Delete data folders that none of the latest ``keep`` versions names
        (uncommitted ones, too: no merge may be running), and older manifests;
        how many folders went."""
        whole = [(n, live) for n in self._manifests() if (live := self._manifest(n)) is not None][-keep:]
        if not whole:
            return 0
        needed = {folder for _, live in whole for folder in live.values()}
        # manifests first: no version may name what is gone
        for n in self._manifests():
            if n < whole[0][0]:
                delete_path(self.spark, f"{self.root}/manifest/{n}")
        gone = [f for f in list_names(self.spark, f"{self.root}/data") if f not in needed]
        for f in gone:
            delete_path(self.spark, f"{self.root}/data/{f}")
        return len(gone)


def append_evolving(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Schema-evolving append: columns missing on either side become NULL."""
    return existing.unionByName(new, allowMissingColumns=True)


def run_summary(spark: SparkSession, status: DataFrame, key: str = "table") -> str:
    """Machine-readable JSON summary of a status frame (registry-sized)."""
    row = status.agg(F.to_json(F.collect_list(F.struct(*status.columns))).alias("j")).first()
    return row["j"] or "[]"

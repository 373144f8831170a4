"""Shared helpers of the training-data operators."""

from __future__ import annotations

import re
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SALTS = 32                 # parts a hot group is split into before it is aggregated
PIECE_BYTES = 4 << 20      # text bytes a task holds as numpy arrays at once
SMALL_PIECE = 1 << 18      # the same of steps with many 64-bit arrays, which a worker keeps the memory of
BATCH_ROWS = 1000          # rows of an Arrow batch, which the JVM and the worker hold whole
_BATCH_KEY, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` less the columns that clash (case-insensitively) with ``names``."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def whole(df: DataFrame) -> DataFrame:
    """``df`` as one column ``_row``: no name of its own can clash with a key."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once for each Spark
    context (what ``--py-files`` does, for sessions that lack it)."""
    sc = spark.sparkContext
    if getattr(sc, "_stratum_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="stratum-py-")) / "stratum_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(target))
    sc._stratum_shipped = True


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str | StructType) -> DataFrame:
    """``mapInArrow`` in batches of ``BATCH_ROWS``, unless the session has a
    size of its own: Spark's default of 10,000 whole texts is some 20 MB, and
    an executor holds several copies for each of its tasks."""
    spark = df.sparkSession
    ship(spark)
    if spark.conf.get(_BATCH_KEY) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_KEY, str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def pieces(batches: Iterator[pa.RecordBatch], column: str,
           limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Re-cut Arrow batches so that each holds at most ``limit`` bytes of
    ``column`` (one row at least), which bounds the arrays made from it."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = np.diff(utf8(batch.column(column))[1])
        start, held = 0, 0
        for i, n in enumerate(size.tolist()):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        yield batch.slice(start)


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column in one buffer, and the offsets of its rows in
    that buffer.  A null row has no bytes."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[array.offset:array.offset + len(array) + 1].astype(np.int64) \
        if len(array) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def code_points(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points (uint32) of all rows in one array, and the rows' offsets."""
    raw, at = utf8(array)
    points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    if len(points) == len(raw):
        return points, at
    return points, at - np.searchsorted(np.flatnonzero((raw & 0xC0) == 0x80), at)


def segment_sum(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (rows of a 1-d or 2-d array) by segment; 0 where a
    segment is empty."""
    n = len(at) - 1
    out = np.zeros((n, *values.shape[1:]), np.float64)
    full = np.flatnonzero(np.diff(at) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, at[full], axis=0, dtype=np.float64)
    return out


def salt(*cols: str | Column, parts: int | Column = SALTS) -> Column:
    return F.pmod(F.xxhash64(*cols), parts if isinstance(parts, Column) else F.lit(parts)).cast("int")


def by_group(df: DataFrame, keys: Sequence[str], salt_on: Sequence[str | Column],
             measures: dict[str, tuple[Callable[[str | Column], Column], str | Column,
                                       Callable[[str | Column], Column]]],
             parts: int = SALTS) -> tuple[DataFrame, DataFrame]:
    """Two-level aggregate of ``df`` that no hot key can overload.

    Returns ``(rows, groups)``: ``rows`` is ``df`` with ``_salt``; ``groups``
    has one row per (keys, _salt) that occurs, with the measures of the whole
    group, so that ``rows`` join it on (keys, _salt): a group with a third of
    all rows is dealt to ``parts`` tasks both times.
    ``measures``: name -> (inner aggregate, input, outer aggregate).
    """
    rows = df.withColumn("_salt", salt(*salt_on, parts=parts))
    inner = rows.groupBy(*keys, "_salt").agg(
        *[first(col).alias(n) for n, (first, col, _) in measures.items()])
    outer = inner.groupBy(*keys).agg(
        F.collect_set("_salt").alias("_salts"),
        *[second(F.col(n)).alias(n) for n, (_, _, second) in measures.items()])
    return rows, outer.withColumn("_salt", F.explode("_salts")).drop("_salts")


def numbered(df: DataFrame, group: str, order: Sequence[str | Column], spread: Sequence[str | Column],
             name: str, parts: int | Column = 64) -> DataFrame:
    """``df`` with ``name``: a number from 0 without gaps within ``group``.

    A group is numbered in ``parts`` sub-groups (by the hash of ``spread``),
    whose sizes give their first numbers, so that no task holds a whole group.
    The sizes are at most groups x parts rows; ``group`` must be a bounded set.
    """
    sub = df.withColumn("_nm_sub", salt(*spread, parts=parts))
    sizes = sub.groupBy(F.col(group).alias("_nm_group"), F.col("_nm_sub").alias("_nm_part")).agg(
        F.count("*").alias("_nm_n"))
    before = Window.partitionBy("_nm_group").orderBy("_nm_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_nm_group", "_nm_part",
                         F.coalesce(F.sum("_nm_n").over(before), F.lit(0)).alias("_nm_first"))
    inside = Window.partitionBy(group, "_nm_sub").orderBy(*order)
    return (sub.withColumn("_nm_rank", F.row_number().over(inside) - 1)
            .join(sizes, (F.col(group) == F.col("_nm_group")) & (F.col("_nm_sub") == F.col("_nm_part")))
            .withColumn(name, F.col("_nm_rank") + F.col("_nm_first"))
            .drop("_nm_rank", "_nm_group", "_nm_part", "_nm_sub", "_nm_first"))



_CHUNK = re.compile(r"(?= \S)")


def chunks(text: str) -> list[str]:
    """Cut before each space that a character other than white space follows:
    there, byte-level BPE patterns always end a match, whatever came before."""
    parts = text.split(" ")
    if all(parts) and not any(p[0].isspace() for p in parts[1:]):
        return [parts[0], *[" " + p for p in parts[1:]]]
    return [c for c in _CHUNK.split(text) if c]


class Recent:
    """A memo of ``make`` for short strings; it holds the latest ``size`` to
    twice ``size`` results."""

    def __init__(self, make: Callable[[str], bytes], size: int, longest: int = 64):
        self.make, self.size, self.longest = make, size, longest
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def get(self, key: str) -> bytes:
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is None:
                found = self.make(key)
                if len(key) > self.longest:
                    return found
            self.put(key, found)
        return found

    def put(self, key: str, value: bytes) -> None:
        if len(self.new) >= self.size:
            self.old, self.new = self.new, {}
        self.new[key] = value

"""Incremental bronze ingest (SRC1, SRC3, SRC8, SNK1, SNK2, SNK6, STR1-3).

Each registry entry becomes one Structured Streaming query: the lines of its
landed files -> columns by each file's own header or keys -> an append-only
parquet table with its own checkpoint.  ``availableNow`` processes everything
new and stops; the file-source log in the checkpoint makes a re-run add 0
rows.  A micro-batch writes the folder ``_micro_batch=<n>`` and replaces it if
it is run again after a failure, so a replay adds no rows either.  All present
sources are started first and awaited afterwards, so they ingest concurrently;
a source that fails gets the status ERROR and leaves the others alone.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from stratum.operators.governance import tag_columns
from stratum.sources.files import (RESCUED, Source, create_text_file, has_files, list_names, parse_csv,
                                   parse_json, read_text_file, text_lines)

STATUS_SCHEMA = "table string, status string, folder string"
MICRO_BATCH = "_micro_batch"
METADATA = (RESCUED, "_source_file", "_ingest_ts", "_batch_id", MICRO_BATCH)
FILES_PER_BATCH = 10_000        # bounds the headers that a micro-batch brings to the driver


def _column_log(spark: SparkSession, target: str) -> tuple[int, list[str] | None]:
    """The latest version of the table's columns and its number."""
    for n in sorted((int(x) for x in list_names(spark, f"{target}/_columns") if x.isdigit()), reverse=True):
        lines = (read_text_file(spark, f"{target}/_columns/{n}") or "").split("\n")
        if lines[-1] == "end":          # not cut short by a failure
            return n, [json.loads(x) for x in lines[:-1]]
    return 0, None


def table_columns(spark: SparkSession, target: str) -> list[str] | None:
    """The data columns that a bronze table has so far."""
    return _column_log(spark, target)[1]


def log_columns(spark: SparkSession, target: str, columns: Sequence[str]) -> None:
    """Make ``columns`` the table's columns: a new version, if they are new.
    Versions are never changed, so a reader sees one or the next."""
    n, have = _column_log(spark, target)
    if have == list(columns):
        return
    text = "\n".join([*map(json.dumps, columns), "end"])
    taken = [int(x) for x in list_names(spark, f"{target}/_columns") if x.isdigit()]
    if not create_text_file(spark, f"{target}/_columns/{max([n, *taken]) + 1}", text):
        raise RuntimeError(f"another writer changes the columns of {target}")


def read_bronze(spark: SparkSession, target: str) -> DataFrame:
    """The table on its latest columns: files from before a column was added
    read NULL there."""
    columns = table_columns(spark, target)
    plain = spark.read.parquet(target)
    if columns is None:
        return plain
    tags = {f.name: f.metadata for f in plain.schema.fields}
    fields = [StructField(c, StringType(), True, tags.get(c) or {}) for c in columns]
    rest = [f for f in plain.schema.fields if f.name in METADATA]
    return spark.read.schema(StructType(fields + rest)).parquet(target)


def start_ingest(spark: SparkSession, src: Source, landing: str, target: str, checkpoint: str,
                 batch_id: str, json_fields: Sequence[str] = (),
                 processing_time: str | None = None, evolve: bool = False) -> StreamingQuery:
    """One source -> one append-only bronze table.  Triggered mode
    (``availableNow``, the default) catches up and stops; continuous mode
    (``processing_time="1 minute"``) keeps polling the landing folder.

    The table's columns are those of the registry (or ``json_fields``), else
    those of its first files; other files are matched by name, and what the
    table has no column for goes to ``_rescued_data``.  With ``evolve``, such a
    column is added to the table instead (``read_bronze`` gives all of them)."""
    if src.fmt not in ("csv", "json"):
        raise ValueError(f"streaming ingest does not support {src.fmt!r}")
    folder = f"{landing.rstrip('/')}/{src.subdir}"

    def land(lines: DataFrame, number: int) -> None:
        canonical = table_columns(spark, target) or list(json_fields) or list(src.columns) or None
        rows = (parse_csv(lines, src, canonical, evolve) if src.fmt == "csv"
                else parse_json(lines, canonical, evolve))
        log_columns(spark, target, [c for c in rows.columns if c not in METADATA])
        rows = rows.withColumns({"_ingest_ts": F.current_timestamp(), "_batch_id": F.lit(batch_id)})
        # PII tags travel as field metadata into the bronze files; names are
        # matched case-insensitively and unknown ones only warn
        rows = tag_columns(rows, {c: {"pii": "true"} for c in src.pii})
        rows.write.mode("overwrite").parquet(f"{target}/{MICRO_BATCH}={number}")

    lines = text_lines(spark.readStream.option("maxFilesPerTrigger", FILES_PER_BATCH), folder, src)
    w = (lines.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
         .queryName(f"ingest_{src.table}_{batch_id[:8]}"))
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    return w.start()


def ingest_all(spark: SparkSession, sources: Sequence[Source], landing: str, bronze_root: str,
               checkpoint_root: str, json_fields: dict[str, Sequence[str]] | None = None,
               batch_id: str | None = None, evolve: bool = False) -> DataFrame:
    """Ingest every present source; absent ones get ``SKIPPED_no_file``.
    Returns a status frame (table, status, folder)."""
    batch_id = batch_id or str(uuid.uuid4())
    json_fields = json_fields or {}
    started, status = [], []
    for src in sources:
        folder = f"{landing.rstrip('/')}/{src.subdir}"
        try:
            if not has_files(spark, folder, src.pattern):
                status.append((src.table, "SKIPPED_no_file", folder))
                continue
            started.append((src, start_ingest(spark, src, landing, f"{bronze_root}/{src.table}",
                                              f"{checkpoint_root}/{src.table}", batch_id,
                                              json_fields.get(src.table, ()), evolve=evolve), folder))
        except Exception as e:  # noqa: BLE001 - the status of this source
            status.append((src.table, f"ERROR:{type(e).__name__}", folder))
    for src, q, folder in started:
        try:
            q.awaitTermination()
            status.append((src.table, "OK", folder))
        except Exception as e:  # noqa: BLE001 - the status of this source
            status.append((src.table, f"ERROR:{type(e).__name__}", folder))
    return spark.createDataFrame(status, STATUS_SCHEMA)

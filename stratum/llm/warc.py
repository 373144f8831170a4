"""WARC archives: writing, and reading by boundary-chain verification
(operator 10).

Writing.  Each partition of pages becomes one archive of WARC/1.1 records.
Payloads of at least ``min_revisit`` bytes that another page with a smaller
page_id has too are written as ``revisit`` records without the payload.

Reading.  An archive can be cut anywhere.  Tasks split their part of the file at
the magic ``WARC/1.``, and each hit is a candidate record: from its header come
its offset and that of its successor (offset + header + Content-Length +
CRLF CRLF).  A magic inside a payload is a candidate too, so what counts is the
chain of successors from the start of the file.  In chunks of the file the
chain is contracted: each candidate gets the first offset at which its chain
leaves the chunk.  Pointer jumping over these exits (each round doubles the
distance) finds in log2(chunks) rounds the offsets at which the chain from 0
enters each chunk, and a walk through each chunk marks its records.  A record
whose payload holds the magic is put together again from its segments, which a
second read finds by their SHA-256; that read may be split otherwise.

Defined results: null html is an empty payload; null url is empty; a null
page_id sorts last and reads back as null; rows that repeat a page_id and its
payload are records of the same type; a long payload is one record; only
page_id, url and html are read, so other columns, whatever their names, don't
matter.  Where a chain breaks (a damaged file),
the records before the damage are returned.  No pages, no records.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratum.llm.common import by_group, ship
from stratum.session import scratch_path
from stratum.sinks import materialize

MAGIC = "WARC/1."
EOL = "\r\n"
END = EOL + EOL
ID = "urn:x-page:"
LAST = (1 << 63) - 1            # a null page_id's place in the order
CHUNK = 4 << 20                 # bytes of an archive whose candidates one task contracts


def _payload() -> Column:
    return F.coalesce(F.col("html"), F.lit(""))


def revisits(pages: DataFrame, min_revisit: int = 100) -> DataFrame:
    """``_key, _digest, refers_to`` of the pages whose payload a page with a
    smaller page_id has."""
    rows = materialize(pages.select(
        F.coalesce(F.col("page_id").cast("bigint"), F.lit(LAST)).alias("_key"),
        F.sha2(_payload(), 256).alias("_digest"), F.octet_length(_payload()).alias("_n"))
        .where(F.col("_n") >= min_revisit).select("_key", "_digest"), "warc_digests")
    salted, groups = by_group(rows, ["_digest"], ["_key"],
                              {"_first": (F.min, "_key", F.min), "_many": (F.max, "_key", F.max)})
    copies = groups.where(F.col("_many") > F.col("_first"))
    return (salted.join(copies, ["_digest", "_salt"]).where(F.col("_key") > F.col("_first"))
            .select("_key", "_digest", F.col("_first").alias("refers_to")).distinct())


def records(pages: DataFrame, min_revisit: int = 100) -> DataFrame:
    """One string per page: its record, less the closing CRLF CRLF."""
    # written first: if the copies are few, Spark sees so and the payloads needn't move
    copies = materialize(revisits(pages, min_revisit), "warc_revisits")
    own = pages.select(F.coalesce(F.col("page_id").cast("bigint"), F.lit(LAST)).alias("_key"),
                       F.col("page_id").cast("string").alias("_id"),
                       F.coalesce(F.col("url"), F.lit("")).alias("_url"),
                       _payload().alias("_body"), F.sha2(_payload(), 256).alias("_digest"))
    own = own.join(copies, ["_key", "_digest"], "left")
    again = F.col("refers_to").isNotNull()
    uri = F.replace(F.replace(F.col("_url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "),
                    F.octet_length("_body"), F.lit(END))
    block = F.when(again, http).otherwise(F.concat(http, F.col("_body")))
    named = F.coalesce(F.col("_id"), F.lit("none"))
    head = F.concat(
        F.lit(f"{MAGIC}1{EOL}WARC-Type: "), F.when(again, "revisit").otherwise("response"),
        F.lit(f"{EOL}WARC-Record-ID: <{ID}"), named, F.lit(f">{EOL}WARC-Target-URI: "), uri,
        F.lit(f"{EOL}WARC-Date: 1970-01-01T00:00:00Z{EOL}WARC-Payload-Digest: sha256:"), F.col("_digest"),
        F.when(again, F.concat(
            F.lit(f"{EOL}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                  f"{EOL}WARC-Refers-To: <{ID}"), F.col("refers_to").cast("string"), F.lit(">")))
        .otherwise(F.lit("")),
        F.lit(f"{EOL}Content-Type: application/http;msgtype=response{EOL}Content-Length: "),
        F.octet_length(block), F.lit(END))
    return own.select(F.concat(head, block).alias("value"))


def write(pages: DataFrame, path: str, min_revisit: int = 100) -> None:
    """Write archives under ``path``: CRLF CRLF ends each record."""
    records(pages, min_revisit).write.option("lineSep", END).option("compression", "none").text(path)


def _field(head: str, name: str, pattern: str) -> Column:
    return F.regexp_extract(F.col(head), rf"(?i)\r\n{name}: *{pattern}", 1)


def _facts(value: Column, extra: list[Column]) -> list[Column]:
    return [*extra, F.octet_length(value).cast("bigint").alias("n"),
            F.substring_index(value, END, 1).alias("head"), value.cast("binary").alias("raw")]


def _parsed(found: DataFrame, keep: list[str]) -> DataFrame:
    """Header fields of segments (``n, head, raw``; after the magic) and the
    facts of the content as far as the segment holds it."""
    content = F.col("head_n") + len(END)
    http = F.substring_index(F.expr("substring(raw, CAST(head_n + 5 AS INT))").cast("string"), END, 1)
    return (found
            .withColumn("head_n", F.octet_length("head").cast("bigint"))
            .withColumn("length", _field("head", "Content-Length", r"(\d{1,18})").try_cast("bigint"))
            .withColumn("valid", F.col("head").rlike(r"^\d\r\n") & (F.col("head_n") < F.col("n"))
                        & F.col("length").isNotNull())
            .withColumn("whole", F.col("valid") & (F.col("n") >= content + F.col("length") + len(END)))
            .withColumn("http_n", F.when(F.col("whole"), F.octet_length(http)).cast("bigint"))
            .withColumn("http", F.when(F.col("whole"), http))
            .withColumn("body", F.expr(
                "CASE WHEN whole THEN substring(raw, CAST(head_n + http_n + 9 AS INT),"
                " CAST(greatest(length - http_n - 4, 0) AS INT)) END"))
            .select(*keep, "n", "head_n", "length", "valid", "whole", F.sha2("raw", 256).alias("digest"),
                    _field("head", "WARC-Type", r"(\w+)").alias("record_type"),
                    _field("head", "WARC-Record-ID", rf"<{ID}(-?\d+)>").try_cast("bigint").alias("page_id"),
                    _field("head", "WARC-Refers-To", rf"<{ID}(-?\d+)>").try_cast("bigint").alias("refers_to"),
                    _field("head", "WARC-Payload-Digest", r"sha256:([0-9a-f]{64})").alias("said_digest"),
                    _field("http", "Content-Length", r"(\d{1,18})").try_cast("bigint").alias("said_bytes"),
                    F.octet_length("body").cast("bigint").alias("body_bytes"),
                    F.sha2("body", 256).alias("body_digest")))


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The archives' bytes split at the magic: ``file, block, seq, value``.
    ``seq`` orders the segments of a block (the part of a file that a task reads)."""
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("seq"), "value"))


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Each segment with its ``offset`` (of its magic, less 0 for what stands
    before the first) and, for candidate records, its ``successor``."""
    found = segments(spark, path)
    slim = materialize(_parsed(found.select(*_facts(F.col("value"), [F.col(c) for c in ("file", "block", "seq")])),
                               ["file", "block", "seq"]), "warc_segments")
    step = F.col("n") + len(MAGIC)
    blocks = slim.groupBy("file", "block").agg(F.sum(step).alias("bytes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("start"),
                           (F.sum("bytes").over(Window.partitionBy("file")) - len(MAGIC)).alias("file_bytes"))
    inside = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (slim.withColumn("_in", F.coalesce(F.sum(step).over(inside), F.lit(0)))
            .join(blocks, ["file", "block"])
            # the segment follows its magic
            .withColumn("offset", F.col("start") + F.col("_in") - len(MAGIC))
            .withColumn("successor", F.when(F.col("valid"), F.col("offset") + len(MAGIC) + F.col("head_n")
                                            + F.col("length") + 2 * len(END)))
            .drop("start", "_in"))


def _contract(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("offset", ascending=False)
    chunk_end = (int(part["chunk"].iloc[0]) + 1) * int(part["chunk_bytes"].iloc[0])
    leaves: dict[int, int] = {}
    for at, successor in zip(part["offset"].tolist(), part["successor"].tolist()):
        # -1: the chain ends inside the chunk, at what is no candidate
        leaves[at] = leaves.get(successor, -1) if successor < chunk_end else successor
    return _offsets(part, list(leaves)).assign(leaves=np.array(list(leaves.values()), np.int64))


def _offsets(part: pd.DataFrame, offsets: list[int]) -> pd.DataFrame:
    file = np.array([part["file"].iloc[0]] * len(offsets), object)
    return pd.DataFrame({"file": file, "offset": np.array(offsets, np.int64)})


def _mark(part: pd.DataFrame) -> pd.DataFrame:
    part = part.sort_values("offset")
    next_at = {o: s for o, s in zip(part["offset"].tolist(), part["successor"].tolist())}
    reached = set()
    for at in part.loc[part["entered"], "offset"].tolist():
        while at in next_at and at not in reached:
            reached.add(at)
            at = next_at[at]
    return _offsets(part, sorted(reached))


def chain(found: DataFrame, chunk_bytes: int = CHUNK) -> DataFrame:
    """``file, offset`` of the candidates that the chain from the start of
    their file reaches.  ``found``: ``file, offset, successor, file_bytes``."""
    ship(found.sparkSession)
    nodes = materialize(found.where("valid").select(
        "file", "offset", "successor", "file_bytes",
        F.floor(F.col("offset") / chunk_bytes).alias("chunk"), F.lit(chunk_bytes).alias("chunk_bytes")),
        "warc_candidates")
    longest = nodes.agg(F.max("file_bytes").alias("n")).first()["n"] or 0
    exits = nodes.select("file", "chunk", "chunk_bytes", "offset", "successor").groupBy("file", "chunk") \
        .applyInPandas(_contract, "file string, offset bigint, leaves bigint")
    jump = materialize(exits, "warc_exits")
    # only places at which some chain enters a chunk can be jumped from
    entries = jump.select("file", F.col("leaves").alias("offset")).union(
        jump.select("file", F.lit(0).cast("bigint").alias("offset"))).distinct()
    jump = materialize(jump.join(entries, ["file", "offset"], "left_semi"), "warc_jumps")
    reached = jump.where("offset = 0").select("file", "offset")
    rounds = max(0, (longest // chunk_bytes)).bit_length()
    for k in range(rounds):
        onward = (reached.join(jump, ["file", "offset"]).select("file", F.col("leaves").alias("offset"))
                  .where("offset >= 0"))
        reached = materialize(reached.union(onward).distinct(), f"warc_reached_{k}")
        if k + 1 < rounds:
            far = jump.select("file", F.col("offset").alias("leaves"), F.col("leaves").alias("far"))
            jump = materialize(jump.join(far, ["file", "leaves"]).select(
                "file", "offset", F.col("far").alias("leaves")), f"warc_jump_{k}")
    entered = nodes.join(reached.withColumn("_hit", F.lit(True)), ["file", "offset"], "left")
    return (entered.select("file", "chunk", "offset", "successor", F.col("_hit").isNotNull().alias("entered"))
            .groupBy("file", "chunk").applyInPandas(_mark, "file string, offset bigint"))


def read(spark: SparkSession, path: str, chunk_bytes: int = CHUNK) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of the
    archives' records.  A response's payload is measured, a revisit's is as the
    record says."""
    found = materialize(candidates(spark, path), "warc_found")
    reached = materialize(chain(found, chunk_bytes), "warc_reached")
    real = found.join(reached, ["file", "offset"], "left_semi")
    fields = ["record_type", "page_id", "refers_to", "said_digest", "said_bytes", "body_bytes", "body_digest"]
    good = real.where("whole").select(*fields)
    cut = real.where("NOT whole AND successor <= file_bytes").select("file", "offset", "successor")
    cut = materialize(cut, "warc_cut")
    if not cut.isEmpty():
        good = good.unionByName(_rejoined(spark, path, found, cut, chunk_bytes).select(*fields))
    seen = F.col("record_type") == "revisit"
    return good.select(
        "page_id", F.when(seen, F.col("said_bytes")).otherwise(F.col("body_bytes")).alias("payload_bytes"),
        F.when(seen, F.col("said_digest")).otherwise(F.col("body_digest")).alias("payload_digest"),
        "record_type", F.when(seen & (F.col("refers_to") != LAST), F.col("refers_to")).alias("refers_to"))


def _rejoined(spark: SparkSession, path: str, found: DataFrame, cut: DataFrame, bin_bytes: int) -> DataFrame:
    """Records whose payload holds the magic, from all their segments: an
    equi-join on (file, bin) finds the segments that a record covers."""
    bins = F.sequence(F.floor(F.col("from") / bin_bytes), F.floor((F.col("to") - 1) / bin_bytes))
    spans = (cut.select("file", F.col("offset").alias("from"), F.col("successor").alias("to"))
             .withColumn("bin", F.explode(bins)))
    parts = found.select("file", "offset", "digest",
                         F.floor(F.greatest(F.col("offset"), F.lit(0)) / bin_bytes).alias("bin"))
    wanted = materialize(parts.join(spans, ["file", "bin"])
                         .where((F.col("offset") >= F.col("from")) & (F.col("offset") < F.col("to")))
                         .select("file", "from", "offset", "digest"), "warc_parts")
    # a segment is the same text however the files are split for this second read, so its
    # digest finds it: neither the split nor the order of tasks has to be that of the first
    rows, groups = by_group(wanted, ["digest"], ["file", "from", "offset"], {"_n": (F.count, "offset", F.sum)})
    texts = (segments(spark, path).select(F.sha2("value", 256).alias("digest"), "value")
             .join(wanted.select("digest"), "digest", "left_semi")
             .groupBy("digest").agg(F.first("value").alias("value")))
    texts = rows.join(groups.join(texts, "digest"), ["digest", "_salt"])
    whole = (texts.groupBy("file", "from").agg(F.sort_array(F.collect_list(F.struct("offset", "value"))).alias("p"))
             .select("file", F.array_join(F.col("p.value"), MAGIC).alias("value")))
    return _parsed(whole.select(*_facts(F.col("value"), [F.col("file")])), ["file"]).where("whole")


def round_trip(pages: DataFrame, min_revisit: int = 100, chunk_bytes: int = CHUNK) -> DataFrame:
    """Write the pages' archives to the shared folder and read them back."""
    path = scratch_path(pages.sparkSession, "warc")
    write(pages, path, min_revisit)
    return read(pages.sparkSession, path, chunk_bytes)

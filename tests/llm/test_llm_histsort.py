import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from stratum.llm import histsort, queries

from conftest import SF_SMALL
from llm_traps import no_docs, trap_docs  # noqa: F401


def law(rows, shards):
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))
    assert all(0 <= s < shards for s in sizes)
    return sizes


def test_sizes_are_as_near_as_rows_allow(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = queries.op9_histsort(spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(text)
    for r in rows:
        raw = text[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
    sizes = law(rows, 40)
    largest = max(r.size for r in rows)
    for shards in (2, 3, 7):
        sizes = law(histsort.shard(docs, shards).collect(), shards)
        assert max(sizes.values()) - min(sizes.values()) <= 2 * largest


def test_splitters_match_a_full_sort(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab"), (F.col("id") % 50).cast("int"))
                                    .alias("text"))
    out = histsort.shard(docs, 8, tolerance=0.0).withColumn("h", F.xxhash64("text")).collect()
    sizes = law(out, 8)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in out)
    order = sorted(out, key=lambda r: ((r.h % (1 << 64)) >> 4, r.shard))
    assert [r.shard for r in order] == sorted(r.shard for r in out)     # shards are ranges of the key


def test_a_group_larger_than_a_shard_is_divided(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "copy")
                                    .otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"))
    rows = histsort.shard(docs, 20).collect()
    sizes = law(rows, 20)
    assert max(sizes.values()) <= 1.01 * sum(sizes.values()) / 20 + 40
    spread = Counter(r.shard for r in rows if r.text == "copy")
    assert len(spread) >= 7
    # equal texts are neighbours: only shards at the group's ends hold others, too
    assert sum(any(r.shard == s and r.text != "copy" for r in rows) for s in spread) <= 2


def test_traps(trap_docs, no_docs, spark):
    rows = histsort.shard(trap_docs, 5).collect()
    law(rows, 5)
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in trap_docs.collect())
    assert {r.size for r in rows if not r.text} == {16}
    assert histsort.shard(no_docs, 5).collect() == []
    one = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    assert [r.slot for r in histsort.shard(one, 40).collect()] == [0]


def test_shards_are_written_whole(spark, trap_docs, tmp_path):
    histsort.write(trap_docs, str(tmp_path / "shards"), 3)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert Counter(r.text for r in back.collect()) == Counter(r.text for r in trap_docs.collect())


def test_query_describes_the_sharded_texts(spark, monkeypatch):
    """A text that changes on its way to the shard shows in the result."""
    shard = histsort.shard
    monkeypatch.setattr(queries.histsort, "shard", lambda docs, shards: shard(docs, shards).withColumn(
        "text", F.when(F.col("doc_id") == 3, "lost").otherwise(F.col("text"))))
    rows = {r.doc_id: r for r in queries.op9_histsort(spark, SF_SMALL).collect()}
    assert (rows[3].size, rows[3].text_crc32) == (4 + histsort.FRAME, zlib.crc32(b"lost"))
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("doc_id <> 3").collect():
        body = (r.text or "").encode()
        assert (rows[r.doc_id].size, rows[r.doc_id].text_crc32) == (len(body) + histsort.FRAME, zlib.crc32(body))

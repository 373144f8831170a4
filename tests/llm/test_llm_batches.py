"""Arrow batches of whole texts are small, unless the session says otherwise,
and features are made of small pieces of them."""

import tracemalloc

import pyarrow as pa

from stratum.llm import langid, minhash, quality
from stratum.llm.common import BATCH_ROWS, SMALL_PIECE, arrow_map

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _sizes(spark):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])
    return [r.n for r in arrow_map(spark.range(0, 5000, 1, 1), run, "n bigint").collect()]


def test_a_task_gets_its_rows_in_small_batches(spark):
    old = spark.conf.get(KEY)
    try:
        spark.conf.unset(KEY)
        got = _sizes(spark)
        assert sum(got) == 5000 and max(got) <= BATCH_ROWS
    finally:
        spark.conf.set(KEY, old)


def test_a_session_keeps_its_own_size(spark):
    old = spark.conf.get(KEY)
    try:
        spark.conf.set(KEY, "123")
        got = _sizes(spark)
        assert sum(got) == 5000 and max(got) <= 123 and spark.conf.get(KEY) == "123"
    finally:
        spark.conf.set(KEY, old)


def _long_batch():
    text = [("wort " * 399 + f"{i}.") for i in range(1000)]          # some 2 MB
    return pa.RecordBatch.from_pydict({"text": pa.array(text), "source": pa.array(["web"] * 1000),
                                       "lang": pa.array(["de"] * 1000)})


def test_features_are_made_of_small_pieces_of_a_batch():
    batch = _long_batch()
    config = quality.QualityConfig()
    for cut in (quality._rows(iter([batch]), config), langid._texts(iter([batch]), "text"),
                minhash._sets(iter([batch]), 5)):
        texts = []
        for piece, *_ in cut:
            own = piece.column("text").to_pylist()
            assert sum(map(len, own)) <= SMALL_PIECE
            texts += own
        assert texts == batch.column("text").to_pylist()


def test_features_hold_little_memory():
    batch, config = _long_batch(), quality.QualityConfig()
    quality._KIND_OF[:] = [quality._kinds()]
    langid._letters()
    for cut in (lambda: quality._rows(iter([batch]), config), lambda: langid._texts(iter([batch]), "text")):
        tracemalloc.start()
        try:
            for _ in cut():
                pass
            assert tracemalloc.get_traced_memory()[1] < 20e6
        finally:
            tracemalloc.stop()

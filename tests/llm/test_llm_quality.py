import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stratum.llm import quality
from stratum.llm.common import code_points
from stratum.llm.quality import QualityConfig

from llm_traps import no_docs, trap_docs  # noqa: F401

SF = "/root/testdata/sf0.01"


def split(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    own = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return docs, labels.where(own), labels.where(~own)


def test_held_out_accuracy(spark):
    docs, train, held = split(spark)
    model = quality.fit(docs, train)
    rows = quality.score(docs, model).join(held, "doc_id").select("quality", "good", "quality_score").collect()
    assert len(rows) > 100
    assert np.mean([r.good == (r.quality == 1) for r in rows]) > 0.97
    assert all(r.good for r in rows if r.quality == 1)          # clean documents stay


def test_few_labels_are_helped_by_the_pool(spark):
    docs, train, held = split(spark)
    config = QualityConfig(labelled=60)
    model = quality.fit(docs, train, config)
    rows = quality.score(docs, model, config).join(held, "doc_id").select("quality", "good").collect()
    assert np.mean([r.good == (r.quality == 1) for r in rows]) > 0.9


def test_only_the_labelled_sample_is_bounded(spark):
    docs, train, _ = split(spark)
    sample, rest = quality.sampled(docs, train, QualityConfig(labelled=40))
    assert len(sample.label) == 40 and set(sample.label.tolist()) <= {0, 1}
    assert rest.count() == docs.count() - 40


def views_of(sample, config):
    rows = np.arange(len(sample.label))
    y = sample.label.astype(float)
    odds = quality.log_odds(sample.bucket_counts(rows, y, config), config)
    meta = quality.logistic(sample.meta, y, 1.0)
    return quality.Views(config, odds, quality._platt(sample.text_mean(odds), y), meta,
                         quality._platt(sample.meta @ meta, y))


def test_one_round_adds_up_all_unlabelled_documents(spark):
    """Against a walk over the documents one by one."""
    docs, train, _ = split(spark)
    config = QualityConfig(labelled=60, bits=10, confident=0.7)
    sample, rest = quality.sampled(docs, train, config)
    views = views_of(sample, config)
    edges = views.edges()
    got = quality.gather(rest.repartition(5), views)
    want = {k: np.zeros(v) for k, v in quality._shapes(views).items()}
    for r in rest.collect():
        batch = pa.RecordBatch.from_pydict({c: pa.array([r[c]], pa.string()) for c in quality.VIEW})
        points, at = code_points(batch.column("text"))
        x = quality.meta_features(batch, points, at, config)[0]
        grams = np.concatenate([b for b, _ in quality.text_buckets(points, at, config)] or [np.zeros(0, int)])
        mean = sum(views.log_odds[g] for g in grams.tolist()) / max(1, len(grams))
        text = float(np.clip(views.text_fit[0] * mean + views.text_fit[1], -12, 12))
        page = float(np.clip(views.meta_fit[0] * (x @ views.meta) + views.meta_fit[1], -12, 12))
        p = 1 / (1 + np.exp(-np.clip(x @ views.meta, -30, 30)))
        want["rows"][0] += 1
        for name, logit in (("by_text", text), ("by_meta", page)):
            bins = [k for k, e in enumerate(edges) if abs(logit) >= e]
            if not bins:
                continue
            k = (logit > 0) * len(edges) + bins[-1]
            want[name][k] += 1
            if name == "by_meta":
                for g in grams.tolist():
                    want["counts"][k * 1024 + g] += np.log1p(len(grams)) / len(grams)
            else:
                want["gradient"][k] += x * ((logit > 0) - p)
                want["curve"][k] += np.outer(x, x) * max(p * (1 - p), 1e-6)
    assert got.rows == want["rows"][0] == docs.count() - 60
    assert got.by_text.ravel().tolist() == want["by_text"].tolist() and got.by_text.sum() > 0
    assert got.by_meta.ravel().tolist() == want["by_meta"].tolist() and got.by_meta.sum() > 0
    for name in ("counts", "gradient", "curve"):
        assert np.abs(getattr(got, name).ravel() - want[name].ravel()).max() < 1e-3


def test_bins_are_handed_over_from_the_top_until_the_share_is_reached():
    sizes = np.array([[5, 4, 3, 2], [0, 0, 9, 0]])
    assert quality.handed_bins(sizes, 4).tolist() == [[False, False, True, True], [False, False, True, True]]
    assert quality.handed_bins(sizes, 2).tolist()[0] == [False, False, False, True]
    assert quality.handed_bins(sizes, 99).all() and not quality.handed_bins(sizes, 0).any()


def test_columns_are_found_in_any_case(spark):
    docs, train, _ = split(spark)
    config = QualityConfig(labelled=60, rounds=1)
    model = quality.fit(docs, train, config)
    plain = {r.doc_id: r.quality_score for r in quality.score(docs, model).select("doc_id", "quality_score").collect()}
    other = docs.withColumnsRenamed({"lang": "Lang", "source": "SOURCE", "text": "Text"})
    scored = quality.score(other, model)
    assert scored.columns[:len(other.columns)] == other.columns
    rows = scored.collect()
    assert {r.doc_id: r.quality_score for r in rows} == plain and all(r.Lang is not None for r in rows)
    kept = quality.keep_good(other.withColumn("Good", F.lit("x")), train, config)
    assert kept.columns == [*other.columns, "Good"] and {r.Good for r in kept.collect()} == {"x"}


def test_text_buckets_count_all_ngrams_of_a_row():
    config = QualityConfig(orders=(2, 3))
    points, at = code_points(pa.array(["abcab", "", None, "x", "ab"]))
    (two, two_at), (three, three_at) = quality.text_buckets(points, at, config)
    assert np.diff(two_at).tolist() == [4, 0, 0, 0, 1] and np.diff(three_at).tolist() == [3, 0, 0, 0, 0]
    assert two[0] == two[3] == two[4] and len(three) == 3


def test_features_of_rows_that_share_a_piece():
    """Against a walk over each row's n-grams, characters and words; a row next
    to others has the features that it has alone."""
    texts = ["Ab ab ab, cd!! 1\n", None, "", "x", " \t", "漢字 é É 12", "ab ab ba ab", "😀 😀"]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    config, names = QualityConfig(), {"text": "text"}
    points, at = code_points(batch.column("text"))
    buckets = quality.text_buckets(points, at, config)
    meta = quality.meta_features(batch, points, at, config, names)
    for i, text in enumerate(texts):
        alone = batch.slice(i, 1)
        own, own_at = code_points(alone.column("text"))
        assert own.tolist() == [ord(c) for c in text or ""]
        assert (quality.meta_features(alone, own, own_at, config, names)[0] == meta[i]).all()
        for order, (bucket, offsets) in zip(config.orders, buckets):
            want = []
            for k in range(len(own) - order + 1):
                h = order
                for c in own[k:k + order].tolist():
                    h = h * 0x9E3779B1 % 2 ** 32
                    h = ((h ^ (h >> 15)) + c) % 2 ** 32
                h = h * 0x85EBCA6B % 2 ** 32
                want.append((h ^ (h >> 13)) * 0xC2B2AE35 % 2 ** 32 >> (32 - config.bits))
            assert bucket[offsets[i]:offsets[i + 1]].tolist() == want
        words = (text or "").translate({ord(c): c.lower() for c in "AB"}).split()
        many = max(1, len(words))
        distinct, again = len(set(words)) / many, sum(a == b for a, b in zip(words, words[1:])) / many
        assert np.allclose(meta[i][[15, 17]], [distinct, again])
        assert np.allclose(meta[i][4:11], np.bincount(
            [quality._KIND_OF[0][min(ord(c), 0xFFFF)] for c in text or ""], minlength=7) / max(1, len(own)))


def test_logistic_matches_the_gradient():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 3))
    y = (x[:, 0] + rng.normal(size=200) > 0).astype(float)
    w = quality.logistic(x, y, 0.5)
    assert np.abs(x.T @ (y - 1 / (1 + np.exp(-x @ w))) - 0.5 * w).max() < 1e-4


def test_traps(spark, trap_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 1, 0), (6, 1, 0), (7, 0, 0), (8, 0, 1), (8, 1, 0), (None, 0, 0), (5, None, 0), (77, 0, 0)],
        "doc_id long, quality int, toxic int")
    model = quality.fit(trap_docs, labels)
    scored = quality.score(trap_docs, model).collect()
    assert len(scored) == trap_docs.count()
    assert all(0 <= r.quality_score <= 1 and r.good is not None for r in scored)
    kept = quality.keep_good(trap_docs, labels)
    assert kept.columns == trap_docs.columns
    assert quality.keep_good(no_docs, labels).collect() == []
    # nothing to learn from: all stay
    one_kind = labels.where("quality = 1 AND doc_id = 1")
    assert quality.keep_good(trap_docs, one_kind).count() == trap_docs.count()
    bare = trap_docs.select("doc_id", "text")
    assert quality.keep_good(bare, labels).columns == ["doc_id", "text"]

"""Quality classifier by co-training (operator 5).

Two views of a document: its text content (hashed character n-grams; a
multinomial naive Bayes on their counts) and its page metadata (source,
language, length and layout: lines, words, letters, capitals, digits, marks,
repeats; a ridge logistic regression).  Both start from the labelled rows.  In
each round every view scores all unlabelled documents and hands its most
confident ones, with its own verdict, to the other view: their n-gram counts to
the text view, their Newton gradients to the metadata view.  Then each view is
calibrated (Platt) on labelled rows that no fit has seen, and a logistic
regression of both calibrated views combines them.  All documents are scored by
both views.

A round is one pass: tasks add up, for each side and each of a few bins of the
teacher's logit, how many documents there are, the n-gram counts and the
gradients; the bins' sizes over all documents then say down to which bin a view
hands over (``hand_over`` of all documents more in each round; the bin in which
that is reached counts whole).  So every document can be handed over, and what
is learned grows with the corpus.  Handed documents of a kind weigh at most as
much as the labelled ones.  Sums are of integers (2 ** -20), so they don't
depend on the order of tasks.

Only the labelled sample is bounded: at most ``labelled`` documents, chosen by
the hash of doc_id, whose features come to the driver (at most 16,384 counts of
6 bytes each).  From a round it gets one number for each bin, bucket and pair of
metadata features.

Defined results: null text is empty and still gets a score, from the metadata;
null source or language is a value of its own, a missing column null; labels
without a quality, or for documents that don't exist, are ignored; where a
document has several labels the lowest counts.  Without both kinds of label
every document is kept with score 0.5.  Rows that repeat a doc_id, or lack one,
are scored one by one; a long text is scored whole; an empty table gives no
rows.  Columns named like results are replaced by ``score`` and left alone by
``keep_good``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from stratum.llm.common import SMALL_PIECE, arrow_map, code_points, pieces, segment_sum, utf8, without
from stratum.llm.minhash import word_hashes
from stratum.sinks import materialize

OUT = ("quality_score", "text_score", "meta_score", "good")


@dataclass(frozen=True)
class QualityConfig:
    bits: int = 14              # hash buckets of the text view
    orders: tuple[int, ...] = (2, 3)
    alpha: float = 1.0
    labelled: int = 4000        # bound of the labelled sample
    rounds: int = 3
    hand_over: float = 0.05     # share of the unlabelled documents a view hands over more in each round
    confident: float = 0.95     # least probability of a pseudo-label
    calibrate: float = 0.3      # share of the labelled sample kept for calibration
    reject_below: float = 0.5
    hashed: int = 64            # one-hot places for source and language


# ---- features ---------------------------------------------------------------

def text_buckets(points: np.ndarray, at: np.ndarray, config: QualityConfig) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each order, the buckets of all n-grams and the rows' offsets."""
    out = []
    n_chars = np.diff(at)
    for order in config.orders:
        if len(points) < order:
            continue
        many = len(points) - order + 1
        inside = np.ones(many, bool)
        for k in range(1, order):           # the last order - 1 places of a row begin none
            last = at[1:] - k
            inside[last[(last >= 0) & (last < many)]] = False
        offsets = np.concatenate(([0], np.cumsum(np.maximum(n_chars - order + 1, 0))))
        out.append((_buckets(points, order, config.bits)[inside].astype(np.intp), offsets))
    return out


STEP = 1 << 15                  # n-grams hashed at once: their arrays stay in a core's cache


def _buckets(points: np.ndarray, order: int, bits: int) -> np.ndarray:
    """The bucket of the n-gram that begins at each of the code points."""
    many = len(points) - order + 1
    out, spare = np.empty(many, np.uint32), np.empty(min(STEP, many), np.uint32)

    def mix(hashed: np.ndarray, factor: int, shift: int) -> None:
        hashed *= np.uint32(factor)
        hashed ^= np.right_shift(hashed, np.uint32(shift), out=spare[:len(hashed)])

    for start in range(0, many, STEP):
        hashed = out[start:start + STEP]
        hashed[:] = order
        for k in range(order):
            mix(hashed, 0x9E3779B1, 15)
            hashed += points[start + k:start + k + len(hashed)]
        mix(hashed, 0x85EBCA6B, 13)
        hashed *= np.uint32(0xC2B2AE35)
        hashed >>= np.uint32(32 - bits)
    return out


_KINDS = ("upper", "lower", "digit", "space", "line", "mark", "far")


def _kinds() -> np.ndarray:
    kind = np.full(1 << 16, _KINDS.index("far"), np.uint8)
    for i in range(1 << 16):
        c = chr(i)
        if c.isupper():
            kind[i] = 0
        elif c.isalpha():
            kind[i] = 1
        elif c.isdigit():
            kind[i] = 2
        elif c == "\n":
            kind[i] = 4
        elif c.isspace():
            kind[i] = 3
        elif i < 0x250:
            kind[i] = 5
    return kind


_KIND_OF: list[np.ndarray] = []


VIEW = {"text": "text", "source": "source", "lang": "lang"}


def _between(places: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of the ascending ``places`` lie in each row."""
    return np.diff(np.searchsorted(places, at))


def _repeats(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places of values that equal the one before them in their row."""
    same = np.zeros(len(values), bool)
    same[1:] = values[1:] == values[:-1]
    same[at[:-1][np.diff(at) > 0]] = False
    return np.flatnonzero(same)


def meta_features(batch: pa.RecordBatch, points: np.ndarray, at: np.ndarray, config: QualityConfig,
                  names: dict[str, str] = VIEW) -> np.ndarray:
    """(rows, features) of the metadata view; ``names`` of the columns, those
    that are missing left out."""
    if not _KIND_OF:
        _KIND_OF.append(_kinds())
    kind = _KIND_OF[0][np.minimum(points, 0xFFFF).astype(np.intp)]
    n = np.maximum(np.diff(at), 1).astype(float)
    share = np.column_stack([_between(np.flatnonzero(kind == k), at) for k in range(len(_KINDS))]).astype(float)
    mark = kind == 5
    runs = _between(np.flatnonzero(mark[1:] & mark[:-1]) + 1, at)       # marks in a row
    words, word_at = word_hashes(*utf8(batch.column(names["text"])))
    n_words = np.diff(word_at)
    share_of = np.maximum(n_words, 1)
    again = _between(_repeats(words, word_at), word_at) / share_of
    for start, end in zip(word_at[:-1].tolist(), word_at[1:].tolist()):
        words[start:end].sort()
    distinct = (n_words - _between(_repeats(words, word_at), word_at)) / share_of
    dense = [np.ones(len(n)), np.log1p(np.diff(at)) / 10, np.log1p(n_words) / 10, n / np.maximum(n_words, 1) / 10,
             *(share / n[:, None]).T, np.sqrt(share[:, 5] / n), np.sqrt(runs / n),
             share[:, 0] / np.maximum(share[:, 0] + share[:, 1], 1), share[:, 4] / np.maximum(n_words, 1),
             distinct, distinct * np.log1p(n_words) / 10, again, (n_words == 0).astype(float)]
    hot = np.zeros((len(n), config.hashed))
    for name in ("source", "lang"):
        values = batch.column(names[name]).to_pylist() if name in names else [None] * len(n)
        for i, value in enumerate(values):
            hot[i, zlib.crc32(f"{name}={value}".encode()) % config.hashed] += 1.0
    return np.column_stack([*dense, hot])


def _rows(batches: Iterator[pa.RecordBatch], config: QualityConfig, names: dict[str, str] = VIEW):
    for batch in pieces(batches, names["text"], SMALL_PIECE):
        points, at = code_points(batch.column(names["text"]))
        yield batch, text_buckets(points, at, config), meta_features(batch, points, at, config, names)


def _means(found: list[tuple[np.ndarray, np.ndarray]], log_odds: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean log odds of each row's n-grams, and how many it has (1 at least)."""
    total, n = np.zeros(rows), np.zeros(rows)
    for buckets, at in found:
        total += segment_sum(log_odds[buckets], at)
        n += np.diff(at)
    n = np.maximum(n, 1)
    return total / n, n


# ---- the two views ------------------------------------------------------------

@dataclass(frozen=True)
class QualityModel:
    config: QualityConfig
    log_odds: np.ndarray        # of each bucket, good against bad
    text_fit: np.ndarray        # Platt: slope, intercept
    meta: np.ndarray
    meta_fit: np.ndarray
    blend: np.ndarray           # of the two calibrated logits, and intercept


def logistic(x: np.ndarray, y: np.ndarray, ridge: float, weight: np.ndarray | None = None) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    weight = np.ones(len(y)) if weight is None else weight
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = weight * np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x * curve[:, None]).T @ x + ridge * np.eye(len(w)),
                               x.T @ (weight * (y - p)) - ridge * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return w


def _balance(y: np.ndarray) -> np.ndarray:
    good = max(int(y.sum()), 1)
    bad = max(len(y) - int(y.sum()), 1)
    return np.where(y > 0, len(y) / (2 * good), len(y) / (2 * bad))


class Sample:
    """Features of the sampled documents, sparse for the text view."""

    def __init__(self, got: pa.Table):
        size = np.array(got.column("nnz").to_pylist(), int)
        self.at = np.concatenate(([0], np.cumsum(size)))
        self.bucket = np.frombuffer(b"".join(got.column("bucket").to_pylist()), np.uint16)
        self.count = np.frombuffer(b"".join(got.column("count").to_pylist()), np.float32)
        self.meta = np.array([np.frombuffer(m, np.float64) for m in got.column("meta").to_pylist()])
        self.label = np.array([-1 if q is None else q for q in got.column("quality").to_pylist()])
        self.total = np.maximum(segment_sum(self.count, self.at), 1)

    def bucket_counts(self, rows: np.ndarray, y: np.ndarray, config: QualityConfig) -> np.ndarray:
        """(2, buckets): n-grams of the bad and of the good rows; every document
        weighs as much as its log length."""
        scale = np.log1p(self.total) / self.total
        counts = np.zeros((2, 1 << config.bits))
        for row, label in zip(rows.tolist(), y.tolist()):
            own = slice(self.at[row], self.at[row + 1])
            counts[int(label > 0), self.bucket[own]] += self.count[own] * scale[row]
        return counts

    def text_mean(self, log_odds: np.ndarray) -> np.ndarray:
        return segment_sum(log_odds[self.bucket] * self.count, self.at) / self.total


def log_odds(counts: np.ndarray, config: QualityConfig) -> np.ndarray:
    """Naive Bayes: log odds of each bucket, good against bad."""
    logs = np.log(counts + config.alpha)
    logs -= np.log((counts + config.alpha).sum(axis=1, keepdims=True))
    return logs[1] - logs[0]


def _platt(score: np.ndarray, y: np.ndarray) -> np.ndarray:
    scale = score.std() or 1.0
    w = logistic(np.column_stack((score / scale, np.ones(len(y)))), y, 0.1)
    return np.array([w[0] / scale, w[1]])


def _logit(fit: np.ndarray, score: np.ndarray) -> np.ndarray:
    return np.clip(fit[0] * score + fit[1], -12, 12)


def _probability(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


# ---- rounds over all unlabelled documents ---------------------------------------

FINE = 1 << 20                  # sums are of integers: parts of one


@dataclass(frozen=True)
class Views:
    """Both views as they are in a round."""

    config: QualityConfig
    log_odds: np.ndarray
    text_fit: np.ndarray
    meta: np.ndarray
    meta_fit: np.ndarray

    def edges(self) -> np.ndarray:
        """Lower edges of the bins of confident logits, the least first."""
        p = self.config.confident
        return np.log(p / (1 - p)) + np.array([0, 0.5, 1.25, 2.25, 3.5, 5.25, 7.5])


@dataclass(frozen=True)
class Handed:
    """Sums over the unlabelled documents by (side, bin); side 1 is good."""

    rows: int
    by_meta: np.ndarray         # (2, bins): documents in the metadata view's bins
    by_text: np.ndarray         # the same of the text view
    counts: np.ndarray          # (2, bins, buckets): n-grams, by the metadata view's bins
    gradient: np.ndarray        # (2, bins, features): by the text view's bins
    curve: np.ndarray           # (2, bins, features, features)


def _bins(logit: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """side * bins + bin of each confident logit, -1 of the others."""
    at = np.searchsorted(edges, np.abs(logit), side="right") - 1
    return np.where(at >= 0, (logit > 0) * len(edges) + at, -1)


def _add_up(views: Views, batches, sums: dict[str, np.ndarray]) -> None:
    """Add a task's documents to ``sums``."""
    edges, buckets = views.edges(), 1 << views.config.bits
    for batch, found, meta in batches:
        mean, n = _means(found, views.log_odds, batch.num_rows)
        of_text = _bins(_logit(views.text_fit, mean), edges)
        of_meta = _bins(_logit(views.meta_fit, meta @ views.meta), edges)
        sums["rows"][0] += batch.num_rows
        for name, of in (("by_text", of_text), ("by_meta", of_meta)):
            sums[name] += np.bincount(of[of >= 0], minlength=2 * len(edges))
        scale = np.log1p(n) / n
        taken = of_meta >= 0
        for bucket, at in found:
            many = np.diff(at)
            own = bucket if taken.all() else bucket[np.repeat(taken, many)]
            place = np.repeat(of_meta[taken] * buckets, many[taken])
            place += own
            sums["counts"] += np.bincount(place, np.repeat(scale[taken], many[taken]), 2 * len(edges) * buckets)
        p = _probability(meta @ views.meta)
        for k in np.unique(of_text[of_text >= 0]).tolist():
            x, own = meta[of_text == k], p[of_text == k]
            sums["gradient"][k] += x.T @ (float(k >= len(edges)) - own)
            sums["curve"][k] += (x * np.maximum(own * (1 - own), 1e-6)[:, None]).T @ x


def _shapes(views: Views) -> dict[str, tuple[int, ...]]:
    many, width = 2 * len(views.edges()), len(views.meta)
    return {"rows": (1,), "by_text": (many,), "by_meta": (many,), "counts": (many << views.config.bits,),
            "gradient": (many, width), "curve": (many, width, width)}


def gather(unlabelled: DataFrame, views: Views) -> Handed:
    """One pass over all unlabelled documents (``text, source, lang``)."""
    shapes = _shapes(views)
    shared = unlabelled.sparkSession.sparkContext.broadcast(views)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        sums = {name: np.zeros(shape) for name, shape in shapes.items()}
        _add_up(own, _rows(batches, own.config), sums)
        for kind, name in enumerate(shapes):
            fine = np.rint(sums[name].ravel() * FINE).astype(np.int64)
            at = np.flatnonzero(fine)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind, np.int32)), pa.array(at),
                                              pa.array(fine[at])], names=["kind", "place", "value"])

    got = (arrow_map(unlabelled, run, "kind int, place bigint, value bigint")
           .groupBy("kind", "place").agg(F.sum("value").alias("value")).toArrow())
    kind, place, value = (got.column(c).to_numpy() for c in ("kind", "place", "value"))
    out = {}
    for k, (name, shape) in enumerate(shapes.items()):
        flat = np.zeros(int(np.prod(shape)))
        flat[place[kind == k]] = value[kind == k] / FINE
        out[name] = flat.reshape(shape)
    bins = len(views.edges())
    return Handed(round(out["rows"][0]), out["by_meta"].reshape(2, bins), out["by_text"].reshape(2, bins),
                  out["counts"].reshape(2, bins, -1), out["gradient"].reshape(2, bins, -1),
                  out["curve"].reshape(2, bins, *shapes["curve"][1:]))


def handed_bins(sizes: np.ndarray, most: float) -> np.ndarray:
    """(2, bins) of whether a bin is handed over: from the most confident one
    down, until ``most`` documents of the side are reached."""
    above = np.cumsum(sizes[:, ::-1], axis=1)[:, ::-1] - sizes
    return above < most


def co_train(sample: Sample, unlabelled: DataFrame, config: QualityConfig) -> QualityModel | None:
    """Rounds of mutual labelling, then calibration on rows kept aside."""
    known = np.flatnonzero(sample.label >= 0)
    if len(known) == 0 or len(set(sample.label[known].tolist())) < 2:
        return None
    aside_every = max(2, round(1 / config.calibrate))
    aside, own = known[::aside_every], np.setdiff1d(known, known[::aside_every])
    if len(set(sample.label[aside].tolist())) < 2 or len(set(sample.label[own].tolist())) < 2:
        aside = own = known
    y_aside, y = sample.label[aside].astype(float), sample.label[own].astype(float)
    kinds = np.array([(y == 0).sum(), (y > 0).sum()], float)
    labelled = sample.bucket_counts(own, y, config)
    x, weight = sample.meta[own], _balance(y)
    balance = len(y) / (2 * kinds)
    odds, weights = log_odds(labelled, config), logistic(x, y, 1.0, weight)

    def fits() -> tuple[np.ndarray, np.ndarray]:
        return (_platt(sample.text_mean(odds)[aside], y_aside), _platt((sample.meta @ weights)[aside], y_aside))

    for number in range(1, config.rounds + 1):
        text_fit, meta_fit = fits()
        handed = gather(unlabelled, Views(config, odds, text_fit, weights, meta_fit))
        most = config.hand_over * number * handed.rows
        from_meta, from_text = handed_bins(handed.by_meta, most), handed_bins(handed.by_text, most)
        # handed documents of a kind weigh at most as much as the labelled ones
        less = [np.minimum(1, kinds / np.maximum(1, (sizes * taken).sum(axis=1)))
                for sizes, taken in ((handed.by_meta, from_meta), (handed.by_text, from_text))]
        odds = log_odds(labelled + less[0][:, None] * (handed.counts * from_meta[:, :, None]).sum(axis=1), config)
        p = _probability(x @ weights)
        side = less[1] * balance
        slope = (x.T @ (weight * (y - p)) - weights
                 + np.tensordot(side, (handed.gradient * from_text[:, :, None]).sum(axis=1), 1))
        curve = ((x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.eye(len(weights))
                 + np.tensordot(side, (handed.curve * from_text[:, :, None, None]).sum(axis=1), 1))
        weights = weights + np.clip(np.linalg.solve(curve, slope), -5, 5)
    text_fit, meta_fit = fits()
    both = np.column_stack([_logit(text_fit, sample.text_mean(odds)[aside]),
                            _logit(meta_fit, (sample.meta @ weights)[aside]), np.ones(len(aside))])
    return QualityModel(config, odds, text_fit, weights, meta_fit, logistic(both, y_aside, 0.1))


def sampled(docs: DataFrame, labels: DataFrame, config: QualityConfig) -> tuple[Sample, DataFrame]:
    """The bounded labelled sample's features, on the driver, and the rows of
    all other documents."""
    quality = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
               .groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min("quality").alias("quality")))
    place = F.xxhash64(F.col("doc_id"), F.lit("quality"))
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id IS NOT NULL")
    marked = quality.join(ids, "doc_id", "left_semi").withColumn("_place", place)
    chosen = materialize(marked.orderBy("_place", "doc_id").limit(config.labelled).select("doc_id", "quality"),
                         "quality_sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found, meta in _rows(batches, config):
            rows: list[tuple[bytes, bytes, int]] = []
            for i in range(batch.num_rows):
                own = np.concatenate([b[o[i]:o[i + 1]] for b, o in found]) if found else np.empty(0, np.uint32)
                bucket, count = np.unique(own, return_counts=True)
                rows.append((bucket.astype(np.uint16).tobytes(), count.astype(np.float32).tobytes(), len(bucket)))
            bucket, count, nnz = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array(nnz, pa.int64()),
                 pa.array(bucket, pa.binary()), pa.array(count, pa.binary()),
                 pa.array([m.tobytes() for m in meta], pa.binary())],
                names=["doc_id", "quality", "nnz", "bucket", "count", "meta"])
    # at most ``labelled`` rows
    texts = _viewed(docs).join(F.broadcast(chosen.select("doc_id", F.col("quality").cast("int"))), "doc_id")
    features = arrow_map(texts, run, "doc_id bigint, quality int, nnz bigint, bucket binary, count binary, meta binary")
    sample = Sample(features.dropDuplicates(["doc_id"]).toArrow().sort_by("doc_id"))
    return sample, _viewed(docs).join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_anti")


def _viewed(docs: DataFrame) -> DataFrame:
    """The columns of both views; a missing one is null."""
    have = {c.lower() for c in docs.columns}
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       *[(F.col(c).cast("string") if c in have else F.lit(None).cast("string")).alias(c) for c in VIEW])


def fit(docs: DataFrame, labels: DataFrame, config: QualityConfig = QualityConfig()) -> QualityModel | None:
    sample, unlabelled = sampled(docs, labels, config)
    return co_train(sample, unlabelled, config)


def score(docs: DataFrame, model: QualityModel | None, config: QualityConfig = QualityConfig()) -> DataFrame:
    """``docs`` with quality_score, text_score, meta_score (probabilities of
    good quality) and ``good``."""
    own = without(docs, OUT)
    if model is None:
        half = F.lit(0.5)
        return own.withColumns({"quality_score": half, "text_score": half, "meta_score": half, "good": F.lit(True)})
    names = {c.lower(): c for c in own.columns if c.lower() in VIEW}
    schema = StructType([*own.schema.fields, *[StructField(n, DoubleType()) for n in OUT[:3]],
                         StructField("good", BooleanType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch, found, meta in _rows(batches, m.config, names):
            text = _logit(m.text_fit, _means(found, m.log_odds, batch.num_rows)[0])
            page = _logit(m.meta_fit, meta @ m.meta)
            p = _probability(np.column_stack((text, page, np.ones(len(text)))) @ m.blend)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p), pa.array(_probability(text)), pa.array(_probability(page)),
                 pa.array(p >= m.config.reject_below)], names=[*batch.schema.names, *OUT])
    return arrow_map(own, run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """``docs`` less those that the classifier rejects."""
    clash = {c: f"_in_{c}" for c in docs.columns if c.lower() in OUT}
    judged = score(docs.withColumnsRenamed(clash), fit(docs, labels, config), config)
    return (judged.where("good").select(*[F.col(f"`{clash.get(c, c)}`").alias(c) for c in docs.columns]))

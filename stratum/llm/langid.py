"""Language identification (operator 1): multinomial naive Bayes over hashed
character n-grams.

Training counts (language, bucket) in every training row: each task sums its
rows in numpy and hands on only its non-zero counts.  The log-probability
matrix (buckets x languages) is broadcast; a batch is scored as a sparse
product: the matrix rows of all n-grams, summed by document.

A posterior compares the learned languages only, so a text in none of them has
one near 1, too.  ``with_bounds`` therefore learns, for each language, how
likely its texts are by themselves: the mean log-probability of their n-grams,
and how it varies between texts and with their length.  ``keep_identified``
rejects a text that is far less likely than that (``least_fit`` standard
deviations), and on the way from its language's mean to that of n-grams hashed
at random (each bucket alike) has gone further than ``most_way``.  So a text
that quotes another language, or holds names or code, stays.

Characters: letters are lower-cased one to one, every run of other characters
is one boundary mark, so digits, punctuation and layout carry no weight.

Defined results: null text or text without a letter: ``und`` with score 0;
ties go to the language that sorts first; without any training row every text
is ``und``; a language with under ``MIN_ROWS`` training rows rejects none.  A
text is scored as a whole, whatever its length.  Rows that repeat are scored one
by one; an empty table gives no rows.  Columns of the input named like results
(in any case) are replaced by ``predict`` and left alone by ``keep_identified``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from stratum.llm.common import SMALL_PIECE, arrow_map, code_points, pieces, segment_sum, without

BOUNDARY = 32
_MIX = np.uint32(0x9E3779B1)


@dataclass(frozen=True)
class LangConfig:
    orders: tuple[int, ...] = (1, 2, 3)
    bits: int = 15              # 2 ** bits hash buckets
    alpha: float = 0.5          # additive smoothing
    max_languages: int = 1024   # the matrix is at most 2 ** bits x this many floats


@dataclass(frozen=True)
class LangModel:
    config: LangConfig
    languages: tuple[str, ...]
    log_prob: np.ndarray        # (buckets, languages) float32
    log_prior: np.ndarray       # (languages,)
    # of the texts' mean log-probabilities: mean; variance = between + within / n-grams
    mean: np.ndarray | None = None
    between: np.ndarray | None = None
    within: np.ndarray | None = None


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For the code points of the basic plane: is it a letter; its lower case."""
    chars = [chr(i) for i in range(1 << 16)]
    letter = np.array([c.isalpha() for c in chars])
    lower = np.arange(1 << 16, dtype=np.uint32)
    for i in np.flatnonzero(letter):
        low = chars[i].lower()
        if len(low) == 1:
            lower[i] = ord(low)
    return letter, lower


def normalise(points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased letters with one boundary mark before, between and after
    runs of them; the rows' new offsets; whether a row has a letter."""
    letter, lower = _letters()
    basic = points < (1 << 16)
    low = np.where(basic, points, 0)
    is_letter = letter[low] & basic
    chars = lower[low]
    if not basic.all():
        far = np.flatnonzero(~basic)
        known = {p: chr(p).isalpha() for p in np.unique(points[far]).tolist()}
        is_letter[far] = [known[p] for p in points[far].tolist()]
        chars[far] = points[far]
    chars = np.where(is_letter, chars, np.uint32(BOUNDARY))
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]              # the first of a run of other characters
    full = at[:-1][np.diff(at) > 0]
    keep[full] = is_letter[full]            # ... but not one taken from the row before
    kept = np.concatenate(([0], np.cumsum(keep)))
    found = np.concatenate(([0], np.cumsum(is_letter)))
    return chars[keep], kept[at], np.diff(found[at]) > 0


def grams(chars: np.ndarray, at: np.ndarray, config: LangConfig) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: hash buckets of all n-grams and the rows' offsets."""
    shift = np.uint32(32 - config.bits)
    n_chars = np.diff(at)
    for order in config.orders:
        if len(chars) < order:
            continue
        hashed = np.full(len(chars) - order + 1, order, np.uint32)
        for k in range(order):
            hashed *= _MIX
            hashed ^= hashed >> np.uint32(15)
            hashed += chars[k:len(chars) - order + 1 + k]
        hashed *= _MIX
        hashed ^= hashed >> np.uint32(13)
        hashed *= np.uint32(0x85EBCA6B)
        # an n-gram belongs to the row in which it starts, and must end there
        row_end = np.repeat(at[1:], n_chars)[:len(hashed)]
        inside = np.arange(order, len(hashed) + order) <= row_end
        size = np.maximum(n_chars - order + 1, 0)
        yield hashed[inside] >> shift, np.concatenate(([0], np.cumsum(size)))


def _texts(batches: Iterator[pa.RecordBatch], column: str):
    for batch in pieces(batches, column, SMALL_PIECE):
        yield batch, *normalise(*code_points(batch.column(column)))


def _count(config: LangConfig):
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64()),
                        ("docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch, chars, at, _ in _texts(batches, "text"):
            names = batch.column("lang").to_pylist()
            order = {n: i for i, n in enumerate(dict.fromkeys(names))}
            row = np.array([order[n] for n in names])
            for name, i in order.items():
                docs[name] = docs.get(name, 0) + int((row == i).sum())
            for buckets, offsets in grams(chars, at, config):
                owner = np.repeat(row, np.diff(offsets))
                for name, i in order.items():
                    part = np.bincount(buckets[owner == i], minlength=1 << config.bits)
                    counts[name] = counts[name] + part if name in counts else part
        for name, total in counts.items():
            hit = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(hit), pa.string()), pa.array(hit, pa.int32()),
                 pa.array(total[hit], pa.int64()), pa.array(np.zeros(len(hit), np.int64))], schema=schema)
        if docs:   # the number of documents, under a bucket of its own
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(docs), pa.string()), pa.array([-1] * len(docs), pa.int32()),
                 pa.array([0] * len(docs), pa.int64()), pa.array(list(docs.values()), pa.int64())],
                schema=schema)
    return run


def fit(rows: DataFrame, config: LangConfig = LangConfig(), text: str = "text",
        lang: str = "lang") -> LangModel:
    """Naive Bayes from the rows with a text and a language."""
    known = (rows.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
             .where(F.col("lang").isNotNull() & F.col("text").isNotNull()))
    seen = known.select("lang").distinct().limit(config.max_languages + 1).collect()
    if len(seen) > config.max_languages:
        raise ValueError(f"more than {config.max_languages} languages (max_languages)")
    # at most languages x 2 ** bits rows come to the driver
    got = (arrow_map(known, _count(config), "lang string, bucket int, n bigint, docs bigint")
           .groupBy("lang", "bucket").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).toArrow())
    names = got.column("lang").to_pylist()
    languages = tuple(sorted(set(names)))
    place = {n: i for i, n in enumerate(languages)}
    col = np.array([place[n] for n in names], int)
    bucket = got.column("bucket").to_numpy()
    total = np.full((1 << config.bits, len(languages)), config.alpha)
    prior = np.zeros(len(languages))
    is_gram = bucket >= 0
    total[bucket[is_gram], col[is_gram]] += got.column("n").to_numpy()[is_gram]
    prior[col[~is_gram]] = got.column("docs").to_numpy()[~is_gram]
    log_prob = np.log(total) - np.log(total.sum(axis=0, keepdims=True))
    log_prior = np.log(prior / prior.sum()) if len(languages) else prior
    return LangModel(config, languages, log_prob.astype(np.float32), log_prior)


def log_likelihood(model: LangModel, chars: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log-probability of each row's n-grams in each language, and their number."""
    total, n = np.zeros((len(at) - 1, len(model.languages))), np.zeros(len(at) - 1)
    for buckets, offsets in grams(chars, at, model.config):
        total += segment_sum(model.log_prob[buckets], offsets)
        n += np.diff(offsets)
    return total, n


def posterior(model: LangModel, likelihood: np.ndarray) -> np.ndarray:
    total = likelihood + model.log_prior
    total -= total.max(axis=1, keepdims=True)
    p = np.exp(total)
    return p / p.sum(axis=1, keepdims=True)


def score(model: LangModel, chars: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Posterior probabilities (rows x languages)."""
    return posterior(model, log_likelihood(model, chars, at)[0])


MIN_ROWS = 30                   # texts of a language from which its bound is learned
_MOMENTS = 7


def with_bounds(model: LangModel, rows: DataFrame, text: str = "text", lang: str = "lang",
                trim: float | None = 6.0) -> LangModel:
    """``model`` with what the training rows' own likelihoods are like, from one
    more pass: sums of a few moments for each language.  With ``trim``, a second
    pass leaves out the rows that the first finds so many standard deviations too
    unlikely, so that rows under a wrong language don't widen its bound."""
    once = _bounded(model, rows, text, lang, None)
    return once if trim is None else _bounded(once, rows, text, lang, trim)


def _bounded(model: LangModel, rows: DataFrame, text: str, lang: str, trim: float | None) -> LangModel:
    known = (rows.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
             .where(F.col("lang").isin(list(model.languages)) & F.col("text").isNotNull()))
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        place = {name: i for i, name in enumerate(m.languages)}
        sums = np.zeros((len(m.languages), _MOMENTS))
        for batch, chars, at, has_letter in _texts(batches, "text"):
            total, n = log_likelihood(m, chars, at)
            own = np.array([place[x] for x in batch.column("lang").to_pylist()], int)
            ok = np.flatnonzero(has_letter & (n > 0))
            x = 1 / n[ok]
            y = total[ok, own[ok]] * x
            if trim is not None:
                near = _fit(m, own[ok], y, x) >= -trim
                ok, x, y = ok[near], x[near], y[near]
            np.add.at(sums, own[ok], np.column_stack((np.ones(len(x)), x, x * x, y, y * x, y * y, y * y * x)))
        yield pa.RecordBatch.from_arrays([pa.array(list(m.languages)), *map(pa.array, sums.T)],
                                         names=["lang", *[f"m{k}" for k in range(_MOMENTS)]])

    schema = "lang string, " + ", ".join(f"m{k} double" for k in range(_MOMENTS))
    got = arrow_map(known, run, schema).groupBy("lang").agg(*[F.sum(f"m{k}").alias(f"m{k}") for k in range(_MOMENTS)])
    mean, between, within = (np.zeros(len(model.languages)) for _ in range(3))
    between[:] = np.inf
    for row in got.collect():                           # a row for each language
        i = model.languages.index(row["lang"])
        if row["m0"] >= MIN_ROWS:
            mean[i], between[i], within[i] = _variance(*[row[f"m{k}"] for k in range(_MOMENTS)])
    return replace(model, mean=mean, between=between, within=within)


def _fit(model: LangModel, lang: np.ndarray, mean: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Standard deviations by which texts of 1 / x n-grams are likelier than
    their language's."""
    return (mean - model.mean[lang]) / np.sqrt(model.between[lang] + model.within[lang] * x)


def _variance(n: float, x: float, xx: float, y: float, yx: float, yy: float, yyx: float) -> tuple[float, float, float]:
    """Mean m of y, and a, b >= 0 of its variance a + b x (least squares of the
    squared deviations on x), from sums over the texts."""
    m = y / n
    r, rx = yy - n * m * m, yyx - 2 * m * yx + m * m * x
    det = n * xx - x * x
    a, b = ((r * xx - rx * x) / det, (n * rx - r * x) / det) if det > 1e-12 * n * xx else (r / n, 0.0)
    if a < 0:
        a, b = 0.0, rx / xx
    if b < 0:
        a, b = r / n, 0.0
    return m, max(a, 1e-6), max(b, 0.0)


OUT = ("lang_pred", "score", "fit", "way")


def predict(docs: DataFrame, model: LangModel, text: str = "text", fit: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the posterior); with ``fit``
    also how many standard deviations the text is likelier than its language's
    texts are (negative: less likely), and ``way``, the share of the way from
    their mean to that of random n-grams (both 0 for ``und``)."""
    names = OUT if fit else OUT[:2]
    own = without(docs, names)
    schema = StructType([*own.schema.fields, StructField("lang_pred", StringType()),
                         *[StructField(n, DoubleType()) for n in names[1:]]])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        called = np.array([*m.languages, "und"], object)
        for batch, chars, at, has_letter in _texts(batches, text):
            typical, way = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            random = -np.log(1 << m.config.bits)
            if m.languages:
                total, n = log_likelihood(m, chars, at)
                p = posterior(m, total)
                best = np.where(has_letter, p.argmax(axis=1), len(m.languages))
                top = np.where(has_letter, p.max(axis=1), 0.0)
                if fit and m.mean is not None:
                    row = np.flatnonzero(has_letter & (n > 0))
                    mean = total[row, best[row]] / n[row]
                    typical[row] = _fit(m, best[row], mean, 1 / n[row])
                    learned = np.isfinite(m.between[best[row]])
                    way[row[learned]] = ((m.mean[best[row]] - mean) / (m.mean[best[row]] - random))[learned]
            else:
                best, top = np.zeros(batch.num_rows, int), np.zeros(batch.num_rows)
            columns = [pa.array(called[best], pa.string()), pa.array(top, pa.float64()), pa.array(typical), pa.array(way)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns[:len(names)]],
                                             names=[*batch.schema.names, *names])
    return arrow_map(own, run, schema)


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept out of training: crc32 of its id, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, config: LangConfig = LangConfig()) -> DataFrame:
    """Fit on the documents that are not held out; predict all of them."""
    model = fit(docs.where(~held_out()), config)
    return predict(docs, model).withColumn("held_out", held_out())


def keep_identified(docs: DataFrame, config: LangConfig = LangConfig(),
                    least: float = 0.5, least_fit: float = 6.0, most_way: float = 0.5) -> DataFrame:
    """The documents in a language of the training rows: those without a
    letter, whose best posterior is under ``least``, or which are far less likely
    in that language than its own texts are, go."""
    model = with_bounds(fit(docs, config), docs)
    clash = {c: f"_in_{c}" for c in docs.columns if c.lower() in OUT}
    ruled = predict(docs.withColumnsRenamed(clash), model, "text", fit=True)
    kept = ruled.where((F.col("lang_pred") != "und") & (F.col("score") >= least)
                       & ((F.col("fit") >= -least_fit) | (F.col("way") <= most_way)))
    return kept.select(*[F.col(f"`{clash.get(c, c)}`").alias(c) for c in docs.columns])

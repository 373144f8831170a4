"""Near-duplicate documents by circulant MinHash (operator 6).

A document's set holds 64-bit hashes of its distinct word shingles.  The
signature needs two permutations of the 32-bit universe: one (sigma) spreads a
document's shingles, and the other (pi), circularly shifted by k, gives the
k-th coordinate: min over x of pi(sigma(x) + k mod 2**32).  Coordinates are cut
into bands; documents that agree on a band are candidates.  With 32 bands of 5,
a pair at similarity 0.8 is missed with probability 3e-6.

Equal sets are one class, found by digest; only classes are compared.  No pairs
are made within a bucket:

1. Each bucket has a hub, the class that shares buckets with the most others,
   so the buckets of one group mostly have the same one.  Members are compared
   with their hub on full sets, and the links give components.
2. Buckets that still hold several components are merged by hub.  The members
   outside the hub's component are queries against all members, in blocks of
   bounded size, and a query gives one link for each component it meets.

After that, each pair that shares a bucket is in one component or was compared
on full sets.  Sets are made only for classes in buckets with others.

Defined results: null text has no words; a document without words has an empty
set and is linked with nothing; one with fewer words than a shingle has one
shingle, its whole sequence.  A null doc_id sorts after all others.  Rows that
share a doc_id and a set are one class like other equal sets.  ``kept`` is by
doc_id; ``one_of_each`` decides by row: of a group's rows with the smallest
doc_id, the one whose text has the smallest SHA-256 stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import SMALL_PIECE, arrow_map, by_group, pieces, utf8, whole
from stratum.llm.components import components
from stratum.sinks import materialize

LAST = (1 << 63) - 1        # a null doc_id's place in the order


@dataclass(frozen=True)
class MinHashConfig:
    words: int = 5          # words in a shingle
    percent: int = 80       # link at 100 * intersection >= percent * union
    bands: int = 32
    rows: int = 5
    block: int = 256        # classes compared with as many others in one unit of work


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x9FB21C651E98DF25)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]      # only A-Z are lower-cased
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _powers(n: int) -> np.ndarray:
    steps = np.full(n, 0x9E3779B97F4A7C15, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def word_hashes(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows, and the rows' offsets among them."""
    solid = ~_SPACE[raw]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    opens = at[:-1][np.diff(at) > 0]
    first[opens] = solid[opens]
    place = np.flatnonzero(solid)
    if not len(place):
        return np.empty(0, np.uint64), np.zeros(len(at), np.int64)
    starts = np.flatnonzero(first[place])               # word starts among the solid bytes
    size = np.diff(np.append(starts, len(place)))
    inside = np.arange(len(place))
    inside -= np.repeat(starts, size)
    value = _BYTE[raw[place].astype(np.intp)]
    value *= _powers(int(size.max()))[inside]
    hashes = np.add.reduceat(value, starts) + size.astype(np.uint64)
    return _mix(hashes), np.searchsorted(np.flatnonzero(first), at)


def shingles(hashes: np.ndarray, at: np.ndarray, words: int) -> list[np.ndarray]:
    """For each row, the sorted distinct hashes of its shingles."""
    many = len(hashes) - words + 1
    if many > 0:
        rolled = hashes[:many].copy()
        for k in range(1, words):
            rolled *= np.uint64(0xC2B2AE3D27D4EB4F)
            rolled ^= rolled >> np.uint64(31)
            rolled += hashes[k:many + k]
        rolled = _mix(rolled)
    out = []
    for start, end in zip(at[:-1].tolist(), at[1:].tolist()):
        if end - start >= words:
            out.append(np.unique(rolled[start:end - words + 1]))
        elif end > start:
            whole = hashlib.blake2b(hashes[start:end].tobytes(), digest_size=8).digest()
            out.append(np.frombuffer(whole, np.uint64))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _permute(x: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit universe, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signature(members: np.ndarray, n: int) -> np.ndarray:
    """``n`` coordinates of a set: sigma once, then pi in all its shifts."""
    spread = _permute((members ^ (members >> np.uint64(32))).astype(np.uint32) * np.uint32(0x9E3779B1))
    shifts = np.arange(n, dtype=np.uint32)
    out = np.full(n, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(spread), 512):
        np.minimum(out, _permute(spread[i:i + 512, None] + shifts).min(axis=0), out=out)
    return out


def band_keys(signatures: np.ndarray, config: MinHashConfig) -> np.ndarray:
    """(sets, bands) 64-bit keys; a key tells the band, too."""
    parts = signatures.reshape(-1, config.bands, config.rows).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, config.bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15),
                           parts.shape[:2]).copy()
    for k in range(config.rows):
        keys = _mix(keys + parts[:, :, k]) * np.uint64(0xC2B2AE3D27D4EB4F)
    return _mix(keys).view(np.int64)


def _sets(batches: Iterator[pa.RecordBatch], words: int):
    for batch in pieces(batches, "text", SMALL_PIECE):
        yield batch, shingles(*word_hashes(*utf8(batch.column("text"))), words)


def _digest(members: np.ndarray) -> bytes:
    return hashlib.blake2b(members.tobytes(), digest_size=16).digest()


def _text_sha(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("key"),
                       _text_sha(F.col("text")).alias("text_sha"),
                       F.col("text").cast("string").alias("text"))


def signed(docs: DataFrame, config: MinHashConfig) -> DataFrame:
    """``doc_id, key, text_sha, n_shingles, digest, bands`` of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _sets(batches, config.words):
            full = [s for s in sets if len(s)]
            keys = iter(band_keys(np.array([signature(s, config.bands * config.rows) for s in full]),
                                  config) if full else ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("key"), batch.column("text_sha"),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_digest(s) for s in sets], pa.binary()),
                 pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                names=["doc_id", "key", "text_sha", "n_shingles", "digest", "bands"])
    return arrow_map(_keyed(docs), run,
                     "doc_id bigint, key bigint, text_sha binary, n_shingles bigint, digest binary, bands array<bigint>")


def set_payload(docs: DataFrame, wanted: DataFrame, config: MinHashConfig) -> DataFrame:
    """``node, members`` (packed hashes) of the ``wanted`` classes (node, key, digest)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _sets(batches, config.words):
            # rows may share a doc_id: the digest tells whether it is the class's own
            own = [i for i, (s, d) in enumerate(zip(sets, batch.column("digest").to_pylist()))
                   if _digest(s) == d]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(pa.array(own, pa.int64())),
                 pa.array([sets[i].tobytes() for i in own], pa.binary())], names=["node", "members"])
    # the wanted classes are a share of all: a shuffled join at every size
    texts = (_keyed(docs).select("key", "text").join(wanted.hint("merge"), "key")
             .select("node", "digest", "text"))
    return arrow_map(texts, run, "node bigint, members binary").dropDuplicates(["node"])


def compare(queries: DataFrame, members: DataFrame, payload: DataFrame, config: MinHashConfig) -> DataFrame:
    """Links (a, b) between the ``queries`` (cluster, node) and ``members``
    (cluster, node, comp) of the same cluster.  Units of work hold ``block``
    queries and ``block`` members or so; a query gives one link for each
    component it meets in a unit."""
    both = (queries.select("cluster", "node", F.lit(0).alias("role"), F.lit(None).cast("bigint").alias("comp"))
            .union(members.select("cluster", "node", F.lit(1).alias("role"), "comp")))
    salted, sizes = by_group(both, ["cluster"], ["node"], {
        "q_blocks": (F.count_if, F.col("role") == 0, lambda c: F.ceil(F.sum(c) / config.block).cast("int")),
        "m_blocks": (F.count_if, F.col("role") == 1, lambda c: F.ceil(F.sum(c) / config.block).cast("int"))})
    # its own block, and each block of the other role
    own = F.pmod(F.xxhash64("node"), F.when(F.col("role") == 0, F.col("q_blocks")).otherwise(F.col("m_blocks"))) \
        .cast("int")
    other = F.explode(F.sequence(
        F.lit(0), F.when(F.col("role") == 0, F.col("m_blocks")).otherwise(F.col("q_blocks")) - 1))
    placed = (salted.join(sizes.where("q_blocks > 0 AND m_blocks > 0"), ["cluster", "_salt"])
              .select("cluster", "role", "node", "comp", own.alias("_own"), other.alias("_other")))
    units = (placed.join(payload, "node")
             .withColumn("q", F.when(F.col("role") == 0, F.col("_own")).otherwise(F.col("_other")))
             .withColumn("m", F.when(F.col("role") == 0, F.col("_other")).otherwise(F.col("_own")))
             .withColumn("unit", F.xxhash64("cluster", "q", "m")))
    parts = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (units.repartition(parts, "unit").sortWithinPartitions("cluster", "q", "m", "role")
             .select("cluster", "q", "m", "role", "node", "comp", "members"))
    percent = config.percent

    def linked(asked: list, given: list):
        sizes = np.array([len(s) for _, _, s in given])
        at = np.concatenate(([0], np.cumsum(sizes)))
        every = np.concatenate([s for _, _, s in given])
        values, code = np.unique(every, return_inverse=True)
        nodes, comps = np.array([n for n, _, _ in given]), np.array([c for _, c, _ in given])
        for node, _, own in asked:
            near = np.flatnonzero(100 * np.minimum(sizes, len(own)) >= percent * np.maximum(sizes, len(own)))
            near = near[nodes[near] != node]
            if not len(near):
                continue
            held = np.zeros(len(values), np.int64)
            spot = np.searchsorted(values, own)
            spot[spot == len(values)] = 0
            held[spot[values[spot] == own]] = 1
            common = np.add.reduceat(held[code], at[:-1])[near]
            union = sizes[near] + len(own) - common
            for i in {int(comps[j]): int(j) for j in near[100 * common >= percent * union]}.values():
                yield node, int(nodes[i])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, asked, given, out = None, [], [], []

        def flush():
            if asked and given:
                out.extend(linked(asked, given))
            asked.clear()
            given.clear()
        for batch in batches:
            for cluster, q, m, role, node, comp, packed in zip(*(c.to_pylist() for c in batch.columns)):
                if (cluster, q, m) != unit:
                    flush()
                    unit = (cluster, q, m)
                (given if role else asked).append((node, comp, np.frombuffer(packed, np.uint64)))
            if len(out) >= 1000:
                yield _pairs(out)
                out.clear()
        flush()
        if out:
            yield _pairs(out)
    return arrow_map(dealt, run, "a bigint, b bigint")


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def link_classes(docs: DataFrame, classes: DataFrame, config: MinHashConfig) -> DataFrame:
    """``node, comp`` of the linked ``classes`` (node, key, digest, bands)."""
    in_band = materialize(classes.select("node", F.explode("bands").alias("band")), "minhash_bands")
    # a band that many share is dealt by salt to several tasks, here and below
    salted, groups = by_group(in_band, ["band"], ["node"], {"n": (F.count, F.lit(1), F.sum)})
    shared = materialize(groups.where("n > 1"), "minhash_shared")
    buckets = materialize(salted.join(shared, ["band", "_salt"]), "minhash_buckets")
    parts = shared.select("band", "_salt")
    degree = buckets.groupBy("node").agg(F.sum("n").alias("degree"))
    hubs = (buckets.join(degree, "node").groupBy("band")
            .agg(F.max(F.struct("degree", (-F.col("node")).alias("lower"))).alias("best"))
            .select("band", (-F.col("best.lower")).alias("cluster")))
    buckets = materialize(buckets.join(parts.join(hubs, "band"), ["band", "_salt"]), "minhash_hubs")

    wanted = buckets.select("node").distinct().join(classes.select("node", "key", "digest"), "node")
    wanted = materialize(wanted, "minhash_wanted")
    payload = materialize(set_payload(docs, wanted, config), "minhash_sets")

    stars = buckets.where("node <> cluster").select("cluster", "node").distinct()
    queries = stars.select("cluster").distinct().withColumn("node", F.col("cluster"))
    links = materialize(compare(queries, stars.withColumn("comp", F.col("node")), payload, config),
                        "minhash_links")
    comp = components(links, "minhash_first")

    labelled = buckets.where("n > 2").join(comp, "node", "left").select(
        "band", "_salt", "cluster", "node", F.coalesce("comp", "node").alias("comp"))
    open_ = (labelled.groupBy("band").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
             .where("low <> high").select("band"))
    rest = materialize(labelled.join(parts.join(open_, "band"), ["band", "_salt"]).select("cluster", "node", "comp").distinct(), "minhash_rest")
    hub_comp = comp.select(F.col("node").alias("cluster"), F.col("comp").alias("hub_comp"))
    outside = (rest.join(hub_comp, "cluster", "left")
               .where(F.col("comp") != F.coalesce("hub_comp", "cluster")).select("cluster", "node"))
    more = materialize(compare(outside, rest.where("node <> cluster"), payload, config), "minhash_more")
    if more.isEmpty():
        return comp
    return components(links.union(more), "minhash_second")


def decided(docs: DataFrame, config: MinHashConfig = MinHashConfig()) -> DataFrame:
    """``doc_id, key, text_sha, n_shingles, component, stays`` of each row: the
    smallest key that links reach, and whether the row is the one of its group
    that stays, by the smallest (key, text_sha)."""
    rows = materialize(signed(docs, config).withColumn("row", F.monotonically_increasing_id()),
                       "minhash_signed")
    some = rows.where("n_shingles > 0")
    salted, groups = by_group(some.select("row", "key", "digest", "doc_id", "n_shingles", "text_sha"),
                              ["digest"], ["row"],
                              {"first": (F.min, F.struct("key", "text_sha", "row"), F.min)})
    member = materialize(
        salted.join(groups, ["digest", "_salt"])
        .select("row", "doc_id", "n_shingles", "key", "text_sha", "digest", F.col("first.row").alias("node"),
                F.col("first.key").alias("node_key")), "minhash_members")
    heads = member.where("row = node").select("node", "key", "text_sha", "digest")
    classes = materialize(heads.join(rows.select(F.col("row").alias("node"), "bands"), "node"), "minhash_classes")
    comp = link_classes(docs, classes, config)

    keyed = comp.join(classes.select("node", "key", "text_sha"), "node")
    lowest = keyed.groupBy("comp").agg(F.min(F.struct("key", "text_sha", "node")).alias("first"))
    of_node = materialize(comp.join(lowest, "comp").select(
        "node", F.col("first.key").alias("component_key"), F.col("first.node").alias("first_node")),
        "minhash_of_node")
    linked = (member.join(of_node, "node", "left")
              .select("doc_id", "key", "text_sha", "n_shingles",
                      F.coalesce("component_key", "node_key").alias("component"),
                      (F.col("row") == F.coalesce("first_node", "node")).alias("stays")))
    lone = rows.where("n_shingles = 0").select("doc_id", "key", "text_sha", "n_shingles",
                                               F.col("key").alias("component"), F.lit(True).alias("stays"))
    return linked.union(lone)


def near_groups(docs: DataFrame, config: MinHashConfig = MinHashConfig()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of each row: the smallest
    doc_id that links reach, and whether the row's own is that."""
    return decided(docs, config).select(
        "doc_id", "n_shingles",
        F.when(F.col("component") != LAST, F.col("component")).alias("component_id"),
        (F.col("key") == F.col("component")).alias("kept"))


def one_of_each(docs: DataFrame, config: MinHashConfig = MinHashConfig()) -> DataFrame:
    """``docs`` less the rows that are not the first of their group: one row of
    each group stays, and each row without words."""
    # rows that share key and text have words and are of one group: at most one of them stays
    apart = materialize(decided(docs, config).where("n_shingles > 0").groupBy("key", "text_sha")
                        .agg(F.max("stays").alias("stays"), F.count("*").alias("n"))
                        .where("NOT stays OR n > 1")
                        .select(F.col("key").alias("_key"), F.col("text_sha").alias("_text_sha"), "stays"),
                        "minhash_apart")
    keyed = whole(docs).withColumns({
        "_key": F.coalesce(F.col("_row.doc_id").cast("bigint"), F.lit(LAST)),
        "_text_sha": _text_sha(F.col("_row.text"))})
    on = ["_key", "_text_sha"]
    out = keyed.join(apart.select(*on), on, "left_anti").select("_row.*")
    repeated = apart.where("stays").select(*on)
    if repeated.isEmpty():
        return out
    # the map side drops most repeats before any exchange
    return out.union(keyed.dropDuplicates(on).join(repeated, on, "left_semi").select("_row.*"))

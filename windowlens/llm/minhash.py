"""MinHash near-duplicates with fast similarity sketches.

1. *Sets.*  One pass over the texts: the distinct word shingles of a text as
   64-bit hashes.  Equal sets are then one row, so a text with millions of
   copies costs nothing below.
2. *Sketches.*  A set is thrown into ``COORDS`` bins in rounds.  In round
   ``i`` every element gets a fresh bin and value; a bin keeps its smallest
   (round, value), so an earlier round always wins and the rounds end when
   all bins are full.  From round ``COORDS`` on all elements fall into bin
   ``i - COORDS``, so every coordinate is filled after ``2 * COORDS`` rounds
   at most.  The share of equal coordinates of two sketches estimates their
   similarity with the concentration of that many independent draws.
3. *Banding.*  A few coordinates make a key, as many as leave a pair at the
   threshold without a common key less than once in a million: six at 0.85,
   ``(1 - 0.85**6)**32``.  Sets with an equal key are tied to the first set
   of the key (no pairs), and ties form candidate clusters by star joins.
4. *Verification.*  The full sets of a candidate cluster meet in one task,
   where a pair is compared unless a chain of links joins it already.  Pairs
   with too different sizes, or with sketches that agree on far fewer
   coordinates than the concentration bound allows (``SLACK``), are passed
   over; all others are intersected.  A cluster of over ``BLOCK`` shingles is
   dealt out to blocks, each with the cluster's first set; what its largest
   group of links leaves outside then meets all its blocks, one at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windowlens.llm.common import byte_values, documents_of, same, shuffle_partitions, staged
from windowlens.llm.graph import components

COORDS = 192
MISSED = 1e-6           # chance that a pair at the threshold has no key in common
SLACK = 0.18            # agreement may fall short of the similarity by this; seven standard deviations at 0.85
BLOCK = 4_000_000       # shingles that meet in one task
_SETS = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()),
                   ("keys", pa.list_(pa.int64()))])
_FULL = pa.schema([("rep", pa.int64()), ("sketch", pa.binary()), ("hashes", pa.binary())])
_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


# --- sets and sketches -------------------------------------------------------

def shingle_set(text: bytes, shingle: int = 5) -> np.ndarray:
    """Sorted hashes of the distinct shingles.  Words are split on ASCII white
    space after lower-casing A-Z; fewer than ``shingle`` words make one
    shingle; no words give none."""
    found = text.lower().split()
    if not found:
        return np.empty(0, np.uint64)
    joined = b" ".join(found)
    digest = xxhash.xxh3_64_digest
    if len(found) <= shingle:
        hashes = digest(joined)
    else:
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        hashes = b"".join([digest(joined[a:b]) for a, b in
                           zip(starts[:len(found) - shingle + 1].tolist(), ends[shingle - 1:].tolist())])
    return np.unique(np.frombuffer(hashes, np.uint64))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (fixed multipliers of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sketch(hashes: np.ndarray, coords: int = COORDS) -> np.ndarray:
    """Fast similarity sketch of a set that isn't empty: per coordinate the
    smallest (round, value), packed as ``round << 32 | value``."""
    out = np.zeros(coords, np.uint64)
    full = np.zeros(coords, bool)
    step = int(np.clip(2048 // len(hashes), 1, 64))
    for start in range(0, 2 * coords, step):
        rounds = np.arange(start, min(start + step, 2 * coords), dtype=np.uint64)[:, None]
        x = _mixed(hashes[None, :] + rounds * np.uint64(0x9E3779B97F4A7C15))
        at = ((x >> np.uint64(32)) * np.uint64(coords)) >> np.uint64(32)
        at = np.where(rounds < coords, at, rounds - np.minimum(rounds, np.uint64(coords)))
        packed = (at << np.uint64(48)) | (rounds << np.uint64(32)) | (x & np.uint64(0xFFFFFFFF))
        packed = np.sort(packed[~full[at.astype(np.int64)]])
        bins = (packed >> np.uint64(48)).astype(np.int64)
        first = np.flatnonzero(np.diff(bins, prepend=-1))
        out[bins[first]] = packed[first] & np.uint64((1 << 48) - 1)
        full[bins[first]] = True
        if full.all():
            break
    return out


def band_rows(percent: int, coords: int = COORDS) -> int:
    """Coordinates a key for a threshold."""
    share = percent / 100
    return max(r for r in range(1, coords + 1) if coords % r == 0 and (r == 1 or (1 - share ** r) ** (coords // r) < MISSED))


def band_keys(coords: np.ndarray, rows: int) -> np.ndarray:
    """One signed 64-bit key for every ``rows`` coordinates."""
    digest = xxhash.xxh3_64_digest
    return np.frombuffer(b"".join([digest(c.tobytes(), i) for i, c in enumerate(coords.reshape(-1, rows))]),
                         ">i8").astype(np.int64)


def _sets(shingle: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, digests, keys = [], [], []
            for text in byte_values(b["text"]):
                s = shingle_set(text, shingle)
                n.append(len(s))
                digests.append(xxhash.xxh3_128_digest(s.tobytes()))
                keys.append(band_keys(sketch(s), rows) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["text_hash"], pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], schema=_SETS)
    return run


def _full(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t, shingle) for t in byte_values(b["text"])]
            sketches = [(sketch(s) & np.uint64(255)).astype(np.uint8).tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b["rep"], pa.array(sketches, pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                schema=_FULL)
    return run


# --- banding -----------------------------------------------------------------

def _ties(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, rep) in key order -> (a, b): every set with the first of its key."""
    key, head = None, None
    for b in batches:
        k, rep = (b[c].to_numpy(zero_copy_only=False) for c in ("key", "rep"))
        if not len(k):
            continue
        new = np.concatenate(([key is None or k[0] != key], k[1:] != k[:-1]))
        heads = np.where(new, rep, 0)
        if not new[0]:
            heads[0] = head
        heads = heads[np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))]
        key, head = k[-1], heads[-1]
        tied = heads != rep
        yield pa.RecordBatch.from_arrays([pa.array(rep[tied]), pa.array(heads[tied])], schema=_LINK)


def candidate_clusters(distinct: DataFrame) -> DataFrame:
    """``distinct`` (rep, keys) -> (rep, cluster): sets joined by chains of
    equal keys; sets without a partner have no row."""
    dealt = distinct.where("keys is not null").select(F.explode("keys").alias("key"), "rep")
    ties = (dealt.repartition(shuffle_partitions(distinct), "key").sortWithinPartitions("key", "rep")
            .mapInArrow(_ties, "a long, b long"))
    found = staged(components(ties).select(F.col("node").alias("rep"), F.col("root").alias("cluster")),
                   "minhash-clusters")
    return found.unionByName(found.select(F.col("cluster").alias("rep"), "cluster").distinct())


# --- verification ------------------------------------------------------------

def linked(reps: np.ndarray, labels: np.ndarray, asks: np.ndarray, sketches: np.ndarray, sets: list[np.ndarray],
           percent: int) -> Iterator[tuple[int, int]]:
    """Links between rows of different labels, as a forest: a pair that links
    join already isn't compared.  Only pairs with a row in ``asks`` count."""
    sizes = np.array([len(s) for s in sets])
    labels, places = labels.copy(), np.arange(len(reps))
    enough = (percent / 100 - SLACK) * sketches.shape[1]
    for i in np.flatnonzero(asks):
        others = np.flatnonzero((labels != labels[i]) & ~(asks & (places < i)))
        small, large = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
        others = others[100 * small >= percent * large]
        for part in np.array_split(others, len(others) // 65_536 + 1):
            for j in part[(sketches[part] == sketches[i]).sum(axis=1) >= enough]:
                if labels[j] == labels[i]:
                    continue
                shared = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * shared >= percent * (sizes[i] + sizes[j] - shared):
                    labels[labels == labels[j]] = labels[i]
                    yield int(reps[i]), int(reps[j])


def _verify(percent: int):
    """Rows sorted by (cluster, ask, block) -> links; one group is held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        group = None
        for b in batches:
            for r in zip(*(b[c].to_pylist() for c in
                           ("cluster", "x", "y", "rep", "label", "asks", "sketch", "hashes"))):
                if r[:3] != group:
                    yield _group(held, percent)
                    held, group = [], r[:3]
                held.append(r[3:])
        yield _group(held, percent)
    return run


def _group(held: list[tuple], percent: int) -> pa.RecordBatch:
    pairs: list[tuple[int, int]] = []
    if len(held) > 1:
        reps, labels, asks, sketches, sets = zip(*held)
        at = np.unique(np.array(labels), return_inverse=True)[1]
        pairs = list(linked(np.array(reps), at, np.array(asks), np.stack([np.frombuffer(s, np.uint8) for s in sketches]),
                            [np.frombuffer(s, np.uint64) for s in sets], percent))
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], schema=_LINK)


def _meet(groups: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """``groups`` (cluster, x, y, rep, label, asks) with their sets -> links."""
    key = ["cluster", "x", "y"]
    return (groups.join(full, "rep").repartition(shuffle_partitions(groups), *key).sortWithinPartitions(*key, "rep")
            .select(*key, "rep", "label", "asks", "sketch", "hashes").mapInArrow(_verify(percent), "a long, b long"))


def links(members: DataFrame, full: DataFrame, percent: int = 85, block: int = BLOCK) -> DataFrame:
    """``members`` (rep, cluster, n), ``full`` (rep, sketch, hashes) -> (a, b):
    links whose components are those of all pairs of a cluster with
    ``100 * intersection >= percent * union``."""
    sized = members.groupBy("cluster").agg(F.sum("n").alias("total"))
    placed = staged(members.join(sized, "cluster").withColumn("m", F.ceil(F.col("total") / block).cast("int"))
                    .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("m")).cast("int")), "minhash-placed")
    blocks = F.when(F.col("rep") == F.col("cluster"), F.sequence(F.lit(0), F.col("m") - 1)).otherwise(F.array("own"))
    first = _meet(placed.select("cluster", F.explode(blocks).alias("x"), F.lit(0).alias("y"), "rep",
                                F.col("rep").alias("label"), F.lit(True).alias("asks")), full, percent)
    first = staged(first, "minhash-links")
    crowded = placed.where("m > 1")
    if crowded.isEmpty():
        return first
    roots = components(first)
    known = staged(crowded.join(roots, F.col("rep") == F.col("node"), "left")
                   .withColumn("label", F.coalesce("root", "rep")).drop("node", "root"), "minhash-known")
    shares = known.groupBy("cluster", "label").agg(F.count("*").alias("k"))
    largest = shares.groupBy("cluster").agg(F.max(F.struct("k", "label")).alias("top")).select(
        "cluster", F.col("top.label").alias("top"))
    known = known.join(largest, "cluster")
    outside = known.where(F.col("label") != F.col("top"))
    parts = outside.groupBy("cluster").agg(F.ceil(F.sum("n") / block).cast("int").alias("s"))
    cut = F.pmod(F.xxhash64("rep", F.lit(1)), F.col("s")).cast("int")
    asking = outside.join(parts, "cluster").select(
        "cluster", cut.alias("x"), F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("y"), "rep", "label",
        F.lit(True).alias("asks"))
    asked = known.join(parts, "cluster").select(
        "cluster", F.explode(F.sequence(F.lit(0), F.col("s") - 1)).alias("x"), F.col("own").alias("y"), "rep", "label",
        F.lit(False).alias("asks"))
    return first.unionByName(_meet(asking.unionByName(asked), full, percent))


# --- operator ----------------------------------------------------------------

def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 85, block: int = BLOCK,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (doc_id, text_hash, n_shingles, component_id,
    kept).

    Documents link when ``100 * intersection >= percent * union`` of their
    shingle sets; ``component_id`` is the smallest doc_id reachable, ``kept``
    marks the documents that have it.

    Null, empty and blank texts have no shingle and link with nothing; a text
    of fewer than ``shingle`` words is one shingle; rows that repeat are all
    returned, in one component; a null doc_id is returned with its
    component's id (null only if no document of the component has an id, and
    then kept); very long texts are compared whole; an empty table gives an
    empty result; other columns are ignored whatever their names.
    """
    texts = documents_of(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    rows = staged(texts.mapInArrow(_sets(shingle, band_rows(percent)), "doc_id long, text_hash long, n long, digest binary, "
                                                   "keys array<long>"), "minhash-rows")
    distinct = staged(rows.where("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("first_id"), F.min("text_hash").alias("text_hash"), F.first("n").alias("n"),
        F.first("keys").alias("keys")).withColumn("rep", F.monotonically_increasing_id()), "minhash-distinct")
    members = staged(candidate_clusters(distinct).join(distinct.drop("keys"), "rep"), "minhash-members")
    chosen = (texts.select("text_hash", "text").join(members.select("text_hash", "rep"), "text_hash")
              .groupBy("rep").agg(F.first("text").alias("text")))
    full = staged(chosen.mapInArrow(_full(shingle), "rep long, sketch binary, hashes binary"), "minhash-full")
    joined = components(links(members.select("rep", "cluster", "n"), full, percent, block))
    labelled = (distinct.drop("keys").join(joined, F.col("rep") == F.col("node"), "left")
                .withColumn("root", F.coalesce("root", "rep")))
    least = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_set = labelled.join(least, "root").select("digest", "component_id")
    out = (rows.where("n > 0").drop("keys").join(of_set, "digest")
           .unionByName(rows.where("n = 0").drop("keys").withColumn("component_id", F.col("doc_id"))))
    return out.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "component_id",
                      same(F.col("doc_id"), F.col("component_id")).alias("kept"))

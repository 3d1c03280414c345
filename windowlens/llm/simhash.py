"""SimHash near-duplicates through pivot distance tables.

1. *Fingerprints.*  One pass over the texts: XXH64 of every word shingle,
   majority vote per bit.  Equal fingerprints are then one row (partial
   aggregation), so a text with millions of copies costs nothing below.
2. *Pivot tables.*  The 64 bits are cut into ``blocks`` parts.  Two
   fingerprints with at most ``max_bits`` differing bits agree on at least
   ``blocks - max_bits`` parts, so for at least one choice of that many parts
   their Hamming distances to *every* reference fingerprint, taken over those
   parts, are equal.  Each choice is one pivot table: its row for a
   fingerprint is the vector of distances to ``PIVOTS`` reference
   fingerprints, packed into a long, and fingerprints meet where a whole row
   is equal (maximum coordinate difference zero).  No pair within distance is
   missed; all other pairs never meet, except by chance (about 26 bits of
   key with six blocks; more blocks give longer keys for larger corpora).
3. *Discard.*  Of pairs that meet, those with a coordinate difference over
   ``max_bits`` in the table of all 64 bits against further references are
   discarded (triangle inequality), and survivors are verified by the bit
   count of their XOR.
4. *Components.*  Verified links become a forest inside each meeting row,
   and star joins (``graph``) give the components.

Rows that meet are streamed in key order.  A key with more than ``RUN``
distinct fingerprints is not compared in place: its members are dealt out
again by the fingerprint outside three of sixteen 4-bit parts, which leaves
at most 4,096 distinct fingerprints a key and still brings every pair within
three bits together (for other ``max_bits`` likewise).  So no task compares
an unbounded group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windowlens.llm.common import byte_values, documents_of, shuffle_partitions, staged
from windowlens.llm.graph import components

PIVOTS = 11        # references of a table; base-34 digits of 11 distances and the table's number fit a long
FILTER_PIVOTS = 16  # references of the table of all 64 bits
RUN = 4096         # distinct fingerprints compared in place
_BASE = np.uint64(34)

_FP = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])
_KEYED = pa.schema([("key", pa.int64()), ("fp", pa.int64())])
_MET = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])


def _references(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# --- fingerprints ------------------------------------------------------------

def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of one text.  Words are split on ASCII white space after
    lower-casing A-Z; fewer than ``shingle`` words make one shingle; no words
    give 0."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_digest
    if len(words) <= shingle:
        hashes = digest(joined, 42)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        hashes = b"".join([digest(joined[a:b], 42) for a, b in
                           zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())])
    return _majority(hashes)


def _majority(hashes: bytes) -> int:
    rows = np.frombuffer(hashes, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(rows), 1 << 16):   # bounded memory for very long texts
        ones += np.unpackbits(rows[at:at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(rows)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp): the signed 64-bit SimHash of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = [fingerprint(t, shingle) for t in byte_values(b["text"])]
            fps = np.array(values, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["text_hash"], pa.array(fps, pa.int64())], schema=_FP)

    d = documents_of(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    return d.mapInArrow(run, "doc_id long, text_hash long, fp long")


# --- pivot tables ------------------------------------------------------------

def _parts(blocks: int) -> list[int]:
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]


def table_masks(blocks: int, max_bits: int) -> np.ndarray:
    """The bits of each pivot table: every choice of ``blocks - max_bits``
    parts."""
    parts = _parts(blocks)
    return np.array([sum(c) for c in combinations(parts, blocks - max_bits)], dtype=np.uint64)


def pivot_keys(fps: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """(tables, n) packed rows of the pivot tables."""
    refs = _references(PIVOTS, 1)
    out = np.empty((len(masks), len(fps)), dtype=np.uint64)
    for t, mask in enumerate(masks):
        key = np.zeros(len(fps), dtype=np.uint64)
        for r in refs:
            key = key * _BASE + np.bitwise_count((fps ^ r) & mask).astype(np.uint64)
        out[t] = key * np.uint64(len(masks)) + np.uint64(t)
    return out


def _deal(masks: np.ndarray):
    def run(batches):
        for b in batches:
            fps = b["fp"].to_numpy(zero_copy_only=False).view(np.uint64)
            for keys in pivot_keys(fps, masks):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(fps.view(np.int64))], schema=_KEYED)
    return run


def _deal_again(max_bits: int):
    """Finer keys for members of crowded rows: the fingerprint without
    ``max_bits`` of sixteen 4-bit parts."""
    parts = [0xF << (4 * i) for i in range(16)]
    outside = [((1 << 64) - 1) ^ sum(c) for c in combinations(parts, max_bits)]

    def run(batches):
        for b in batches:
            fps = b["fp"].to_numpy(zero_copy_only=False).view(np.uint64)
            for i, mask in enumerate(outside):
                keys = (fps & np.uint64(mask)) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(fps.view(np.int64))], schema=_KEYED)
    return run


def linked_pairs(fps: np.ndarray, keys: np.ndarray, max_bits: int) -> np.ndarray:
    """Star forest (i, root) over the positions of a key-sorted array: two
    positions share a tree when a chain of pairs with equal keys and at most
    ``max_bits`` differing bits joins them."""
    pivots = np.stack([np.bitwise_count(fps ^ r).astype(np.int8) for r in _references(FILTER_PIVOTS, 2)], axis=1)
    label = np.arange(len(fps))
    left = np.flatnonzero(keys[:-1] == keys[1:])
    step = 1
    while len(left):
        right = left + step
        near = np.abs(pivots[left] - pivots[right]).max(axis=1) <= max_bits          # discard
        a, b = left[near], right[near]
        true = np.bitwise_count(fps[a] ^ fps[b]) <= max_bits                          # verify
        _join(label, a[true], b[true])
        step += 1
        left = left[left + step < len(fps)]
        left = left[keys[left] == keys[left + step]]
    roots = _roots(label)
    return np.flatnonzero(roots != np.arange(len(fps))), roots


def _roots(label: np.ndarray) -> np.ndarray:
    while True:
        up = label[label]
        if np.array_equal(up, label):
            return label
        label = up


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while len(a):
        root = _roots(label)
        label[:] = root
        x, y = root[a], root[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))


def _meet(max_bits: int, run_limit: int | None):
    """Key-sorted rows -> kind 0: links (a, b); kind 1: members of crowded
    keys (a).  Holds one key's rows and one batch at most."""
    def run(batches):
        held_k, held_f = np.empty(0, np.int64), np.empty(0, np.uint64)
        crowded: int | None = None
        for b in batches:
            k = b["key"].to_numpy(zero_copy_only=False)
            f = b["fp"].to_numpy(zero_copy_only=False).view(np.uint64)
            if crowded is not None:
                n = int(np.searchsorted(k, crowded, side="right"))
                if n:
                    yield _members(f[:n])
                k, f = k[n:], f[n:]
                if not len(k):
                    continue
                crowded = None
            k, f = np.concatenate((held_k, k)), np.concatenate((held_f, f))
            if not len(k):
                continue
            last = int(np.searchsorted(k, k[-1], side="left"))   # the last key may go on
            yield from _runs(k[:last], f[:last], max_bits, run_limit)
            held_k, held_f = k[last:], f[last:]
            if run_limit and len(held_k) > run_limit:
                crowded = int(held_k[0])
                yield _members(held_f)
                held_k, held_f = held_k[:0], held_f[:0]
        yield from _runs(held_k, held_f, max_bits, run_limit)
    return run


def _members(fps):
    n = len(fps)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ones(n, np.int32)), pa.array(fps.view(np.int64)), pa.array(fps.view(np.int64))], schema=_MET)


def _runs(k, f, max_bits, run_limit):
    if not len(k):
        return
    starts = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(k)])))
    per_row = np.repeat(sizes, sizes)
    if run_limit and (sizes > run_limit).any():
        yield _members(f[per_row > run_limit])
    keep = (per_row > 1) & ((per_row <= run_limit) if run_limit else True)
    k, f = k[keep], f[keep]
    if len(f):
        at, roots = linked_pairs(f, k, max_bits)
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(at), np.int32)), pa.array(f[at].view(np.int64)),
                 pa.array(f[roots[at]].view(np.int64))], schema=_MET)


def links(distinct: DataFrame, max_bits: int = 3, blocks: int = 6, run_limit: int = RUN) -> DataFrame:
    """``distinct`` (fp long, no repeats) -> (a, b): links whose components
    are those of all pairs with at most ``max_bits`` differing bits."""
    if blocks <= max_bits:
        raise ValueError("blocks must exceed max_bits")
    n = shuffle_partitions(distinct)

    def met(rows: DataFrame, limit: int | None) -> DataFrame:
        return (rows.repartition(n, "key").sortWithinPartitions("key", "fp")
                .mapInArrow(_meet(max_bits, limit), "kind int, a long, b long"))

    dealt = distinct.select("fp").mapInArrow(_deal(table_masks(blocks, max_bits)), "key long, fp long")
    first = staged(met(dealt, run_limit), "simhash-met")
    crowded = first.where("kind = 1").select(F.col("a").alias("fp")).distinct()
    again = met(crowded.mapInArrow(_deal_again(max_bits), "key long, fp long"), None)
    return first.where("kind = 0").select("a", "b").unionByName(again.select("a", "b")).distinct()


# --- operator ----------------------------------------------------------------

def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, blocks: int = 6,
                    id_col: str = "doc_id", text_col: str = "text", run_limit: int = RUN) -> DataFrame:
    """One row per document: (doc_id, text_hash, fp, fingerprint,
    component_id, root_fp).

    Documents link when their fingerprints differ in at most ``max_bits``
    bits; ``component_id`` is the smallest doc_id reachable, ``root_fp`` the
    fingerprint of that document (the smallest fingerprint where rows share
    the doc_id).

    Null or blank texts have fingerprint 0 and link like any other; a text of
    fewer than ``shingle`` words is one shingle; rows that repeat are all
    returned, in one component; a null doc_id is returned with its
    component's id (null only if no document of the component has an id); an
    empty table gives an empty result; other columns are ignored whatever
    their names.
    """
    rows = staged(fingerprints(docs, shingle, id_col, text_col), "simhash-fp")
    distinct = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    labelled = (distinct.join(components(links(distinct, max_bits, blocks, run_limit)),
                              F.col("fp") == F.col("node"), "left")
                .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    heads = labelled.groupBy("root").agg(
        F.min(F.when(F.col("first_id").isNotNull(), F.struct("first_id", "fp"))).alias("head"),
        F.min("fp").alias("any_fp"))
    of_fp = labelled.join(heads, "root").select(
        "fp", F.col("head.first_id").alias("component_id"), F.coalesce("head.fp", "any_fp").alias("root_fp"))
    return rows.join(of_fp, "fp").select(
        "doc_id", "text_hash", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id", "root_fp")

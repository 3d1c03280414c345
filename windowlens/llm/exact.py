"""Exact duplicates through an extendible-hash index on shared files.

The index key of a text is the XXH64 of its normalised bytes; the directory
maps key prefixes to buckets.  Building it:

1. *Keys.*  One pass gives (doc_id, key, digest, bytes) of every row, staged.
2. *Directory.*  Bytes of distinct keys per prefix of ``max_depth`` bits
   (at most ``2**max_depth`` numbers, the only thing the driver sees) decide
   the buckets: a bucket over ``capacity`` bytes splits, and the directory
   doubles when a bucket as deep as the directory has to split.
3. *Combine.*  A second pass brings the texts.  Copies inside a task are
   combined first, by comparing bytes, in tables of at most ``HELD`` bytes,
   so a text that fills a third of the corpus reaches its owner about once a
   task.
4. *Owners.*  Buckets are key ranges; an owner task streams its buckets in
   key order, chains the different texts that share a key, compares bytes,
   and writes the entries (bucket, key, chain, keep_id, group_size, text) to
   the index, Parquet files in the shared folder.  It holds one key's chain
   at a time.
5. *Decisions.*  Every row looks up its entry by key and digest (two ids and
   a digest per row are shuffled, no text; AQE splits a hot key's rows).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windowlens.llm.common import batches_of, byte_values, documents_of, shuffle_partitions, staged
from windowlens.session import work_path

CAPACITY = 2 << 20    # bytes of normalised text in a bucket
MAX_DEPTH = 16        # bits of the directory at most (more for corpora of many terabytes)
HELD = 32 << 20       # bytes of text held while combining copies in a task

_KEYS = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("key", pa.int64()),
                   ("text_sha256", pa.string()), ("n_bytes", pa.int64())])
_COPIES = pa.schema([("bucket", pa.int32()), ("key", pa.int64()), ("keep_id", pa.int64()), ("copies", pa.int64()),
                     ("text", pa.string())])
_ENTRIES = pa.schema([("bucket", pa.int32()), ("key", pa.int64()), ("chain", pa.int32()), ("keep_id", pa.int64()),
                      ("group_size", pa.int64()), ("text_sha256", pa.string()), ("text", pa.string())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _key(normalised: bytes) -> int:
    return xxhash.xxh64_intdigest(normalised) - (1 << 63)


def _shown(normalised: bytes) -> str:
    """The text an entry holds; bytes that are not UTF-8 are spelt out."""
    return normalised.decode("utf-8", "backslashreplace")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [t.lower() for t in byte_values(b["text"])]
        yield pa.RecordBatch.from_arrays([
            b["doc_id"], b["text_hash"], pa.array([_key(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(_shown(t).encode()).hexdigest() for t in texts], pa.string()),
            pa.array([len(t) for t in texts], pa.int64())], schema=_KEYS)


# --- directory ---------------------------------------------------------------

def build_directory(cells: dict[int, int], max_depth: int, capacity: int) -> tuple[int, list[int], list[int]]:
    """(global depth, bucket of each directory slot, local depth of each
    bucket) for the bytes per ``max_depth``-bit prefix."""
    prefix = np.zeros((1 << max_depth) + 1, dtype=np.int64)
    for cell, size in cells.items():
        prefix[cell + 1] = size
    prefix = np.cumsum(prefix)

    def load(start: int, depth: int) -> int:
        width = 1 << (max_depth - depth)
        return int(prefix[(start + 1) * width] - prefix[start * width])

    depth, slots, buckets = 0, [0], [(0, 0)]       # buckets: (prefix, local depth)
    todo = [0]
    while todo:
        bucket = todo.pop()
        start, local = buckets[bucket]
        if load(start, local) <= capacity or local == max_depth:
            continue
        if local == depth:                          # directory doubling
            slots = [b for b in slots for _ in (0, 1)]
            depth += 1
        buckets[bucket] = (2 * start, local + 1)
        buckets.append((2 * start + 1, local + 1))
        width = 1 << (depth - local - 1)
        new = len(buckets) - 1
        slots[(2 * start + 1) * width:(2 * start + 2) * width] = [new] * width
        todo += [bucket, new]
    return depth, slots, [local for _, local in buckets]


def _directory(keys: DataFrame, max_depth: int, capacity: int) -> tuple[int, list[int], list[int]]:
    distinct = keys.groupBy("key").agg(F.max("n_bytes").alias("n_bytes"))
    cells = (distinct.groupBy(F.shiftright(F.col("key"), 64 - max_depth).alias("cell"))
             .agg(F.sum("n_bytes").alias("size")).collect())
    half = 1 << (max_depth - 1)
    return build_directory({r["cell"] + half: r["size"] for r in cells}, max_depth, capacity)


# --- combine and owners ------------------------------------------------------

def _combine(depth: int, slots: list[int], held: int = HELD):
    """Copies within a task, compared by bytes, in tables of bounded size."""
    slot = np.array(slots, dtype=np.int32)

    def rows(batches):
        table: dict[bytes, list] = {}
        size = 0
        for b in batches:
            for doc_id, text in zip(b["doc_id"].to_pylist(), byte_values(b["text"])):
                text = text.lower()
                entry = table.get(text)
                if entry is None:
                    table[text] = [doc_id, 1]
                    size += len(text) + 200
                    if size > held:
                        yield from emit(table)
                        table, size = {}, 0
                else:
                    entry[1] += 1
                    if entry[0] is None or (doc_id is not None and doc_id > entry[0]):
                        entry[0] = doc_id
        yield from emit(table)

    def emit(table):
        for text, (doc_id, n) in table.items():
            key = _key(text)
            bucket = int(slot[(key + (1 << 63)) >> (64 - depth)]) if depth else 0
            yield bucket, key, doc_id, n, _shown(text)

    def run(batches):
        return batches_of(_COPIES, rows(batches), 2_000)
    return run


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Key-sorted copies -> index entries: texts that share a key form a
    chain; a text joins the entry whose bytes it equals."""
    def rows():
        at, chain = None, []
        for b in batches:
            cols = [b[c].to_pylist() for c in ("bucket", "key", "keep_id", "copies", "text")]
            for bucket, key, doc_id, n, text in zip(*cols):
                if key != at:
                    yield from entries(at, chain)
                    at, chain = key, []
                for e in chain:
                    if e[3] == text:
                        e[2] += n
                        if e[1] is None or (doc_id is not None and doc_id > e[1]):
                            e[1] = doc_id
                        break
                else:
                    chain.append([bucket, doc_id, n, text])
        yield from entries(at, chain)

    def entries(key, chain):
        for i, (bucket, keep_id, n, text) in enumerate(chain):
            yield bucket, key, i, keep_id, n, hashlib.sha256(text.encode()).hexdigest(), text

    return batches_of(_ENTRIES, rows(), 2_000)


# --- operator ----------------------------------------------------------------

def build_index(docs: DataFrame, keys: DataFrame, path: str, capacity: int = CAPACITY,
                max_depth: int = MAX_DEPTH) -> DataFrame:
    """Write the index of ``docs`` (doc_id, text) to ``path`` and return it."""
    depth, slots, local = _directory(keys, max_depth, capacity)
    owners = max(len(local), shuffle_partitions(docs))
    index = (docs.mapInArrow(_combine(depth, slots), _ddl(_COPIES))
             .repartition(owners, "bucket").sortWithinPartitions("bucket", "key")
             .mapInArrow(_own, _ddl(_ENTRIES)))
    index.write.parquet(path)
    return docs.sparkSession.read.schema(index.schema).parquet(path)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                     capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> DataFrame:
    """One row per document: (doc_id, text_hash, keep_id, group_size, kept,
    text_sha256).

    Texts are equal when their bytes are after lower-casing A-Z; of equal
    texts the row with the largest doc_id stays.  ``path`` is where the index
    is written (default: a new folder under the shared checkpoint folder).

    A null text counts as empty, and empty texts are equal to each other.
    Null doc_ids lose against any id; a group without ids has a null keep_id
    and its rows are kept.  Rows that repeat doc_id and text are the same
    document and share its decision (the pipeline keeps one of them).  Texts
    that are not UTF-8 are compared by their bytes; their digest is that of
    the text with the wrong bytes spelt out (``\\xff``).  An empty table gives an empty result; other columns are ignored whatever
    their names.
    """
    d = documents_of(docs, id_col, text_col)
    keys = staged(d.withColumn("text_hash", F.xxhash64("text")).mapInArrow(_keys, _ddl(_KEYS)), "exact-keys")
    index = build_index(d, keys, path or work_path(docs.sparkSession, "llm-exact-index"), capacity, max_depth)
    found = keys.join(index.select("key", "text_sha256", "keep_id", "group_size"), ["key", "text_sha256"])
    return found.select("doc_id", "text_hash", "keep_id", "group_size",
                        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")

"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text; a chunk ends where the top bits
of the hash are zero, so the borders depend on the last 16 bytes only and an
insertion moves no border beyond its own chunk.  Chunks are at least
``min_chunk`` bytes, at most ``max_chunk``, on average about
``min_chunk + 2**cut_bits``, and never split a character.  The chunks that
hold the first and last words of a passage differ from copy to copy, so the
chunks must be small against the 51 words of a passage that has to be found.

1. *Filter.*  Most chunks occur once and need not be moved.  Every task sends
   the distinct digests of its texts, cut to five bytes and packed, to one
   task a digest range; digests that arrive twice set a bit of a bitmap of
   ``2**filter_bits`` bits, which goes to all tasks.  It lets a few single
   chunks pass and never stops a repeated one.
2. *Places.*  XXH3-128 of the chunks that pass, counted by digest with partial
   aggregation, so a passage in a third of all documents costs one row a
   task.  Digests seen more than once are staged with their first place (the
   smallest document id, then the smallest start) and joined with the chunks
   that passed; AQE splits the rows of a hot digest.
3. *Spans.*  Neighbouring repeated chunks of a document form a span.  A span
   of at least ``min_words`` words is a repeat; the chunks at their first
   place are never part of one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from windowlens.llm.common import byte_values, documents_of, same, shuffle_partitions, staged

MIN_CHUNK = 12
MAX_CHUNK = 1024
CUT_BITS = 3
MIN_WORDS = 20
FILTER_BITS = 27    # 16 MB; enough for some 10**8 repeated chunks, more let more single chunks pass
HELD = 4_000_000    # digests a task holds before it sends them
_CUT = 24           # bits of a 64-bit digest that the filter's five bytes leave out

_GEAR = np.random.default_rng(2016).integers(0, 1 << 32, 256, dtype=np.uint32)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash after every byte, over the last 16 bytes."""
    h = _GEAR[data]
    for width in (1, 2, 4, 8):       # doubling: a window of 2, 4, 8, 16 bytes
        more = h.copy()
        more[width:] += h[:-width] << np.uint32(width)
        h = more
    return h


def borders(data: np.ndarray, starts: list[int], ends: list[int], min_chunk: int = MIN_CHUNK,
            max_chunk: int = MAX_CHUNK, cut_bits: int = CUT_BITS) -> list[list[int]]:
    """Chunk ends of each text of a buffer of texts."""
    hashes = gear_hashes(data)
    at, end, h = np.array(starts, np.int64), np.array(ends, np.int64), np.zeros(len(starts), np.uint32)
    for _ in range(15):                               # without bytes of the text before
        going = at < end
        at, end, h = at[going], end[going], h[going]
        h = (h << np.uint32(1)) + _GEAR[data[at]]
        hashes[at] = h
        at = at + 1
    may = (hashes >> np.uint32(32 - cut_bits)) == 0
    inside = (data & 0xC0) == 0x80                    # bytes that go on a character
    may[:-1] &= ~inside[1:]
    cuts = np.flatnonzero(may) + 1
    out = []
    for a, b, i, j in zip(starts, ends, np.searchsorted(cuts, starts, "right").tolist(),
                          np.searchsorted(cuts, ends, "left").tolist()):
        found, last = [], a
        for c in cuts[i:j].tolist() + [b]:
            while c - last > max_chunk:
                last += max_chunk
                while inside[last]:
                    last -= 1
                found.append(last)
            if c - last >= min_chunk and c < b:
                found.append(c)
                last = c
        if b > a:
            found.append(b)
        out.append(found)
    return out


_CHUNKS = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("i", pa.int32()), ("start", pa.int32()),
                     ("size", pa.int32()), ("n_words", pa.int32()), ("hi", pa.int64()), ("lo", pa.int64())])
_CHUNKS_DDL = "doc_id long, text_hash long, i int, start int, size int, n_words int, hi long, lo long"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, int, list[bytes]]]:
    """A few megabytes of texts at a time, with their places in the batch."""
    for b in batches:
        texts = byte_values(b["text"])
        at, size = 0, 0
        for k, t in enumerate(texts):
            size += len(t)
            if size > 4_000_000 or k == len(texts) - 1:
                yield b, at, k + 1, texts[at:k + 1]
                at, size = k + 1, 0


class _Cut:
    """The chunks of some texts laid end to end."""

    def __init__(self, texts: list[bytes], min_chunk: int, max_chunk: int, cut_bits: int):
        self.buffer = b"".join(texts)
        self.data = np.frombuffer(self.buffer, np.uint8)
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.first = np.cumsum(self.sizes) - self.sizes
        found = borders(self.data, self.first.tolist(), (self.first + self.sizes).tolist(), min_chunk, max_chunk, cut_bits)
        self.per = np.fromiter(map(len, found), np.int64, len(found))
        self.end = np.array([x for f in found for x in f], dtype=np.int64)
        self.head = np.cumsum(self.per) - self.per
        self.start = np.empty_like(self.end)
        self.start[1:] = self.end[:-1]
        self.start[self.head[self.per > 0]] = self.first[self.per > 0]
        digest = xxhash.xxh3_128_digest
        raw = b"".join([digest(self.buffer[a:b]) for a, b in zip(self.start.tolist(), self.end.tolist())])
        self.digests = np.frombuffer(raw, ">u8").astype(np.uint64).reshape(-1, 2)


_PACKED = pa.schema([("part", pa.int32()), ("digests", pa.binary())])


def repeated_filter(d: DataFrame, min_chunk: int, max_chunk: int, cut_bits: int,
                    filter_bits: int = FILTER_BITS) -> np.ndarray:
    """Bitmap over the first ``filter_bits`` bits of the digests: set where a
    digest's first 40 bits occur more than once in the texts."""
    n = shuffle_partitions(d)
    part_bits = min(max(0, n - 1).bit_length(), filter_bits - 3)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for _, _, _, texts in _pieces(batches):
            held.append(_Cut(texts, min_chunk, max_chunk, cut_bits).digests[:, 0] >> np.uint64(_CUT))
            size += len(held[-1])
            if size > HELD:
                yield from packed(held)
                held, size = [], 0
        yield from packed(held)

    def packed(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        found, times = np.unique(np.concatenate(held or [np.empty(0, np.uint64)]), return_counts=True)
        found = np.repeat(found, np.minimum(times, 2))
        bounds = np.searchsorted(found >> np.uint64(40 - part_bits), np.arange((1 << part_bits) + 1))
        short = found.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
        some = [(p, short[a:b].tobytes()) for p, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])) if b > a]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in some], pa.int32()),
                                          pa.array([x for _, x in some], pa.binary())], schema=_PACKED)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []
        for b in batches:
            for p, blob in zip(b["part"].to_pylist(), b["digests"].to_pylist()):
                if p != part:
                    yield marked(part, held)
                    part, held = p, []
                held.append(blob)
        yield marked(part, held)

    def marked(part: int | None, held: list[bytes]) -> pa.RecordBatch:
        if part is None:
            return pa.RecordBatch.from_arrays([pa.array([], pa.int32()), pa.array([], pa.binary())], schema=_PACKED)
        short = np.frombuffer(b"".join(held), np.uint8).reshape(-1, 5)
        full = np.zeros((len(short), 8), np.uint8)
        full[:, :5] = short
        found = np.sort(full.view("<u8").ravel())
        twice = found[1:][found[1:] == found[:-1]] >> np.uint64(40 - filter_bits)
        bits = np.zeros(1 << (filter_bits - part_bits), np.uint8)
        bits[twice.astype(np.int64) & (len(bits) - 1)] = 1
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(bits).tobytes()], pa.binary())],
                                          schema=_PACKED)

    ddl = "part int, digests binary"
    slices = (d.select("text").mapInArrow(send, ddl).repartition(n, "part").sortWithinPartitions("part")
              .mapInArrow(meet, ddl))
    bitmap = np.zeros((1 << part_bits, 1 << (filter_bits - part_bits - 3)), np.uint8)
    for r in slices.toLocalIterator():            # 2**filter_bits bits in all
        bitmap[r["part"]] = np.frombuffer(r["digests"], np.uint8)
    return bitmap.ravel()


def chunks(docs: DataFrame, min_chunk: int = MIN_CHUNK, max_chunk: int = MAX_CHUNK, cut_bits: int = CUT_BITS,
           id_col: str = "doc_id", text_col: str = "text", filter_bits: int | None = None) -> DataFrame:
    """(doc_id, text_hash, i, start, size, n_words, hi, lo): the chunks of
    every text, places in UTF-8 bytes, digest in two longs.  With
    ``filter_bits`` most chunks that occur once are left out."""
    d = documents_of(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    sent = None
    if filter_bits:
        sent = d.sparkSession.sparkContext.broadcast(
            repeated_filter(d, min_chunk, max_chunk, cut_bits, filter_bits))

    def some(ids: np.ndarray, hashes: np.ndarray, texts: list[bytes]) -> pa.RecordBatch:
        c = _Cut(texts, min_chunk, max_chunk, cut_bits)
        space = _SPACE[c.data]
        opens = ~space
        opens[1:] &= space[:-1]
        opens[c.first[c.sizes > 0]] = ~space[c.first[c.sizes > 0]]
        counted = np.concatenate(([0], np.cumsum(opens)))
        of = np.repeat(np.arange(len(texts)), c.per)
        keep = np.arange(len(c.end))
        if sent is not None:
            bit = (c.digests[:, 0] >> np.uint64(64 - filter_bits)).astype(np.int64)
            keep = np.flatnonzero((sent.value[bit >> 3] >> (7 - (bit & 7))) & 1)
        of, start, end = of[keep], c.start[keep], c.end[keep]
        halves = c.digests[keep].view(np.int64)
        return pa.RecordBatch.from_arrays([
            pa.array(ids[of], from_pandas=True).cast(pa.int64()), pa.array(hashes[of]),
            pa.array((keep - c.head[of]).astype(np.int32)), pa.array((start - c.first[of]).astype(np.int32)),
            pa.array((end - start).astype(np.int32)), pa.array((counted[end] - counted[start]).astype(np.int32)),
            pa.array(halves[:, 0]), pa.array(halves[:, 1])], schema=_CHUNKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, at, to, texts in _pieces(batches):
            part = b.slice(at, to - at)
            ids = (np.array(part["doc_id"].to_pylist(), dtype=object) if b["doc_id"].null_count
                   else part["doc_id"].to_numpy(zero_copy_only=False))
            yield some(ids, part["text_hash"].to_numpy(zero_copy_only=False), texts)

    return d.mapInArrow(run, _CHUNKS_DDL)


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS, min_chunk: int = MIN_CHUNK,
                   max_chunk: int = MAX_CHUNK, cut_bits: int = CUT_BITS, id_col: str = "doc_id",
                   text_col: str = "text", filter_bits: int | None = FILTER_BITS) -> DataFrame:
    """One row per repeat: (doc_id, text_hash, start, size, n_words,
    n_chunks, first_doc_id, copies).

    ``start`` and ``size`` are UTF-8 bytes of the text, ``first_doc_id`` is
    the document that keeps the passage (most of its chunks), ``copies`` how
    often its rarest chunk occurs.

    Null and empty texts have no chunks and no repeats; a passage repeated
    inside one text is a repeat too; rows that repeat both id and text are
    the same document and do not repeat each other; of equal documents with
    different ids the smallest id keeps its text; null ids come last and
    never keep before others; an empty table gives an empty result; other
    columns are ignored whatever their names.
    """
    rows = chunks(docs, min_chunk, max_chunk, cut_bits, id_col, text_col, filter_bits)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "start")
    known = (rows.groupBy("hi", "lo").agg(F.count("*").alias("copies"), F.min(order).alias("first"))
             .where("copies > 1").select(F.col("hi").alias("k_hi"), F.col("lo").alias("k_lo"), "copies", "first"))
    known = staged(known, "substring-known")
    again = (rows.join(known, (F.col("hi") == F.col("k_hi")) & (F.col("lo") == F.col("k_lo")))
             .where(~(same(F.col("doc_id"), F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
                      & (F.col("start") == F.col("first.start"))))
             .select("doc_id", "text_hash", "i", "start", "size", "n_words", "copies",
                     F.col("first.doc_id").alias("first_doc_id")).distinct())
    w = Window.partitionBy("doc_id", "text_hash").orderBy("i")
    islands = again.withColumn("island", F.col("i") - F.row_number().over(w))
    return (islands.groupBy("doc_id", "text_hash", "island")
            .agg(F.min("start").alias("start"), F.sum("size").alias("size"), F.sum("n_words").alias("n_words"),
                 F.count("*").alias("n_chunks"), F.mode("first_doc_id", True).alias("first_doc_id"),
                 F.min("copies").alias("copies"))
            .where(F.col("n_words") >= min_words).drop("island"))


def without_repeats(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with the spans cut out; null texts stay null."""
    cut = spans.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("start", "size"))).alias("cuts"))   # bounded by the text's length
    d = documents_of(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    c = cut.select(F.col("doc_id").alias("c_id"), F.col("text_hash").alias("c_hash"), "cuts")
    joined = d.join(c, same(F.col("doc_id"), F.col("c_id")) & (F.col("text_hash") == F.col("c_hash")), "left")
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        for b in batches:
            out = []
            for text, cuts in zip(b["text"].to_pylist(), b["cuts"].to_pylist()):
                if text is not None and cuts:
                    raw = text.encode()
                    parts, at = [], 0
                    for s in cuts:
                        parts.append(raw[at:s["start"]])
                        at = s["start"] + s["size"]
                    text = b"".join(parts + [raw[at:]]).decode()
                out.append(text)
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(out, pa.string())], schema=schema)

    return joined.select("doc_id", "text", "cuts").mapInArrow(run, "doc_id long, text string")

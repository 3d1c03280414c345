"""Best-fit packing by hierarchical residual rounds.

1. *Pieces.*  Documents are tokenised in one pass; ids plus an end id form a
   document, cut into pieces of ``capacity`` only if longer.  The table of
   pieces (numbers only) is staged.
2. *Local round.*  Pieces are dealt by a hash into groups of about
   ``group_rows``; every group is packed by best fit, longest first.
   Sequences filled to within ``slack`` tokens are emitted.
3. *Tree rounds.*  Underfull sequences of several groups become the items of
   one group in the next round, and are packed by best fit again, whole.
   Rounds go on until one group is left, or until a round over several
   groups saves no sequence.  A group never holds more than about
   ``group_rows`` items, and every round works on rows of two numbers.
4. *Places.*  The rounds' tables are joined: piece -> sequence and offset.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windowlens.llm.common import ByteCache, documents_of, staged

CAPACITY = 4096
END_ID = 1
GROUP_ROWS = 50_000
SLACK = 8

# --- tokens ------------------------------------------------------------------

#: Bytes of remembered chunks, and of pieces of chunks, a Python worker holds.
CHUNK_BYTES = 128 << 20

_PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
_PLAIN = re.compile(r"[\x21-\x7eÀ-ÿ]+\Z")
#: ``_PIECE`` on lower-cased ASCII without white space.
_ASCII_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for a byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordTokenizer:
    """Ids of a ``tokenizers`` file whose pieces never cross white space and
    that lower-cases its input: texts are cut at ASCII white space and the
    ids of a chunk are remembered, up to a number of bytes; chunks of over
    256 bytes (text without blanks) are not.  Chunks of Latin letters and ASCII take
    the vocabulary's own pattern and merges directly; every other chunk goes
    through the whole tokenizer.  Ids equal those of the whole text."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.pieces = regex.compile(_PIECE)
        self.letters = byte_letters()
        self.chunks = ByteCache(CHUNK_BYTES)

    def _merged(self, word: str) -> bytes:
        """Ids of one piece; ASCII letters stand for themselves."""
        mapped = word if word.isascii() else "".join([self.letters[b] for b in word.encode()])
        return array("I", [t.id for t in self.merge(mapped)]).tobytes()

    def _piece(self, word: str) -> bytes:
        """A piece has the ids of a chunk that is this piece, so both share
        one memory."""
        key = word.encode()
        ids = self.chunks.get(key)
        if ids is None:
            ids = self._merged(word)
            self.chunks.put(key, ids)
        return ids

    def _chunk(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        if text.isalpha() and text.isascii():
            ids = self._merged(text.lower())
        elif _PLAIN.match(text) and "<|" not in text:
            text = text.lower()
            found = _ASCII_PIECE.findall(text) if text.isascii() else self.pieces.findall(text)
            ids = b"".join(map(self._piece, found))
        else:
            ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        self.chunks.put(chunk, ids)
        return ids

    def __call__(self, text: bytes) -> bytes:
        """Unsigned 32-bit ids."""
        chunks = (text.lower() if text.isascii() else text).split()
        ids = list(map(self.chunks.get, chunks))
        new = [i for i, known in enumerate(ids) if known is None] if None in ids else ()
        for i in new:
            ids[i] = self.chunks.get(chunks[i]) or self._chunk(chunks[i])
        return b"".join(ids)


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


_PIECES = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                     ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32()))])
_PIECES_DDL = "doc_id long, text_hash long, piece int, start long, length long, ids_crc32 long, ids array<int>"


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, piece, start, length, ids_crc32, ids): the pieces
    of every document; ``ids`` is null unless ``with_ids``."""
    end = array("I", [end_id]).tobytes()
    width = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(tokenizer_path)
        for b in batches:
            cols = [[] for _ in _PIECES]
            for doc_id, h, text in zip(b["doc_id"].to_pylist(), b["text_hash"].to_pylist(), b["text"].to_pylist()):
                ids = encode((text or "").encode()) + end
                for i, at in enumerate(range(0, len(ids), width)):
                    cut = ids[at:at + width]
                    row = (doc_id, h, i, at // 4, len(cut) // 4, zlib.crc32(cut),
                           np.frombuffer(cut, "<i4") if with_ids else None)
                    for col, v in zip(cols, row):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _PIECES)], schema=_PIECES)

    d = documents_of(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return d.mapInArrow(run, _PIECES_DDL)


# --- rounds ------------------------------------------------------------------

def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit, longest first: (bin, offset) of every item and the fill of
    every bin.  Among bins that fit, the fullest is taken."""
    bins, offsets, fills = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0                                    # bit r: some bin has room r
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fit = rooms >> size
        if fit:
            room = size + (fit & -fit).bit_length() - 1
            bin_ = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, bin_ = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = bin_, fills[bin_]
        fills[bin_] += size
        if room > size:
            by_room[room - size].append(bin_)
            rooms |= 1 << (room - size)
    return bins, offsets, np.array(fills, dtype=np.int64)


_PLACED_DDL = "item long, bin long, at long, fill long"


def _round(items: DataFrame, groups: int, level: int, capacity: int, name: str) -> DataFrame:
    """Best fit inside every group: (item, bin, at, fill), staged."""
    def pack(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("item")
        bins, at, fills = best_fit(table["size"].to_numpy(), capacity)
        base = (level << 56) + (key[0].as_py() << 24)
        return pa.table({"item": table["item"], "bin": pa.array(base + bins), "at": pa.array(at),
                         "fill": pa.array(fills[bins])})

    return staged(items.groupBy("g").applyInArrow(pack, _PLACED_DDL), name)


def _dealt(items: DataFrame, groups: int) -> DataFrame:
    return items.withColumn("g", F.pmod(F.xxhash64("item"), F.lit(groups)))


def pack(items: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, slack: int = SLACK) -> DataFrame:
    """``items`` (item long unique, size long in 1..capacity) -> (item,
    sequence_id, offset).  Offsets of a sequence are gapless from 0."""
    n = items.count()
    groups = max(1, -(-n // group_rows))
    first = _round(_dealt(items, groups), groups, 0, capacity, "pack-0")
    rounds, level, now = [], 0, first
    while groups > 1:
        open_bins = (now.where(F.col("fill") < capacity - slack).groupBy("bin").agg(F.max("fill").alias("size"))
                     .withColumnRenamed("bin", "item"))
        n = open_bins.count()
        if n == 0:
            break
        groups, before, level = max(1, min(-(-groups // 8), -(-n // group_rows))), n, level + 1
        if n > group_rows * groups:
            groups = -(-n // group_rows)
        now = _round(_dealt(open_bins, groups), groups, level, capacity, f"pack-{level}")
        rounds.append(now)
        if groups > 1 and now.select("bin").distinct().count() == before:
            break
    places = first.select("item", "bin", F.col("at").alias("offset"))
    for moved in rounds:
        up = moved.select(F.col("item").alias("bin"), F.col("bin").alias("into"), F.col("at").alias("more"))
        places = places.join(up, "bin", "left").select(
            "item", F.coalesce("into", "bin").alias("bin"),
            (F.col("offset") + F.coalesce("more", F.lit(0))).alias("offset"))
    return places.select("item", F.col("bin").alias("sequence_id"), "offset")


# --- operator ----------------------------------------------------------------

def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   group_rows: int = GROUP_ROWS, slack: int = SLACK, with_ids: bool = False,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: (doc_id, text_hash, piece, start, length,
    ids_crc32, ids, sequence_id, offset).

    A null or blank text is the end id alone.  Rows that repeat are separate
    documents with places of their own, a null doc_id is carried along, very
    long texts become several pieces, ties in length go by row, an empty
    table gives an empty result; other columns are ignored whatever their
    names.
    """
    cut = staged(pieces(docs, tokenizer_path, capacity, end_id, with_ids, id_col, text_col)
                 .withColumn("item", F.monotonically_increasing_id()), "pack-pieces")
    places = pack(cut.select("item", F.col("length").alias("size")), capacity, group_rows, slack)
    return cut.join(places, "item").select(
        "doc_id", "text_hash", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids, doc_ids) of pieces packed ``with_ids``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return (packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
            .select("sequence_id", "n_tokens", F.flatten(F.col("parts.ids")).alias("ids"),
                    F.col("parts.doc_id").alias("doc_ids")))

"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of all test items go into one suffix automaton (a state
per set of end positions).  Documents are streamed through it word by word:
the automaton keeps the longest suffix read so far that occurs in some item,
so one pass finds every shared passage of any length.  Where the match is at
least ``window`` words long, all its words are hit, and the items that hold
its last ``window`` words are those of the state reached by suffix links.
An item shorter than the window counts when it is matched whole.

Words that occur in no item reset the automaton, so only stretches of known
words at least as long as the shortest window are streamed at all; the
result is the same.

The items are read and normalised in tasks, dealt to blocks of about
``block_words`` words (longer items are cut into parts that overlap by a
window less one word), and every block's automaton is built in a task and
written to the shared folder.  One block is sent to the workers at a time: a
pass of its own finds its hits, and only hits are kept between passes, so
neither the driver nor a worker ever holds more than one block.
"""

from __future__ import annotations

import hashlib
import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windowlens.llm.common import (batches_of, byte_values, documents_of, keep_rows, place, positional, same, ship,
                                   staged, take)

WINDOW = 10
BLOCK_WORDS = 250_000

#: Bytes of words: digits, a-z and everything outside ASCII; A-Z become a-z.
_WORD_BYTES = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32
                    for c in range(256))


def words(text: bytes) -> list[bytes]:
    """Normalised words of a UTF-8 text."""
    return text.translate(_WORD_BYTES).split()


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.len = [0]
        self.shortest = window
        self._paths: list[tuple[str, list[int]]] = []

    def add(self, item_id: str, item: list[bytes]) -> None:
        if not item:
            return
        self.shortest = min(self.shortest, len(item))
        last = 0
        for w in item:
            last = self._extend(last, self.vocabulary.setdefault(w, len(self.vocabulary) + 1))
        self._paths.append((item_id, [self.vocabulary[w] for w in item]))

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[last] + 1 == length[q] else self._clone(last, q, c)
        cur = self._state({}, 0, length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[p] + 1 == length[q] else self._clone(p, q, c)
        return cur

    def _state(self, edges: dict[int, int], link: int, length: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.len.append(length)
        return len(self.next) - 1

    def _clone(self, p: int, q: int, c: int) -> int:
        new = self._state(dict(self.next[q]), self.link[q], self.len[p] + 1)
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        self.link[q] = new
        return new

    def finish(self) -> "SuffixAutomaton":
        """Items of every state that can end a window.  ``window_state[v]``
        is the state of the last ``window`` words of a match ending in v;
        ``short[v]`` the shorter items that end there, with their lengths."""
        n = len(self.next)
        self.items: dict[int, set[str]] = {}
        whole: dict[int, list[tuple[int, str]]] = {}
        order = sorted(range(n), key=self.len.__getitem__)
        self.window_state = [0] * n
        for v in order[1:]:
            up = self.link[v]
            if self.len[v] >= self.window:
                self.window_state[v] = self.window_state[up] if self.len[up] >= self.window else v
        for item_id, ids in self._paths:
            v = 0
            for c in ids:
                v = self.next[v][c]
                if self.window_state[v]:
                    self.items.setdefault(self.window_state[v], set()).add(item_id)
            if len(ids) < self.window:
                while self.len[self.link[v]] >= len(ids):
                    v = self.link[v]
                whole.setdefault(v, []).append((len(ids), item_id))
        self.short: dict[int, list[tuple[int, str]]] = {}
        for v in order[1:]:
            ends = self.short.get(self.link[v], []) + whole.get(v, [])
            if ends:
                self.short[v] = ends
        del self._paths
        return self

    def scan(self, ids: list[int], base: int, spans: list[tuple[int, int]], items: set[str]) -> None:
        """Stream word ids; append the hit spans (first, past last), starting
        at ``base``, and add the items."""
        nxt, link, length = self.next, self.link, self.len
        window, window_state, short = self.window, self.window_state, self.short
        v = matched = 0
        for at, c in enumerate(ids, base + 1):
            edges = nxt[v]
            while c not in edges and v:
                v = link[v]
                matched = length[v]
                edges = nxt[v]
            if c in edges:
                v = edges[c]
                matched += 1
            if matched >= window:
                spans.append((at - matched, at))
                items |= self.items[window_state[v]]
            if short and v in short:
                for n, item_id in short[v]:
                    if n <= matched:
                        spans.append((at - n, at))
                        items.add(item_id)

    def hits(self, text_words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged hit spans of a text, in words, and the items hit."""
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        known = self.vocabulary.get
        ids = [known(w, 0) for w in text_words]
        gaps = np.flatnonzero(np.array(ids + [0], dtype=np.int32) == 0)
        starts = np.concatenate(([0], gaps[:-1] + 1))
        long = gaps - starts >= self.shortest
        for a, b in zip(starts[long].tolist(), gaps[long].tolist()):
            self.scan(ids[a:b], a, spans, items)
        return merge(spans), items


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted, disjoint spans; touching spans are joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of ``spans`` (and what lies between the
    words of a span)."""
    at = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(_WORD_BYTES))]
    out, end = [], 0
    for a, b in spans:
        out.append(text[end:at[a][0]])
        end = at[b - 1][1]
    return b"".join(out + [text[end:]])


def _item_parts(items: DataFrame, id_col: str, text_col: str, window: int, part_words: int) -> DataFrame:
    """(item_id, words, n): the normalised words of every item, joined by
    blanks, in parts of at most ``part_words``; repeated parts count once."""
    rows = take(items, item_id=id_col, text=text_col).select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"),
        F.col("text").cast("string").alias("text")).where("text is not null")
    schema = pa.schema([("item_id", pa.string()), ("words", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            def parts():
                for item_id, text in zip(b["item_id"].to_pylist(), byte_values(b["text"])):
                    item = words(text)
                    for at in range(0, max(1, len(item) - window + 1) if item else 0, part_words - window + 1):
                        part = item[at:at + part_words]
                        yield item_id, b" ".join(part), len(part)
            yield from batches_of(schema, parts(), 1_000)

    return rows.mapInArrow(run, "item_id string, words binary, n long").distinct()


def _blocks(items: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> tuple[DataFrame, list[int]]:
    """The automata, pickled, as a table (block, automaton) in the shared
    folder, and the numbers of its blocks."""
    ship(items.sparkSession)
    # parts well below a block, so that blocks dealt by a hash are about equal
    parts = staged(_item_parts(items, id_col, text_col, window, max(2 * window, block_words // 16)), "item-parts")
    blocks = max(1, -(-(parts.agg(F.sum("n")).first()[0] or 0) // block_words))

    def build(key: tuple, table: pa.Table) -> pa.Table:
        automaton = SuffixAutomaton(window)
        for row in table.sort_by([("item_id", "ascending"), ("words", "ascending")]).to_pylist():
            automaton.add(row["item_id"], row["words"].split())
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()),
                         "automaton": pa.array([pickle.dumps(automaton.finish())], pa.binary())})

    built = staged(parts.withColumn("block", F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)))
                   .groupBy("block").applyInArrow(build, "block long, automaton binary"), "automata")
    return built, sorted(r["block"] for r in built.select("block").collect())


def _sent(built: DataFrame, block: int | None, window: int) -> tuple:
    """The broadcast automaton of one block (None: of no items), its name."""
    raw = (pickle.dumps(SuffixAutomaton(window).finish()) if block is None else
           bytes(built.where(F.col("block") == block).first()["automaton"]))
    return built.sparkSession.sparkContext.broadcast(raw), hashlib.sha256(raw).hexdigest()


_LOADED: dict[str, SuffixAutomaton] = {}


def _load(raw: bytes, name: str) -> SuffixAutomaton:
    """The automaton of a block; a worker holds one at a time."""
    if name not in _LOADED:
        _LOADED.clear()
        _LOADED[name] = pickle.loads(raw)
    return _LOADED[name]


_SPAN = pa.struct([("first_word", pa.int32()), ("words", pa.int32())])
_OUT = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
                  ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_()),
                  ("items", pa.list_(pa.string())), ("spans", pa.list_(_SPAN)), ("removed", pa.bool_()),
                  ("clean_text", pa.string())])
_OUT_DDL = ("doc_id long, text_hash long, n_words long, n_hit long, n_items long, items_sha256 string, "
            "contaminated boolean, items array<string>, spans array<struct<first_word:int,words:int>>, "
            "removed boolean, clean_text string")
_HITS = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("flat", pa.list_(pa.int32())),
                   ("items", pa.list_(pa.string()))])
_HITS_DDL = "doc_id long, text_hash long, flat array<int>, items array<string>"


def _hits(automaton, name: str):
    """The documents with hits in one block: spans (flat) and items."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = _load(automaton.value, name)

        def rows():
            for b in batches:
                for doc_id, h, text in zip(b["doc_id"].to_pylist(), b["text_hash"].to_pylist(), byte_values(b["text"])):
                    spans, items = scan.hits(words(text))
                    if spans:
                        yield doc_id, h, [x for s in spans for x in s], sorted(items)

        return batches_of(_HITS, rows(), 1_000)

    return run


def _result(found_in, max_span: int, max_coverage: float, texts: bool):
    """The result rows; ``found_in(batch, words of its texts)`` gives the
    merged spans and the items of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = byte_values(b["text"])
            null = b["text"].is_null().to_pylist()
            found = found_in(b, raw)
            n_hit = [sum(y - x for x, y in spans) for _, spans, _ in found]
            gone = [h > 0 and h > max_coverage * n for h, (n, *_) in zip(n_hit, found)]
            yield pa.RecordBatch.from_arrays([
                b["doc_id"], b["text_hash"],
                pa.array([n for n, *_ in found], pa.int64()), pa.array(n_hit, pa.int64()),
                pa.array([len(items) for *_, items in found], pa.int64()),
                pa.array([hashlib.sha256(",".join(items).encode()).hexdigest() for *_, items in found]),
                pa.array([h > 0 for h in n_hit]),
                pa.array([items for *_, items in found], _OUT.field("items").type),
                pa.array([[(x, y - x) for x, y in spans] for _, spans, _ in found], _OUT.field("spans").type),
                pa.array(gone),
                pa.array([None if g or n or not texts else
                          without(t, [s for s in spans if s[1] - s[0] > max_span]).decode()
                          for t, n, g, (_, spans, _) in zip(raw, null, gone, found)], pa.string())], schema=_OUT)
    return run


def _scanned(automaton, name: str):
    def found_in(batch: pa.RecordBatch, raw: list[bytes]) -> list[tuple]:
        scan, out = _load(automaton.value, name), []
        for text in raw:
            w = words(text)
            spans, items = scan.hits(w)
            out.append((len(w), spans, sorted(items)))
        return out

    return found_in


def _joined(batch: pa.RecordBatch, raw: list[bytes]) -> list[tuple]:
    """Spans and items of all blocks, as the join brought them."""
    return [(len(words(text)), merge(list(zip(flat[::2], flat[1::2]))) if flat else [], sorted(set(items or ())))
            for text, flat, items in zip(raw, batch["flat"].to_pylist(), batch["items"].to_pylist())]


def _found(d: DataFrame, built: DataFrame, blocks: list[int], window: int) -> DataFrame:
    """(doc_id, text_hash, flat, items) of the documents with hits in any
    block: a pass a block, whose hits are written before the next."""
    found = None
    for block in blocks:
        automaton, name = _sent(built, block, window)
        now = staged(d.mapInArrow(_hits(automaton, name), _HITS_DDL).distinct(), "hits")
        automaton.unpersist()
        found = now if found is None else found.unionByName(now)
    return found.groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list("flat")).alias("flat"),
                                                    F.flatten(F.collect_list("items")).alias("items"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_span: int = 0,
                  max_coverage: float = 1.0, texts: bool = True, block_words: int = BLOCK_WORDS,
                  id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: (doc_id, text_hash, n_words, n_hit, n_items,
    items_sha256, contaminated, items, spans, removed, clean_text).

    ``spans`` are the hit stretches in words.  A document with a share of hit
    words over ``max_coverage`` is ``removed`` (0 removes every contaminated
    one); from the others ``clean_text`` has the spans longer than
    ``max_span`` words taken out (``texts=False`` leaves it null).

    Null and empty texts have no words and are never contaminated; items that
    are null or have no words match nothing; items with the same id count
    once, a null item_id is called "null"; rows that repeat are each
    returned; an empty document or item table gives no rows or no hits; other
    columns are ignored whatever their names.
    """
    d = documents_of(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    built, blocks = _blocks(items, item_id_col, item_text_col, window, block_words)
    if len(blocks) < 2:
        found_in = _scanned(*_sent(built, blocks[0] if blocks else None, window))
    else:
        f = _found(d, built, blocks, window).withColumnsRenamed({"doc_id": "f_id", "text_hash": "f_hash"})
        d = d.join(f, same(F.col("doc_id"), F.col("f_id")) & same(F.col("text_hash"), F.col("f_hash")), "left").select(
            "doc_id", "text_hash", "text", "flat", "items")
        found_in = _joined
    return d.mapInArrow(_result(found_in, max_span, max_coverage, texts), _OUT_DDL)


def keep_clean(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS,
               id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
               item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) that :func:`decontaminate` keeps
    with a coverage limit of 0: those without any hit word.  Items of one
    block take one pass without a shuffle; more blocks take a pass each and
    one anti join on (id, text hash)."""
    built, blocks = _blocks(items, item_id_col, item_text_col, window, block_words)
    if len(blocks) < 2:
        automaton, name = _sent(built, blocks[0] if blocks else None, window)
        return keep_rows(docs, text_col, lambda texts: [
            not _load(automaton.value, name).hits(words((t or "").encode()))[0] for t in texts])
    d = documents_of(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    found = _found(d, built, blocks, window).select(F.col("doc_id").alias("f_id"), F.col("text_hash").alias("f_hash"))
    plain, names = positional(docs)
    doc_id, text = F.col(place(names, id_col)).cast("long"), F.col(place(names, text_col)).cast("string")
    return plain.join(found, same(doc_id, F.col("f_id")) & same(F.xxhash64(text), F.col("f_hash")),
                      "left_anti").toDF(*names)

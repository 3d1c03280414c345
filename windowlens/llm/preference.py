"""Preference formatting of chosen and rejected conversations.

The longest common turn prefix of a pair (same role and text, turn by turn)
is rendered once as the prompt; the remaining turns of each side are its
completion.  Completions are tokenised turn by turn with a mask: 1 for the
text and end mark of assistant turns, 0 for headers and other roles.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from windowlens.llm.common import ByteCache, ship, take
from windowlens.llm.packing import byte_letters

HEADER, END = "<|{0}|>\n", "<|end|>\n"
SCORED = "assistant"


def conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> DataFrame:
    """(conv_id, turns): the turns of a conversation in order, ties by role
    and text; rows that repeat a turn exactly count once (combined in the
    tasks, before the one shuffle), null roles and texts are empty, rows
    without an id belong to no conversation.  A conversation is one row,
    however long its texts are or however many turns it has."""
    t = take(turns, conv_id=id_col, turn=turn_col, role=role_col, text=text_col).where("conv_id is not null")
    t = t.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                 F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                 F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return (t.groupBy("conv_id").agg(F.sort_array(F.collect_set(F.struct("turn", "role", "text"))).alias("turns"))
            .select("conv_id", F.transform("turns", lambda x: F.struct(
                x["role"].alias("role"), x["text"].alias("text"))).alias("turns")))


def donors(convs: DataFrame, parts: int = 256) -> DataFrame:
    """(conv_id, donor): the next conversation with an assistant turn in a
    hashed order, for every conversation with one.

    The order is cut into ``parts`` parts by a hash, so no task sees all
    conversations; the last of a part takes the first of the next part (a
    table of one row a part, sent to the tasks).  Only ids are moved.
    """
    ids = (convs.where(_last_scored().isNotNull()).select("conv_id", F.xxhash64("conv_id").alias("h"))
           .withColumn("part", F.pmod(F.col("h"), F.lit(parts))))
    heads = ids.groupBy("part").agg(F.min(F.struct("h", "conv_id"))["conv_id"].alias("head"))
    order = Window.orderBy("part")                      # at most ``parts`` rows
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("part", F.coalesce(F.lead("head").over(order), F.first("head").over(whole)).alias("next"))
    inside = Window.partitionBy("part").orderBy("h", "conv_id")
    # a left join: Catalyst infers no filter from it, so all uses of the grouped turns share one shuffle
    return (ids.withColumn("donor", F.lead("conv_id").over(inside)).join(F.broadcast(heads), "part", "left")
            .select("conv_id", F.coalesce("donor", "next").alias("donor")))


def _last_scored() -> Column:
    """Position of the last assistant turn; null if there is none."""
    return F.array_max(F.filter(F.transform("turns", lambda x, i: F.when(x["role"] == SCORED, i)),
                                lambda i: i.isNotNull()))


def replaced_answers(convs: DataFrame, parts: int = 256) -> DataFrame:
    """Pairs (pair_id, chosen, rejected) from whole conversations: rejected
    is the conversation with its last assistant text replaced by that of
    another conversation, the next one in a hashed order (:func:`donors`).

    One answer a conversation is moved to the one that takes it; the
    conversations themselves stay where their grouping put them.  A
    conversation without an assistant turn, or the only one with such a turn,
    is paired with itself.
    """
    c = convs.withColumn("at", _last_scored())
    given = (c.where("at is not null").select(F.col("conv_id").alias("donor"),
                                              F.col("turns")[F.col("at")]["text"].alias("answer"))
             .join(donors(convs, parts), "donor").select("conv_id", "answer"))
    return c.join(given, "conv_id", "left").select(
        F.col("conv_id").alias("pair_id"), F.col("turns").alias("chosen"),
        F.when(F.col("at").isNull() | F.col("answer").isNull(), F.col("turns")).otherwise(
            F.transform("turns", lambda x, i: F.when(i == F.col("at"), F.struct(
                x["role"].alias("role"), F.col("answer").alias("text"))).otherwise(x))).alias("rejected"))


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two turn arrays."""
    n = F.least(F.size(a), F.size(b))
    differs = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                       lambda i: (i > n) | (F.get(a, i - 1) != F.get(b, i - 1)))
    return F.coalesce(F.get(differs, F.lit(0)) - 1, n)


#: Bytes of remembered chunks a Python worker holds, and of pieces of words.
CHUNK_BYTES = 96 << 20
WORD_BYTES = 32 << 20

_PIECE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÿ]*\Z")


class ByteLevelTokenizer:
    """Ids of a byte-level ``tokenizers`` file, marks inside a text being
    ordinary text.  A piece takes at most one blank before it, so a text can
    be cut before every single blank between two characters that are not
    blank; the ids of such chunks are remembered, up to a number of bytes.
    Chunks of ASCII and Latin letters take the vocabulary's own pattern and
    merges; every other chunk, and a text with other blanks that is not of
    those letters, goes through the whole tokenizer.  Ids equal those of the
    whole text."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.merge = self.tokenizer.model.tokenize
        self.pieces = regex.compile(_PIECE)
        self.letters = byte_letters()
        self.chunks = ByteCache(CHUNK_BYTES)
        self.words = ByteCache(WORD_BYTES)

    def _word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            ids = array("i", [t.id for t in self.merge("".join([self.letters[b] for b in word.encode()]))]).tobytes()
            self.words.put(word, ids)
        return ids

    def _run(self, text: str) -> bytes:
        if _PLAIN.match(text):
            return b"".join([self._word(w) for w in self.pieces.findall(text)])
        return array("i", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        """The ids of a chunk and the blank before it."""
        ids = self._run(" " + chunk)
        self.chunks.put(chunk, ids)
        return ids

    def __call__(self, text: str) -> bytes:
        """Signed 32-bit ids."""
        first, *inner = text.split(" ")
        if not inner:
            return self._run(text)
        last = inner.pop()
        known = self.chunks.get
        ids = [known(c) for c in inner]
        if first != first.rstrip() or not last or last != last.lstrip() or not all(
                c and c == c.strip() for c, found in zip(inner, ids) if found is None):
            return self._run(text)               # blanks that meet: no cut there
        ids = [found or self._chunk(c) for c, found in zip(inner, ids)]
        return b"".join([self._run(first), *ids, self._run(" " + last)])


_TOKENIZERS: dict[str, ByteLevelTokenizer] = {}


def _tokenizer(path: str) -> ByteLevelTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = ByteLevelTokenizer(path)
    return _TOKENIZERS[path]


_SIDES = ("chosen", "rejected")
_DDL = ("pair_id long, n_common int, prompt string, chosen string, rejected string, prompt_ids array<int>, "
        "chosen_ids array<int>, chosen_mask array<int>, rejected_ids array<int>, rejected_mask array<int>, "
        "usable boolean")
_INTS = pa.list_(pa.int32())
_SCHEMA = pa.schema([("pair_id", pa.int64()), ("n_common", pa.int32()), ("prompt", pa.string()),
                     ("chosen", pa.string()), ("rejected", pa.string()), ("prompt_ids", _INTS),
                     ("chosen_ids", _INTS), ("chosen_mask", _INTS), ("rejected_ids", _INTS),
                     ("rejected_mask", _INTS), ("usable", pa.bool_())])


def _lists(rows: list[bytes]) -> pa.Array:
    """int32 lists from their bytes."""
    offsets = np.concatenate(([0], np.cumsum([len(r) // 4 for r in rows], dtype=np.int64))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), np.int32)))


def _tokenise(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(path)
        ones, zeros = np.int32(1).tobytes(), np.int32(0).tobytes()

        def turn(t: dict, seen: dict) -> tuple[str, bytes, bytes]:
            """Text, ids and mask of a turn, once a pair."""
            key = t["role"], t["text"]
            if key not in seen:
                head, body = HEADER.format(t["role"]), t["text"] + END
                head_ids, body_ids = encode(head), encode(body)
                mark = ones if t["role"] == SCORED else zeros
                seen[key] = (head + body, head_ids + body_ids,
                             zeros * (len(head_ids) // 4) + mark * (len(body_ids) // 4))
            return seen[key]

        for b in batches:
            cols: dict[str, list] = {f.name: [] for f in _SCHEMA}
            for row in b.select(["common", "chosen_turns", "rejected_turns"]).to_pylist():
                seen: dict = {}
                shown = {}
                for name, turns in row.items():
                    parts = [turn(t, seen) for t in turns]
                    shown[name] = "".join([p[0] for p in parts]), *(b"".join([p[i] for p in parts]) for i in (1, 2))
                cols["prompt"].append(shown["common"][0])
                cols["prompt_ids"].append(shown["common"][1])
                for side in _SIDES:
                    for name, value in zip((side, f"{side}_ids", f"{side}_mask"), shown[f"{side}_turns"]):
                        cols[name].append(value)
                cols["usable"].append(all(any(t["role"] == SCORED for t in row[f"{side}_turns"]) for side in _SIDES))
            yield pa.RecordBatch.from_arrays(
                [b[f.name] if f.name in ("pair_id", "n_common") else
                 _lists(cols[f.name]) if f.type == _INTS else pa.array(cols[f.name], f.type) for f in _SCHEMA],
                schema=_SCHEMA)

    return run


def format_pairs(pairs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``pairs`` (pair_id, chosen, rejected: arrays of (role, text)) -> one
    row per pair: (pair_id, n_common, prompt, chosen, rejected, prompt_ids,
    chosen_ids, chosen_mask, rejected_ids, rejected_mask, usable).

    Rendered, prompt + chosen is the chosen conversation, and so for
    rejected; ids likewise.  A null side is an empty conversation; equal
    sides give empty completions; ``usable`` says that both completions have
    a scored token.  Very long conversations and texts are formatted whole;
    a turn that both sides hold is tokenised once.  Rows that repeat are each returned, an empty table gives
    an empty result, other columns are ignored whatever their names.
    """
    ship(pairs.sparkSession)
    empty = F.array().cast("array<struct<role:string,text:string>>")
    p = take(pairs, pair_id="pair_id", chosen_all="chosen", rejected_all="rejected").select(
        F.col("pair_id").cast("long").alias("pair_id"), F.coalesce("chosen_all", empty).alias("a"),
        F.coalesce("rejected_all", empty).alias("b"))
    p = p.withColumn("n_common", common_turns(F.col("a"), F.col("b")))
    p = p.select("pair_id", "n_common", F.slice("a", F.lit(1), F.col("n_common")).alias("common"),
                 *[F.slice(x, F.col("n_common") + 1, F.size(x)).alias(f"{side}_turns")
                   for x, side in zip("ab", _SIDES)])
    return p.mapInArrow(_tokenise(tokenizer_path), _DDL)

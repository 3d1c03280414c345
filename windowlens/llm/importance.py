"""Target-distribution importance resampling with bit-sliced aggregation.

Texts are bags of hashed word runs.  A bucket's *gain* is the scaled log
ratio of its shares in a target table and in the documents, a document's
weight the sum of the gains of its features, and the draw takes the highest
weights with Gumbel noise.

1. *Counts.*  Each task adds up one counter a bucket and emits them once;
   Spark sums them.  Documents and target are counted whole.
2. *Gain planes.*  The gains, integers in two's complement, become one bit
   plane a binary digit: bit ``b`` of plane ``j`` is digit ``j`` of the gain
   of bucket ``b``.  The last plane is the sign and counts ``-2**j``.
3. *Bit-sliced sums.*  A document's bucket counts become planes likewise.
   The weight is the sum over plane pairs of ``2**(i + j)`` times the number
   of bits that count plane ``i`` and gain plane ``j`` share: ANDs,
   popcounts and powers of two, so it is an exact integer.
4. *Draw.*  Documents are dealt out by ranges of (score, id, row), numbered
   inside their range, and ranks are the numbers plus the sizes of the ranges
   before; no task sorts everything.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from windowlens.llm.common import byte_values, documents_of, shuffle_partitions, staged
from windowlens.llm.decontaminate import words

BUCKETS = 10_000
SCALE = 1000          # gains are floors of SCALE * log ratio

_COUNTS = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])
_WEIGHTS = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_words", pa.int64()),
                      ("n_features", pa.int64()), ("weight", pa.int64())])


# --- features ----------------------------------------------------------------

def features(found: list[bytes], max_run: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of all runs of 1 to ``max_run`` words, repeats included."""
    crc = zlib.crc32
    out = [crc(w) for w in found]
    for n in range(2, max_run + 1):
        out += [crc(b" ".join(found[i:i + n])) for i in range(len(found) - n + 1)]
    return np.array(out, dtype=np.int64) % buckets


def bucket_counts(docs: DataFrame, max_run: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts; buckets without one have no row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for text in byte_values(b["text"]):
                found = words(text)
                if found:
                    total += np.bincount(features(found, max_run, buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], schema=_COUNTS)

    return docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of every bucket from the counts of documents and target."""
    size = float(len(raw))
    all_raw, all_target = float(raw.sum()) + size, float(target.sum()) + size
    return np.array([math.floor(SCALE * math.log((t + 1.0) * all_raw / ((s + 1.0) * all_target)))
                     for s, t in zip(raw.tolist(), target.tolist())], dtype=np.int64)


# --- bit planes --------------------------------------------------------------

def planes(values: np.ndarray, at: np.ndarray, digits: int, buckets: int) -> np.ndarray:
    """(digits, words) bit planes: bit ``at[x]`` of plane ``j`` is binary
    digit ``j`` of ``values[x]`` (two's complement for negative values)."""
    bits = np.zeros((digits, -(-buckets // 64) * 64), np.uint8)
    bits[:, at] = (values >> np.arange(digits)[:, None]) & 1
    return np.packbits(bits, axis=1).view(np.uint64)


class GainPlanes:
    """The gains as signed bit planes; ``weight`` sums them over a document."""

    def __init__(self, gain: np.ndarray):
        self.buckets = len(gain)
        self.digits = int(np.abs(gain).max(initial=0)).bit_length() + 1
        self.planes = planes(gain, np.arange(self.buckets), self.digits, self.buckets)
        self.powers = [1 << j for j in range(self.digits - 1)] + [-(1 << (self.digits - 1))]

    def weight(self, found: np.ndarray) -> int:
        """Exact sum of the gains of a document's buckets."""
        if not len(found):
            return 0
        at, n = np.unique(found, return_counts=True)
        count = planes(n, at, int(n.max()).bit_length(), self.buckets)
        shared = np.bitwise_count(count[:, None, :] & self.planes[None, :, :]).sum(axis=2, dtype=np.int64)
        return sum((1 << i) * power * int(x) for i, row in enumerate(shared) for power, x in zip(self.powers, row))


# --- operator ----------------------------------------------------------------

def weigh(docs: DataFrame, gain: np.ndarray, max_run: int = 1) -> DataFrame:
    """(doc_id, text_hash, n_words, n_features, weight) of (doc_id, text)."""
    sent = docs.sparkSession.sparkContext.broadcast(GainPlanes(gain))   # digits * buckets bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for b in batches:
            n_words, n_features, weights = [], [], []
            for text in byte_values(b["text"]):
                own = words(text)
                found = features(own, max_run, table.buckets)
                n_words.append(len(own))
                n_features.append(len(found))
                weights.append(table.weight(found))
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["text_hash"], *(pa.array(x, pa.int64()) for x in (n_words, n_features, weights))],
                schema=_WEIGHTS)

    return (docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
            .mapInArrow(run, "doc_id long, text_hash long, n_words long, n_features long, weight long"))


def ranked(rows: DataFrame, k: int, name: str = "rank") -> DataFrame:
    """``rows`` with their place 1..k by (score downwards, doc_id, text_hash,
    row), null beyond ``k``."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), "text_hash", "row"]
    dealt = (rows.repartitionByRange(shuffle_partitions(rows), *order).sortWithinPartitions(*order)
             .withColumn("_at", F.monotonically_increasing_id()))    # partition, then row within it
    dealt = staged(dealt.withColumns({"_part": F.shiftright("_at", 33), "_nth": F.col("_at").bitwiseAND((1 << 33) - 1)})
                   .drop("_at"), "importance-ranges")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)      # one row a range
    offsets = (dealt.groupBy("_part").agg(F.count("*").alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    place = F.col("_before") + F.col("_nth") + 1
    return (dealt.join(offsets, "_part").withColumn(name, F.when(place <= k, place))
            .drop("_part", "_nth", "_before"))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, max_run: int = 1,
             buckets: int = BUCKETS, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text",
             target_id: str = "item_id", target_text: str = "text") -> DataFrame:
    """One row per document: (doc_id, text_hash, n_words, n_features, weight,
    score, rank).

    ``weight`` is the sum of gains of the document's features, ``score`` adds
    Gumbel noise drawn from the SHA-256 of ``seed:doc_id``.  Of the documents
    with at least ``min_words`` words, the highest ``percent`` percent
    (rounded down) get ranks from 1; ties go to the smaller doc_id, then text
    hash; all others have a null rank.

    Null, empty and blank texts have no features and weight 0; very long
    texts are counted whole, and one text's counts take ``buckets`` numbers;
    rows that repeat are all returned and drawn singly; a null doc_id draws
    as the empty string and comes last among ties; an empty target gives
    gains from the raw counts alone; an empty table gives an empty result;
    other columns are ignored whatever their names.
    """
    d = documents_of(docs, id_col, text_col)
    raw, wanted = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for counts, texts in ((raw, d), (wanted, documents_of(target, target_id, target_text))):
        for r in bucket_counts(texts, max_run, buckets).collect():    # one row a bucket at most
            counts[r["bucket"]] = r["n"]
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
                                  .cast("binary"), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    rows = staged(weigh(d, gains(raw, wanted), max_run).withColumns(
        {"score": F.col("weight") + noise, "row": F.monotonically_increasing_id()}), "importance-weights")
    enough = rows.where(F.col("n_words") >= min_words)
    k = percent * enough.count() // 100
    rest = rows.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked(enough, k).unionByName(rest).drop("row")

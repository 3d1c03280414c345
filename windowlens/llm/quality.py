"""Quality selection by importance resampling.

Two generative models count hashed word unigrams and bigrams: the raw model
over all documents, the target model over labelled good ones.  A document's
log weight is the sum over its n-grams of ``log p_target - log p_raw``; with
Gumbel noise added, the ``k`` largest keys are a sample without replacement
in proportion to the weights (Gumbel top-k).

1. *Counts.*  Each task adds up two arrays of ``2**bucket_bits`` counters and
   emits them once; Spark sums them.  The raw counts cover every document.
   The target model is fitted on at most about ``target_docs`` good labelled
   documents, chosen by a hash; only their ids are sent to the tasks.
2. *Weights.*  A second pass scores all documents against the log ratios
   (``2**bucket_bits`` numbers, sent to the tasks).
3. *Top k.*  Quantile cuts narrow the range of the k-th key until at most
   ``RANKED`` rows are left, which are ranked; no sort of everything.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windowlens.llm.common import byte_values, documents_of, staged, take
from windowlens.llm.decontaminate import words

BUCKET_BITS = 16
TARGET_DOCS = 20_000
PRIOR = 1.0           # n-grams a bucket of the raw model mixed into the target model
RANKED = 1_000_000    # rows ranked in one piece


def buckets(text: bytes, bits: int = BUCKET_BITS) -> np.ndarray:
    """Buckets of the unigrams and bigrams of a text."""
    h = np.array([zlib.crc32(w) for w in words(text)], dtype=np.uint64)
    pairs = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
    mixed = np.concatenate((h, pairs)) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


_COUNTS = pa.schema([("bucket", pa.int32()), ("raw", pa.int64()), ("target", pa.int64())])


def count_models(docs: DataFrame, target_ids: set[int], bits: int = BUCKET_BITS) -> DataFrame:
    """(bucket, raw, target): n-gram counts of all and of the target
    documents."""
    sent = docs.sparkSession.sparkContext.broadcast(target_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = sent.value
        total = np.zeros((2, 1 << bits), np.int64)
        for b in batches:
            for doc_id, text in zip(b["doc_id"].to_pylist(), byte_values(b["text"])):
                found = buckets(text, bits)
                np.add.at(total[0], found, 1)
                if doc_id in chosen:
                    np.add.at(total[1], found, 1)
        used = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[0, used]),
                                          pa.array(total[1, used])], schema=_COUNTS)

    return (docs.select("doc_id", "text").mapInArrow(run, "bucket int, raw long, target long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))


class Ratios:
    """``log p_target - log p_raw`` of buckets.

    The target counts are a sample, so their logs are too low by about half
    their relative variance on average; that is added back, or long texts
    would lose by length alone.  Documents of the target sample are scored
    without their own counts.
    """

    def __init__(self, rows, bits: int, target_ids: set[int]):
        self.bits, self.target_ids = bits, target_ids
        raw, self.target = np.zeros(1 << bits), np.zeros(1 << bits)
        for r in rows:
            raw[r["bucket"]], self.target[r["bucket"]] = r["raw"], r["target"]
        self.p_raw = (raw + 0.5) / (raw.sum() + 0.5 * len(raw))
        self.total = self.target.sum()
        self.table = self._mix(self.target, self.p_raw, self.total, PRIOR * len(raw))

    @staticmethod
    def _mix(target, p_raw, total, mixed):
        smoothed = target + mixed * p_raw
        return np.log(smoothed / (total + mixed)) - np.log(p_raw) + 0.5 * target / (smoothed * smoothed)

    def weight(self, doc_id: int | None, found: np.ndarray) -> float:
        """Log weight of a document."""
        if not self.total:
            return 0.0
        if doc_id not in self.target_ids:
            return float(self.table[found].sum())
        own, n = np.unique(found, return_counts=True)
        rest = np.maximum(self.target[own] - n, 0)
        logs = self._mix(rest, self.p_raw[own], self.total - len(found), PRIOR * len(self.p_raw))
        return float((n * logs).sum())


def weigh(docs: DataFrame, ratios: Ratios) -> DataFrame:
    """(doc_id, text_hash, n_ngrams, log_weight)."""
    sent = docs.sparkSession.sparkContext.broadcast(ratios)
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_ngrams", pa.int64()),
                        ("log_weight", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = sent.value
        for b in batches:
            n, weights = [], []
            for doc_id, text in zip(b["doc_id"].to_pylist(), byte_values(b["text"])):
                found = buckets(text, r.bits)
                n.append(len(found))
                weights.append(r.weight(doc_id, found))
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["text_hash"], pa.array(n, pa.int64()),
                                              pa.array(weights, pa.float64())], schema=schema)

    return docs.select("doc_id", "text_hash", "text").mapInArrow(
        run, "doc_id long, text_hash long, n_ngrams long, log_weight double")


def top_k(rows: DataFrame, key: str, k: int, tie: str, ranked: int = RANKED) -> DataFrame:
    """``rows`` with ``kept``: true for the ``k`` rows with the largest
    ``key`` (ties go to the smaller ``tie``, a unique column)."""
    n = rows.count()
    if k <= 0 or k >= n:
        return rows.withColumn("kept", F.lit(k > 0))
    inside, above = rows, 0           # rows that may hold the k-th key; rows over all of them
    while n > ranked:
        cuts = sorted(set(inside.agg(F.percentile_approx(key, [i / 256 for i in range(1, 256)], 100_000)
                                     .alias("c")).first()["c"]))
        part = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col(key)))
        sizes = {r["p"]: r["n"] for r in inside.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
        for p in sorted(sizes, reverse=True):
            if above + sizes[p] >= k:
                break
            above += sizes[p]
        if sizes[p] == n:             # nearly all keys equal the largest: rank those by the tie, or go below
            at = inside.agg(F.max(key).alias("m")).first()["m"]
            equal = inside.where(F.col(key) == at).count()
            if above + equal >= k:
                inside, n = inside.where(F.col(key) == at), equal
                break
            inside, above, n = inside.where(F.col(key) < at), above + equal, n - equal
            continue
        n = sizes[p]
        low, high = (cuts[p - 1] if p else None), (cuts[p] if p < len(cuts) else None)
        if low is not None:
            inside = inside.where(F.col(key) > low)
        if high is not None:
            inside = inside.where(F.col(key) <= high)
    if n > ranked:
        bound = inside.approxQuantile(tie, [(k - above - 0.5) / n], 0.0)[0]    # rank: the product rounded up
    else:
        last = inside.orderBy(F.desc(key), tie).limit(k - above).orderBy(key, F.desc(tie)).first()
        at, bound = last[key], last[tie]
    return rows.withColumn("kept", (F.col(key) > at) | ((F.col(key) == at) & (F.col(tie) <= bound)))


def resample(docs: DataFrame, labels: DataFrame, fraction: float | None = None, target_docs: int = TARGET_DOCS,
             bits: int = BUCKET_BITS, seed: int = 0, id_col: str = "doc_id", text_col: str = "text",
             quality_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """One row per document: (doc_id, text_hash, n_ngrams, log_weight,
    gumbel_key, kept).

    Good documents are those labelled quality 1 and not toxic.  ``fraction``
    of all documents are kept; by default the share of good ones among the
    labelled.

    Null and empty texts have weight 0 in the log and are drawn like others;
    labels that are null, or of unknown documents, teach nothing; without a
    good label all weights are 0 and the draw is uniform (without any label
    everything is kept); rows that repeat draw the same noise and ties go by
    row; an empty table gives an empty result; other columns are ignored
    whatever their names.
    """
    marks = take(labels, doc_id=id_col, quality=quality_col, toxic=toxic_col).where("doc_id is not null")
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    seen = marks.where("quality is not null").agg(
        F.count("*").alias("n"), F.sum(good.cast("long")).alias("good")).first()
    if fraction is None:
        fraction = seen["good"] / seen["n"] if seen["n"] else 1.0
    drawn = (marks.where(good).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
             .orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(target_docs))
    ids = {r["doc_id"] for r in drawn.collect()}
    d = documents_of(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    ratios = Ratios(count_models(d, ids, bits).collect(), bits, ids)
    draw = (F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(seed + 1)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    rows = staged(weigh(d, ratios).withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(draw)))
                  .withColumn("row", F.monotonically_increasing_id()), "quality-weights")
    n = rows.count()
    return top_k(rows, "gumbel_key", round(fraction * n), "row").drop("row")

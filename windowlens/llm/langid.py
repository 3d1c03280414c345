"""Language identification with a linear-chain conditional random field.

The words of a text are one sequence; every word gets a label (a language)
by forward-backward, so code-switched texts are labelled word by word, and
the language of a text is the label with the largest sum of word marginals.

* Emissions: hashed character bigrams and trigrams of the word with its
  borders, prefixes and suffixes of two to four bytes, and membership in the
  word lists (lexicons) of the languages.
* Transitions: learned, one weight for each ordered pair of labels.
* Lexicons: the most frequent words of each language, counted over *all*
  training documents (partial counts per task, then a Spark aggregate).
* Training: maximum likelihood by Adam, in one task, on a sample of at most
  ``train_docs`` whole documents and ``train_chars`` characters a language:
  the first ones by a hash of id and text, rows that repeat counting once.
  Half of the sequences are single documents, half alternate stretches of
  two documents, so that transitions see switches.

Prediction keeps the scores of words it has seen (``CACHE`` words or
``CACHE_BYTES`` a worker).
Long texts are cut into segments whose transfer matrices are multiplied, so
the recursion is exact over whole texts and vectorised over segments.
"""

from __future__ import annotations

import io
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from windowlens.llm.common import batches_of, documents_of, keep_rows, place, positional, ship, staged

BUCKET_BITS = 15
TRAIN_DOCS = 300       # documents a language that the weights are fitted on at most
TRAIN_CHARS = 4_000_000   # characters of them
LEXICON_SIZE = 2000    # words a language
MIN_COUNT = 5          # occurrences of a word in a lexicon at least
ROUNDS = 40
SEGMENT = 64
CACHE = 200_000        # words whose scores a worker keeps
CACHE_BYTES = 32 << 20    # bytes of those words (text without blanks is one word)
SCAN_WORDS = 200_000   # words labelled at a time
COUNTED = 250_000      # words a task counts before it passes the counts on
COUNTED_CHARS = 64 << 20  # characters of the texts it has counted by then at most
UNKNOWN = "und"

#: Letters a-z and bytes outside ASCII make words.
_LETTER_BYTES = bytes(c if 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def words(text: str) -> list[bytes]:
    """Lower-cased words of a text; none if it has no letter."""
    raw = (text if text.isascii() else text.lower()).encode()
    found = raw.translate(_LETTER_BYTES).split()
    if found and all(w[0] >= 128 for w in found) and not any(map(str.isalpha, text)):
        return []
    return found


# --- features ----------------------------------------------------------------

def features(vocabulary: list[bytes], lexicon: dict[bytes, tuple[int, ...]]) -> tuple[np.ndarray, np.ndarray]:
    """(word, feature) index pairs.  Features below ``2**BUCKET_BITS`` are
    hashed n-grams and affixes; the ones after are the lexicons."""
    chars = np.frombuffer(b"^" + b"$^".join(vocabulary) + b"$", np.uint8).astype(np.uint64)
    size = np.fromiter(map(len, vocabulary), np.int64, len(vocabulary)) + 2
    end = np.cumsum(size)
    start = end - size
    owner = np.repeat(np.arange(len(vocabulary)), size)
    left = end[owner] - np.arange(len(chars))        # characters from here to the border
    pairs = []

    def add(kind: int, who: np.ndarray, at: np.ndarray, width: int) -> None:
        code = np.full(len(at), kind, dtype=np.uint64)
        for i in range(width):
            code = code * np.uint64(257) + chars[at + i]
        hashed = (code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKET_BITS)
        pairs.append((who, hashed.astype(np.int64)))

    for width in (2, 3):
        at = np.flatnonzero(left >= width)
        add(width, owner[at], at, width)
    for width in (2, 3, 4):
        who = np.flatnonzero(size >= width + 2)
        add(10 + width, who, start[who] + 1, width)
        add(20 + width, who, end[who] - 1 - width, width)
    listed = [(i, k) for i, w in enumerate(vocabulary) for k in lexicon.get(w, ())]
    if listed:
        who, which = np.array(listed, dtype=np.int64).T
        pairs.append((who, which + (1 << BUCKET_BITS)))
    return tuple(np.concatenate(x) for x in zip(*pairs))


def emissions(vocabulary, lexicon, weights) -> np.ndarray:
    who, which = features(vocabulary, lexicon)
    return np.stack([np.bincount(who, weights[which, k], len(vocabulary)) for k in range(weights.shape[1])],
                    axis=1).astype(np.float32)


# --- forward-backward --------------------------------------------------------

def forward_backward(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray,
                     pairs: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Word marginals (n, K) of sequences laid end to end (all lengths over
    0), and the expected number of transitions (K, K) if ``pairs``."""
    k = scores.shape[1]
    step = np.exp(transitions - transitions.max()).astype(np.float32)
    psi = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float32) + np.float32(1e-12)
    per = -(-lengths // SEGMENT)
    n_seg = int(per.sum())
    first = np.cumsum(per) - per                                  # first segment of each sequence
    within = np.arange(n_seg) - np.repeat(first, per)
    seg_len = np.minimum(SEGMENT, np.repeat(lengths, per) - within * SEGMENT)
    real = np.arange(SEGMENT) < seg_len[:, None]
    p = np.ones((n_seg, SEGMENT, k), np.float32)
    p[real] = psi

    forward = np.full((n_seg, k), 1 / k, np.float32)
    backward = np.ones((n_seg, k), np.float32)
    many = np.flatnonzero(np.repeat(per, per) > 1)
    if len(many):
        transfer = np.zeros((n_seg, k, k), np.float32)
        m, pm, rm = np.broadcast_to(np.eye(k, dtype=np.float32), (len(many), k, k)), p[many], real[many]
        for t in range(SEGMENT):
            new = (m.reshape(-1, k) @ step).reshape(-1, k, k) * pm[:, t, None, :]
            new /= new.sum(axis=(1, 2), keepdims=True)
            m = np.where(rm[:, t, None, None], new, m)
        transfer[many] = m
        for j in range(1, int(per.max())):
            at = first[per > j] + j
            v = np.einsum("ni,nij->nj", forward[at - 1], transfer[at - 1])
            forward[at] = v / v.sum(axis=1, keepdims=True)
        for j in range(int(per.max()) - 1, 0, -1):
            at = first[per > j] + j
            v = np.einsum("nij,nj->ni", transfer[at], backward[at])
            backward[at - 1] = v / v.sum(axis=1, keepdims=True)

    alpha = np.empty_like(p)
    a = forward
    for t in range(SEGMENT):
        a = (a @ step) * p[:, t]
        a /= a.sum(axis=1, keepdims=True)
        alpha[:, t] = a
    expected = np.zeros((k, k))
    b = backward
    for t in range(SEGMENT - 1, -1, -1):
        after = p[:, t] * b
        if pairs:
            before = alpha[:, t - 1] if t else forward
            joint = before[:, :, None] * step * after[:, None, :]
            joint /= joint.sum(axis=(1, 2), keepdims=True)
            counted = real[:, t] & ((within > 0) | (t > 0))
            expected += joint[counted].sum(axis=0)
        g = alpha[:, t] * b
        alpha[:, t] = g / g.sum(axis=1, keepdims=True)
        new = after @ step.T
        b = np.where(real[:, t, None], new / new.sum(axis=1, keepdims=True), b)
    return alpha[real], expected


# --- model -------------------------------------------------------------------

class Model:
    """Labels, lexicon, emission weights and transitions."""

    def __init__(self, labels: list[str], lexicon: dict[bytes, tuple[int, ...]], weights: np.ndarray,
                 transitions: np.ndarray):
        self.labels, self.lexicon, self.weights, self.transitions = labels, lexicon, weights, transitions
        self._forget()

    def _forget(self) -> None:
        self._row: dict[bytes, int] = {}
        self._held = 0
        self._scores = np.empty((1024, max(1, len(self.labels))), np.float32)

    def __getstate__(self):
        return self.labels, self.lexicon, self.weights, self.transitions

    def __setstate__(self, state):
        self.__init__(*state)

    def word_scores(self, text_words: list[bytes]) -> np.ndarray:
        if len(self._row) > CACHE or self._held > CACHE_BYTES:
            self._forget()
        row = self._row
        new = [w for w in dict.fromkeys(text_words) if w not in row]
        if new:
            at = len(row)
            while at + len(new) > len(self._scores):
                self._scores = np.concatenate((self._scores, np.empty_like(self._scores)))
            self._scores[at:at + len(new)] = emissions(new, self.lexicon, self.weights)
            row.update(zip(new, range(at, at + len(new))))
            self._held += sum(map(len, new))
        return self._scores[np.fromiter(map(row.__getitem__, text_words), np.int64, len(text_words))]

    def label_words(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """Word marginals of every text."""
        out: list[np.ndarray] = [np.empty((0, len(self.labels)), np.float32)] * len(texts)
        full = [i for i, t in enumerate(texts) if t]
        if full:
            lengths = np.array([len(texts[i]) for i in full])
            scores = self.word_scores([w for i in full for w in texts[i]])
            marginals, _ = forward_backward(scores, lengths, self.transitions)
            for i, part in zip(full, np.split(marginals, np.cumsum(lengths)[:-1])):
                out[i] = part
        return out


def fit(sequences: list[list[tuple[bytes, int]]], k: int, lexicon: dict[bytes, tuple[int, ...]],
        rounds: int = ROUNDS, rate: float = 0.15, l2: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood by Adam: (weights, transitions)."""
    flat = [x for s in sequences for x in s]
    lengths = np.array([len(s) for s in sequences])
    gold = np.array([y for _, y in flat])
    vocabulary = list(dict.fromkeys(w for w, _ in flat))
    index = dict(zip(vocabulary, range(len(vocabulary))))
    at = np.array([index[w] for w, _ in flat])
    who, which = features(vocabulary, lexicon)
    inner = np.ones(len(flat), bool)
    inner[np.cumsum(lengths) - lengths] = False
    seen = np.zeros((k, k))
    np.add.at(seen, (gold[:-1][inner[1:]], gold[1:][inner[1:]]), 1)
    theta = [np.zeros(((1 << BUCKET_BITS) + k, k)), np.zeros((k, k))]
    moments = [(np.zeros_like(x), np.zeros_like(x)) for x in theta]
    for r in range(1, rounds + 1):
        weights, transitions = theta
        by_word = np.stack([np.bincount(who, weights[which, j], len(vocabulary)) for j in range(k)], axis=1)
        marginals, expected = forward_backward(by_word[at], lengths, transitions, pairs=True)
        grad = -marginals.astype(np.float64)
        grad[np.arange(len(gold)), gold] += 1
        word_grad = np.stack([np.bincount(at, grad[:, j], len(vocabulary)) for j in range(k)], axis=1)
        grads = [np.stack([np.bincount(which, word_grad[who, j], len(weights)) for j in range(k)], axis=1) / len(flat)
                 - l2 * weights, (seen - expected) / len(flat) - l2 * transitions]
        for x, g, (m, v) in zip(theta, grads, moments):
            m += 0.1 * (g - m)
            v += 0.05 * (g * g - v)
            x += rate * (m / (1 - 0.9 ** r)) / (np.sqrt(v / (1 - 0.95 ** r)) + 1e-8)
    return theta[0].astype(np.float32), theta[1].astype(np.float32)


def training_sequences(docs: list[tuple[str, int]]) -> list[list[tuple[bytes, int]]]:
    """Single documents and, from every second pair, alternating stretches of
    two documents."""
    labelled = [[(w, y) for w in words(t)] for t, y in docs]
    labelled = [s for s in labelled if s]
    rng = np.random.default_rng(0)
    out = []
    for i in range(0, len(labelled), 4):
        out += labelled[i:i + 2]
        rest = labelled[i + 2:i + 4]
        if len(rest) < 2:
            out += rest
            continue
        mixed, at = [], [0, 0]
        while at[0] < len(rest[0]) or at[1] < len(rest[1]):
            for j in (0, 1):
                n = int(rng.integers(3, 30))
                mixed += rest[j][at[j]:at[j] + n]
                at[j] += n
        out.append(mixed)
    return out


# --- training with Spark -----------------------------------------------------

_COUNTS = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts per language of a task, in tables of bounded size."""
    def rows():
        table: dict[str, Counter] = {}
        held = 0
        for b in batches:
            for lang, text in zip(b["lang"].to_pylist(), b["text"].to_pylist()):
                table.setdefault(lang, Counter()).update(words(text))
                held += len(text)
                if held > COUNTED_CHARS:
                    yield from emit(table)
                    table, held = {}, 0
            if sum(map(len, table.values())) > COUNTED:
                yield from emit(table)
                table, held = {}, 0
        yield from emit(table)

    def emit(table):
        for lang, counter in table.items():
            for word, n in counter.items():
                yield lang, word, n

    return batches_of(_COUNTS, rows(), 50_000)


def training_sample(labelled: DataFrame, sizes: dict[str, int], train_docs: int, train_chars: int) -> DataFrame:
    """(lang, text, o): at most ``train_docs`` whole documents and
    ``train_chars`` characters a language, the first by a hash ``o``.

    A hash draws about twice the documents needed, repeated rows become one,
    and the first of the rest stay; only drawn texts are moved.
    """
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, 2 * train_docs / n))])
    drawn = (labelled.select("lang", "text", F.xxhash64("doc_id", "text").alias("o"))
             .where((F.length("text") <= train_chars)
                    & (F.pmod(F.xxhash64("o", F.lit(4)), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30)))
             .groupBy("lang", "o").agg(F.min("text").alias("text")))
    in_order = Window.partitionBy("lang").orderBy("o", "text")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chars = F.sum(F.length("text").cast("long")).over(so_far)
    return (drawn.withColumns({"at": F.row_number().over(in_order), "chars": chars})
            .where((F.col("at") <= train_docs) & (F.col("chars") <= train_chars)).select("lang", "text", "o"))


def train(labelled: DataFrame, train_docs: int = TRAIN_DOCS, lexicon_size: int = LEXICON_SIZE,
          min_count: int = MIN_COUNT, rounds: int = ROUNDS, train_chars: int = TRAIN_CHARS) -> Model | None:
    """Fit on (doc_id, text, lang), nulls left out; None if nothing is left.
    The lexicons count all documents; the weights are fitted on a sample in
    which neither long texts, nor an id or a row that repeats, pass the
    bounds.  Texts of over ``train_chars`` are not drawn."""
    ship(labelled.sparkSession)
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    labels = sorted(sizes)
    if not labels:
        return None
    counts = (labelled.select("lang", "text").mapInArrow(_count, "lang string, word binary, n long")
              .groupBy("lang", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))
    counts = staged(counts, "langid-words")
    frequent = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = (counts.withColumn("place", F.row_number().over(frequent)).where(F.col("place") <= lexicon_size)
           .select("lang", "word", "place").collect())
    lexicon: dict[bytes, tuple[int, ...]] = {}
    for r in sorted(top, key=lambda r: (r["lang"], r["place"])):
        w = bytes(r["word"])
        lexicon[w] = lexicon.get(w, ()) + (labels.index(r["lang"]),)

    sample = training_sample(labelled, sizes, train_docs, train_chars)
    ddl = "weights binary, transitions binary"

    def learn(table: pa.Table) -> pa.Table:
        rows = table.sort_by([("o", "ascending"), ("text", "ascending")]).select(["text", "lang"]).to_pylist()
        sequences = training_sequences([(r["text"], labels.index(r["lang"])) for r in rows])
        k = len(labels)
        if sequences:
            found = fit(sequences, k, lexicon, rounds)
        else:
            found = np.zeros(((1 << BUCKET_BITS) + k, k), np.float32), np.zeros((k, k), np.float32)
        return pa.table({n: pa.array([_packed(x)], pa.binary()) for n, x in zip(("weights", "transitions"), found)})

    row = sample.groupBy(F.lit(1).alias("one")).applyInArrow(learn, ddl).first()
    if row is None:
        return None
    return Model(labels, lexicon, _unpacked(row["weights"]), _unpacked(row["transitions"]))


def _packed(x: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, x)
    return out.getvalue()


def _unpacked(raw: bytes) -> np.ndarray:
    return np.load(io.BytesIO(bytes(raw)))


# --- prediction --------------------------------------------------------------

_PREDICTED = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("lang_pred", pa.string()),
                        ("score", pa.float64()), ("n_words", pa.int64()),
                        ("shares", pa.map_(pa.string(), pa.float64()))])
_PREDICTED_DDL = ("doc_id long, text_hash long, lang_pred string, score double, n_words long, "
                  "shares map<string,double>")


def judge(model: Model | None, texts: list[str | None]) -> list[tuple]:
    """(language, score, words, shares) of every text, at most about
    ``SCAN_WORDS`` words labelled at a time."""
    out, held, n = [], [], 0
    for text in texts:
        held.append(words(text) if text and model else [])
        n += len(held[-1])
        if n >= SCAN_WORDS:
            out += _judged(model, held)
            held, n = [], 0
    return out + _judged(model, held)


def _judged(model: Model | None, texts: list[list[bytes]]) -> list[tuple]:
    if model is None:
        return [(UNKNOWN, 0.0, 0, {})] * len(texts)
    out = []
    for marginals in model.label_words(texts):
        if not len(marginals):
            out.append((UNKNOWN, 0.0, 0, {}))
            continue
        share = marginals.mean(axis=0, dtype=np.float64)
        best = int(share.argmax())
        out.append((model.labels[best], float(min(1.0, share[best])), len(marginals),
                    dict(zip(model.labels, map(float, share)))))
    return out


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, lang_pred, score, n_words, shares): the language
    of every text, its share of the word marginals, and all shares."""
    d = documents_of(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            out = judge(m, b["text"].to_pylist())
            cols = [pa.array(c, f.type) for c, f in zip(zip(*out), list(_PREDICTED)[2:])] if out else [
                pa.array([], f.type) for f in list(_PREDICTED)[2:]]
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["text_hash"], *cols], schema=_PREDICTED)

    return d.mapInArrow(run, _PREDICTED_DDL)


def fold(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 3; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3


def _labelled(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    ship(docs.sparkSession)
    plain, names = positional(docs)
    return plain.select(F.col(place(names, id_col)).cast("long").alias("doc_id"),
                        F.col(place(names, text_col)).cast("string").alias("text"),
                        F.col(place(names, lang_col)).cast("string").alias("lang"))


def identify(docs: DataFrame, held_out: int = 1, train_docs: int = TRAIN_DOCS, id_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Train on the documents outside fold ``held_out`` and predict all: one
    row per document (doc_id, text_hash, held_out, lang_pred, score, n_words,
    shares).

    Texts that are null or have no letter are ``und`` with score 0, and so is
    everything if no labelled text can be learned from.  Null labels are not
    learned; null ids count as empty text in the fold; rows that repeat are
    each returned; ties between languages go to the first by name; an empty
    table gives an empty result; other columns are ignored whatever their
    names.
    """
    table = _labelled(docs, id_col, text_col, lang_col)
    model = train(table.where(fold() != held_out), train_docs)
    return predict(table, model).select(
        "doc_id", "text_hash", (fold() == held_out).alias("held_out"), "lang_pred", "score", "n_words", "shares")


def keep_identified(docs: DataFrame, min_score: float = 0.0, held_out: int = 1, train_docs: int = TRAIN_DOCS,
                    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` (all columns) for which :func:`identify` gives a
    language with a score of at least ``min_score``; ``und`` goes.  One pass,
    no shuffle of the texts."""
    model = train(_labelled(docs, id_col, text_col, lang_col).where(fold() != held_out), train_docs)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return keep_rows(docs, text_col, lambda texts: [
        lang != UNKNOWN and score >= min_score for lang, score, *_ in judge(sent.value, texts)])

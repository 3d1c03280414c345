import itertools
import zlib

import numpy as np
import pytest

from windowlens.llm import langid, queries
from windowlens.sources.tables import read_table


def enumerated(scores, transitions):
    """Marginals and expected transitions by summing over all labelings."""
    n, k = scores.shape
    marginals, pairs, total = np.zeros((n, k)), np.zeros((k, k)), 0.0
    start = np.log(np.exp(transitions).sum(axis=0))     # the uniform label before the first word
    for labels in itertools.product(range(k), repeat=n):
        s = start[labels[0]] + sum(scores[i, y] for i, y in enumerate(labels))
        s += sum(transitions[a, b] for a, b in zip(labels, labels[1:]))
        p = np.exp(s)
        total += p
        for i, y in enumerate(labels):
            marginals[i, y] += p
        for a, b in zip(labels, labels[1:]):
            pairs[a, b] += p
    return marginals / total, pairs / total


def test_forward_backward_equals_enumeration(monkeypatch):
    monkeypatch.setattr(langid, "SEGMENT", 3)      # several segments a sequence
    rng = np.random.default_rng(0)
    lengths = np.array([1, 7, 3, 4, 6])
    scores, transitions = rng.normal(size=(lengths.sum(), 3)), rng.normal(size=(3, 3))
    got, pairs = langid.forward_backward(scores, lengths, transitions, pairs=True)
    at, want, want_pairs = 0, [], np.zeros((3, 3))
    for n in lengths:
        m, e = enumerated(scores[at:at + n], transitions)
        want.append(m)
        want_pairs += e
        at += n
    np.testing.assert_allclose(got, np.concatenate(want), atol=1e-4)
    np.testing.assert_allclose(pairs, want_pairs, atol=1e-3)


@pytest.fixture(scope="module")
def small_model(spark, small_dir):
    docs = read_table(spark, small_dir, "documents").select("doc_id", "text", "lang")
    return langid.train(docs, train_docs=60)


def test_code_switched_words_are_labelled(spark, small_dir, small_model):
    texts = {r["lang"]: langid.words(r["text"])[:60] for r in
             read_table(spark, small_dir, "documents").where("lang in ('fr', 'en') and length(text) > 800").collect()}
    mixed = texts["fr"] + texts["en"] + texts["fr"]
    truth = np.repeat([small_model.labels.index(x) for x in ("fr", "en", "fr")],
                      [len(texts["fr"]), len(texts["en"]), len(texts["fr"])])
    (marginals,) = small_model.label_words([mixed])
    assert (marginals.argmax(axis=1) == truth).mean() > 0.9
    np.testing.assert_allclose(marginals.sum(axis=1), 1, atol=1e-3)
    assert (np.diag(small_model.transitions) > small_model.transitions.mean(axis=1)).all()


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in read_table(spark, d, "documents").select("doc_id", "lang").collect()}
    rows = queries.op4_language_id(spark, d).collect()
    assert {r["doc_id"] for r in rows} == set(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_only_the_text_counts(spark, small_model):
    one = spark.createDataFrame([(1, "the and of with erenth", "en", "a"), (99, "the and of with erenth", None, "b")],
                                "doc_id long, text string, lang string, source string")
    a, b = langid.predict(one, small_model).drop("doc_id").collect()
    assert a == b


def test_odd_rows(odd, nothing):
    rows = langid.identify(odd).collect()
    assert len(rows) == odd.count()
    for r in rows:
        und = r["doc_id"] in (3, 4, 5, 6) or (r["doc_id"] is None and r["n_words"] == 0)
        assert (r["lang_pred"] == "und") == und and (r["score"] == 0) == und
    assert langid.identify(nothing).collect() == []


def test_without_labels_all_is_undetermined(spark):
    docs = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in langid.identify(docs).collect()] == ["und"]


def test_words():
    assert langid.words("Él y ella-2 'x'") == ["él".encode(), b"y", b"ella", b"x"]
    assert langid.words("¿?… 12") == [] and langid.words("") == []


def test_the_sample_is_bounded(spark):
    """A row repeated many times, a hot id, null ids and long texts."""
    rows = [(7, "the same row again", "en")] * 500 + [(8, f"hot id {i}", "en") for i in range(500)]
    rows += [(None, f"no id {i}", "en") for i in range(500)] + [(9, "long " * 400, "en")]
    rows += [(100 + i, f"un deux {i} " * 20, "fr") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = langid.training_sample(docs, {"en": 1501, "fr": 300}, 50, 1500).collect()
    for lang in ("en", "fr"):
        texts = [r["text"] for r in got if r["lang"] == lang]
        assert 0 < len(texts) <= 50 and sum(map(len, texts)) <= 1500
        assert texts.count("the same row again") <= 1 and max(map(len, texts)) <= 1500


def test_text_without_blanks_does_not_fill_the_cache(small_model, monkeypatch):
    monkeypatch.setattr(langid, "CACHE_BYTES", 5_000)
    for i in range(50):
        small_model.word_scores([b"the", f"{'你好' * 200}{'x' * i}".encode()])
        assert small_model._held <= 5_000 + 1_500
    small_model._forget()


def test_word_counts_are_passed_on(monkeypatch):
    import pyarrow as pa
    texts = ["a b", "b c " * 30, "你好" * 60] * 20
    batch = pa.record_batch({"lang": ["x"] * len(texts), "text": texts})
    want = {}
    for chars in (1 << 20, 100):
        monkeypatch.setattr(langid, "COUNTED_CHARS", chars)
        got = {}
        for out in langid._count(iter([batch, batch])):
            for r in out.to_pylist():
                got[r["word"]] = got.get(r["word"], 0) + r["n"]
        want = want or got
        assert got == want and got[b"b"] == 2 * 20 * 31

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from windowlens.llm import packing, queries
from windowlens.sources.tables import read_table


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(queries.TOKENIZER)


def whole_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, ids_of, capacity):
    """Pieces rebuild every document; places are gapless; nothing overfull."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(ids_of)
    for doc, parts in by_doc.items():
        ids, at = ids_of[doc], 0
        for i, r in enumerate(sorted(parts, key=lambda r: r["piece"])):
            cut = ids[at:at + capacity]
            assert (r["piece"], r["start"], r["length"]) == (i, at, len(cut))
            assert r["ids_crc32"] == zlib.crc32(np.array(cut, "<u4").tobytes())
            at += len(cut)
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by_sequence)


def test_ids_equal_the_whole_tokenizer(tokenizer):
    own = packing.WordTokenizer(queries.TOKENIZER)
    texts = ["Hello's we'll DON'T <|endoftext|>x a\tb H̱ İ naïve Ａ ﬁ 12½ ²³ foo bar\x0bq ¿que? á ​ ß ẞ Σας ς",
             "", " \n ", "'s 's't'", "x\x85y \x1c z", "你好 \U0001f600 é É É", "a" * 3000, "<| |> <|startoftext|>",
             "ÀÉÎ×÷ÿ ÉcoLE l'été 10,000.50%"]
    for text in texts + texts[::-1]:
        assert np.frombuffer(own(text.encode()), "<u4").tolist() == whole_ids(tokenizer, text)[:-1], text


def test_text_without_blanks_does_not_fill_the_caches(monkeypatch, tokenizer):
    monkeypatch.setattr(packing, "CHUNK_BYTES", 20_000)
    own = packing.WordTokenizer(queries.TOKENIZER)
    for i in range(300):
        text = f"start {'你好吗' * 300}{i} mid{i}dle {'x' * 500}{i} end"
        ids = own(text.encode())
        assert own.chunks.held <= 20_000 and max(map(len, own.chunks)) <= 256
        if i % 50 == 0:
            assert np.frombuffer(ids, "<u4").tolist() == whole_ids(tokenizer, text)[:-1]


def test_best_fit():
    rng = random.Random(2)
    for _ in range(50):
        sizes = np.array([rng.randint(1, 64) for _ in range(rng.randint(1, 200))])
        bins, at, fills = packing.best_fit(sizes, 64)
        assert (fills <= 64).all() and fills.sum() == sizes.sum()
        for b in range(len(fills)):
            own = np.flatnonzero(bins == b)
            order = own[np.argsort(at[own])]
            assert at[order].tolist() == np.concatenate(([0], np.cumsum(sizes[order])[:-1])).tolist()
        # no two bins could have been one
        assert len(fills) < 2 or np.sort(fills)[:2].sum() > 64


@pytest.mark.parametrize("group_rows", [50, 10_000])
def test_rounds_pack_tightly(spark, group_rows):
    rng = random.Random(4)
    sizes = [rng.choice([rng.randint(1, 30), rng.randint(100, 512), 512, 257]) for _ in range(2000)]
    items = spark.createDataFrame(list(enumerate(sizes)), "item long, size long")
    rows = packing.pack(items, 512, group_rows, slack=2).collect()
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], sizes[r["item"]]))
    assert sorted(r["item"] for r in rows) == list(range(2000))
    for parts in by_sequence.values():
        ends = np.cumsum([s for _, s in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 512
    best = len(packing.best_fit(np.array(sizes), 512)[2])
    assert len(by_sequence) <= best * (1.12 if group_rows == 50 else 1.0)


def test_items_that_never_share(spark):
    items = spark.createDataFrame([(i, 300) for i in range(400)], "item long, size long")
    rows = packing.pack(items, 512, group_rows=20).collect()
    assert len({r["sequence_id"] for r in rows}) == 400 and {r["offset"] for r in rows} == {0}


def test_odd_rows(odd, nothing, tokenizer):
    rows = packing.pack_documents(odd, queries.TOKENIZER, capacity=64, group_rows=100).collect()
    texts = {(r[0], r[1]) for r in odd.toDF(*[f"c{i}" for i in range(len(odd.columns))]).collect()}
    twice = [r for r in rows if r["doc_id"] == 2]
    assert len(twice) == 2 and len({(r["sequence_id"], r["offset"]) for r in twice}) == 2
    assert sum(r["length"] for r in rows) == sum(len(whole_ids(tokenizer, t)) for _, t in texts) + twice[0]["length"]
    assert packing.pack_documents(nothing, queries.TOKENIZER).collect() == []


def test_sequences_hold_the_documents(spark, tokenizer, prose):
    docs = spark.createDataFrame(prose[:80] + [(999, prose[0][1] * 40)], "doc_id long, text string")
    ids_of = {r["doc_id"]: whole_ids(tokenizer, r["text"]) for r in docs.collect()}
    packed = packing.pack_documents(docs, queries.TOKENIZER, capacity=256, with_ids=True)
    rows = packed.collect()
    check(rows, ids_of, 256)
    full = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    for r in rows:
        part = full[r["sequence_id"]]["ids"][r["offset"]:r["offset"] + r["length"]]
        assert part == ids_of[r["doc_id"]][r["start"]:r["start"] + r["length"]]
    assert all(len(s["ids"]) == s["n_tokens"] <= 256 for s in full.values())


def test_query(spark, small_dir, tokenizer):
    docs = read_table(spark, small_dir, "documents").select("doc_id", "text").collect()
    ids_of = {r["doc_id"]: whole_ids(tokenizer, r["text"]) for r in docs}
    n = check(queries.op7_best_fit_packing(spark, small_dir).collect(), ids_of, 4096)
    assert n <= -(-sum(map(len, ids_of.values())) // 4096) + 2

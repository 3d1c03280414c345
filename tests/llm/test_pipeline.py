import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import odd_rows
from tests.llm.test_decontaminate import plain as plain_hits
from tests.llm.test_exact import lowered
from tests.llm.test_simhash import plain_components, plain_fingerprint
from windowlens.sources.tables import read_table

STAGE = dict(corpus_pipeline.STAGES)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=lambda r: [(x is None, str(x)) for x in r])


def test_stages_by_brute_force(spark, small_dir, tmp_path):
    docs = read_table(spark, small_dir, "documents")
    every = {r["doc_id"]: r for r in docs.collect()}
    items = [(str(r["item_id"]), r["text"]) for r in read_table(spark, small_dir, "benchmark").collect()]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, small_dir).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        if name != "best_fit_packing":
            assert docs.columns == COLUMNS
            kept[name] = docs.collect()
            assert all(every[r["doc_id"]] == r for r in kept[name])
    ids = {name: {r["doc_id"] for r in rows} for name, rows in kept.items()}
    assert all(len(ids[n]) == len(kept[n]) for n in kept)

    assert ids["language_id"] == {i for i, r in every.items() if any(c.isalpha() for c in r["text"] or "")}
    best = {}
    for i in ids["language_id"]:
        t = lowered(every[i]["text"])
        best[t] = max(best.get(t, i), i)
    assert ids["exact_dedup"] == set(best.values())
    fps = [(i, plain_fingerprint(every[i]["text"])) for i in sorted(ids["exact_dedup"])]
    assert ids["simhash_near_dedup"] == {i for (i, _), c in zip(fps, plain_components(fps)) if i == c}
    assert ids["benchmark_decontamination"] == {
        i for i in ids["simhash_near_dedup"] if not plain_hits(every[i]["text"], items, 10)[1]}
    pieces = docs.collect()
    assert {r["doc_id"] for r in pieces} == ids["benchmark_decontamination"]
    clean = spark.read.parquet(str(tmp_path / "benchmark_decontamination"))
    assert {(r["doc_id"], r["text_hash"]) for r in pieces} == {
        tuple(r) for r in clean.select("doc_id", F.xxhash64("text")).collect()}
    assert rows_of(corpus_pipeline.run(spark, small_dir).drop("sequence_id", "offset")) == rows_of(
        docs.drop("sequence_id", "offset"))


@pytest.mark.parametrize("name", list(STAGE))
def test_odd_rows(spark, odd, nothing, small_dir, name):
    out = STAGE[name](spark, odd, small_dir)
    got = [r[0] for r in out.collect()]
    if name == "best_fit_packing":
        assert set(got) == {r[0] for r in odd_rows()}
    else:
        assert out.columns == odd.columns
        assert len(got) <= len(odd_rows())
    if name == "language_id":
        assert not {3, 4, 5, 6} & set(got) and {1, 2, 7, 10} <= set(got)
    if name == "exact_dedup":
        assert got.count(2) == 1 and 1 not in got and 4 in got and 3 not in got and {8, 9} <= set(got)
    if name == "simhash_near_dedup":
        assert got.count(1) == 1 and 2 not in got and {3, 7} <= set(got) and 4 not in got
    if name == "benchmark_decontamination":
        assert len(got) == len(odd_rows())
    assert STAGE[name](spark, nothing, small_dir).collect() == []


def test_equal_ids_with_different_texts_are_different_documents(spark, small_dir):
    docs = spark.createDataFrame([(5, "one text here"), (5, "another text there"), (6, "one text here")],
                                 "doc_id long, text string")
    out = STAGE["exact_dedup"](spark, docs, small_dir).collect()
    assert sorted(map(tuple, out)) == [(5, "another text there"), (6, "one text here")]


def test_code_switched_texts_stay(spark, small_dir):
    """Equal parts of every language: none has a large share."""
    docs = read_table(spark, small_dir, "documents")
    longest = {}
    for r in docs.where("lang is not null").collect():
        have = longest.get(r["lang"], "").split()
        if len(set((r["text"] or "").split())) > len(set(have)):
            longest[r["lang"]] = r["text"]
    assert len(longest) == 4
    mixed = [(10**6 + i, " ".join(" ".join(t.split()[20 * i:20 * i + 20]) for t in longest.values()), None, "m", 0)
             for i in range(5)]
    out = STAGE["language_id"](spark, docs.union(spark.createDataFrame(mixed, docs.schema)), small_dir)
    assert {r["doc_id"] for r in out.where("doc_id >= 1000000").collect()} == {m[0] for m in mixed}


@pytest.mark.parametrize("name", ["exact_dedup", "simhash_near_dedup"])
def test_one_row_of_a_group_without_ids_or_of_one_id_stays(spark, small_dir, name):
    one, two = "the cat sat on the mat and looked at the moon", "un chat dormait sur le toit de la vieille maison"
    docs = spark.createDataFrame([(None, one), (None, one.upper()), (None, one.title()), (5, two), (5, two.upper()),
                                  (5, two), (6, "something else that stays")], "doc_id long, text string")
    out = STAGE[name](spark, docs, small_dir).collect()
    assert sorted(r["text"].lower() for r in out) == sorted([one, two, "something else that stays"])

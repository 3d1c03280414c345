import random

import numpy as np

from windowlens.llm import quality, queries
from windowlens.sources.tables import read_table


def corpus(spark, n=800):
    rng = random.Random(0)
    good, bad = [f"good{i}" for i in range(60)], [f"bad{i}" for i in range(60)]
    both = [f"both{i}" for i in range(60)]
    docs, labels = [], []
    for i in range(n):
        ok = i % 4 > 0
        docs.append((i, " ".join(rng.choices(both + (good if ok else bad), k=80))))
        if i % 3 == 0:
            labels.append((i, int(ok), 0))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_keeps_what_looks_like_the_target(spark):
    docs, labels = corpus(spark)
    rows = quality.resample(docs, labels).collect()
    share = sum(1 for i in range(0, 800, 3) if i % 4) / len(range(0, 800, 3))
    assert sum(r["kept"] for r in rows) == round(share * 800)
    held = [(r["kept"], r["doc_id"] % 4 > 0) for r in rows if r["doc_id"] % 3]
    assert sum(k == g for k, g in held) / len(held) > 0.95


def test_top_k_equals_sorting(spark):
    rng = random.Random(1)
    rows = [(i, float(rng.choice([rng.randint(0, 5), rng.random() * 9]))) for i in range(3000)]
    table = spark.createDataFrame(rows, "row long, v double")
    order = [i for i, _ in sorted(rows, key=lambda r: (-r[1], r[0]))]
    for k in (0, 1, 700, 1500, 2999, 3000, 5000):
        for ranked in (10, 100_000):
            got = quality.top_k(table, "v", k, "row", ranked).where("kept").collect()
            assert {r["row"] for r in got} == set(order[:k]), (k, ranked)
    flat = spark.createDataFrame([(i, 1.0) for i in range(500)], "row long, v double")
    assert {r["row"] for r in quality.top_k(flat, "v", 77, "row", 10).where("kept").collect()} == set(range(77))


def test_top_k_with_nearly_equal_keys(spark):
    """997 of 1000 keys are equal, the smaller ones come first by the tie."""
    rows = [(i, 0.25 * i if i < 3 else 1.0) for i in range(1000)]
    table = spark.createDataFrame(rows, "row long, v double")
    order = [i for i, _ in sorted(rows, key=lambda r: (-r[1], r[0]))]
    for k in (1, 50, 700, 997, 998, 999):
        got = quality.top_k(table, "v", k, "row", 10).where("kept").collect()
        assert sorted(r["row"] for r in got) == sorted(order[:k]), k


def test_counts_cover_every_document(spark, prose):
    docs = spark.createDataFrame(prose, "doc_id long, text string")
    got = {r["bucket"]: (r["raw"], r["target"]) for r in quality.count_models(docs, {1, 2, 3}).collect()}
    raw, target = np.zeros(1 << 16, int), np.zeros(1 << 16, int)
    for i, t in prose:
        found = quality.buckets(t.encode())
        np.add.at(raw, found, 1)
        if i in (1, 2, 3):
            np.add.at(target, found, 1)
    assert got == {b: (raw[b], target[b]) for b in np.flatnonzero(raw)}


def test_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, None), (None, 1, 1), (10, None, None), (77, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = quality.resample(odd, labels).collect()
    assert len(rows) == odd.count()
    assert all(r["n_ngrams"] == 0 and r["log_weight"] == 0 for r in rows if r["doc_id"] in (3, 4, 5))
    assert quality.resample(nothing, labels).collect() == []
    assert all(r["kept"] for r in quality.resample(odd, labels.limit(0)).collect())
    assert sum(r["kept"] for r in quality.resample(odd, labels.limit(0), fraction=0.5).collect()) == round(0.5 * 13)


def test_query_prefers_good_documents(spark):
    d = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] == 1 and r["toxic"] == 0 for r in read_table(spark, d, "labels").collect()}
    rows = queries.op5_quality_resampling(spark, d).collect()
    kept = {good: [r["kept"] for r in rows if labels.get(r["doc_id"]) is good] for good in (True, False)}
    assert len(rows) == 1000
    assert sum(kept[True]) / len(kept[True]) > sum(kept[False]) / len(kept[False]) + 0.15

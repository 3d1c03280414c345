import hashlib
import math
import random
import re
import zlib

import numpy as np

from tests.oracle_harness import compare, duck, duck_rows, spark_rows
from windowlens.llm import importance, queries
from windowlens.llm.oracle import ORACLES


def plain(docs, items, percent=10, min_words=20, max_run=1, buckets=10_000, seed=2024):
    """From the definition, with dictionaries: {(doc_id, text): (n_features, weight, score, rank)}."""
    def feats(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        runs = [" ".join(w[i:i + n]) for n in range(1, max_run + 1) for i in range(len(w) - n + 1)]
        return len(w), [zlib.crc32(x.encode()) % buckets for x in runs]
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [x for _, x in docs]), (t, items)):
        for x in texts:
            for b in feats(x)[1]:
                counts[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (sum(s) + buckets) / ((s[b] + 1.0) * (sum(t) + buckets))))
            for b in range(buckets)]
    rows = []
    for i, x in docs:
        n, f = feats(x)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))])
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    rank = {id(r): at + 1 for at, r in enumerate(able[:percent * len(able) // 100])}
    return [(r[0], r[2], r[3], r[4], rank.get(id(r))) for r in rows]


def key(rows):
    return sorted(rows, key=lambda r: [(x is None, x or 0) for x in r])


def got(df):
    return key([(r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in df.collect()])


def test_equals_definition(spark, prose):
    docs = spark.createDataFrame(prose, "doc_id long, text string").repartition(5)
    texts = [t for _, t in prose[:40:3]]
    items = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "item_id string, text string")
    assert got(importance.resample(docs, items)) == key(plain(prose, texts))
    other = dict(percent=35, min_words=60, max_run=3, buckets=77, seed=5)
    assert got(importance.resample(docs, items, **other)) == key(plain(prose, texts, **other))


def test_planes_sum_exactly():
    rng = random.Random(3)
    for size, most in ((1, 0), (64, 5), (65, 1), (1000, 9000), (130, 1 << 40)):
        gain = np.array([rng.randint(-most, most) for _ in range(size)])
        table = importance.GainPlanes(gain)
        for n in (0, 1, 7, 5000):
            found = np.array([rng.randrange(size) for _ in range(n)], dtype=np.int64)
            assert table.weight(found) == sum(int(gain[b]) for b in found)
    low = importance.GainPlanes(np.array([-8, 7]))
    assert (low.weight(np.array([0])), low.weight(np.array([1, 1, 0]))) == (-8, 6)


def test_ranks_with_ties(spark):
    """A third of the rows share id and text: ranks stay 1..k, each once."""
    same = [(7, "alpha beta " * 15)] * 200
    rest = [(i, " ".join(f"w{(i * j) % 50}" for j in range(30))) for i in range(100, 500)]
    docs = spark.createDataFrame(same + rest, "doc_id long, text string").repartition(7)
    items = spark.createDataFrame([("a", "alpha")], "item_id string, text string")
    rows = got(importance.resample(docs, items, percent=50))
    assert rows == key(plain(same + rest, ["alpha"], percent=50))
    assert sorted(r[4] for r in rows if r[4]) == list(range(1, 301))


def test_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame([("a", "The cat sat, the moon"), ("a", None), (None, "")], "item_id string, text string")
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    rows = got(importance.resample(odd, items, percent=100, min_words=5))
    assert rows == key(plain(docs, ["The cat sat, the moon"], percent=100, min_words=5))
    assert all(r[1:3] == (0, 0) and r[4] is None for r in rows if r[0] in (3, 4, 5))
    assert importance.resample(nothing, items).collect() == []
    assert got(importance.resample(odd, items.limit(0))) == key(plain(docs, []))


def test_query_matches_sql_twin(spark, small_dir):
    name = "op11_importance_resampling"
    problems = compare(spark_rows(queries.QUERIES[name](spark, small_dir)), duck_rows(duck(small_dir), ORACLES[name]))
    assert not problems, problems

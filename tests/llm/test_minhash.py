import random
import re

import numpy as np
import pytest

from tests.oracle_harness import compare, duck, duck_rows, spark_rows
from windowlens.llm import minhash, queries
from windowlens.llm.oracle import ORACLES


def plain_set(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(" ".join(w[i:i + k]) for i in range(len(w) - k + 1)) or frozenset([" ".join(w)])


def plain(docs, percent=85, k=5):
    """All pairs, from the definition."""
    sets = [plain_set(t, k) for _, t in docs]
    at = list(range(len(docs)))

    def find(x):
        while at[x] != x:
            x = at[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                at[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(sets[i]), c := least.get(find(i)), d == c) for i, (d, _) in enumerate(docs)]


def key(rows):
    return sorted(rows, key=lambda r: [(x is None, x or 0) for x in r])


def got(df):
    return key([(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()])


@pytest.mark.parametrize("block,percent,shingle", [(minhash.BLOCK, 85, 5), (300, 60, 2)])
def test_equals_all_pairs(spark, prose, block, percent, shingle):
    docs = spark.createDataFrame(prose, "doc_id long, text string").repartition(5)
    assert got(minhash.near_duplicates(docs, shingle, percent, block)) == key(plain(prose, percent, shingle))


def test_keys_for_a_threshold():
    assert [minhash.band_rows(p) for p in (85, 60, 10)] == [6, 3, 1]


def chain(n, length=200, step=12):
    """Texts that each share about 90% with the next and little with later ones: a chain of links."""
    words = [f"w{i}" for i in range(length + n * step)]
    return [" ".join(words[i * step:i * step + length]) for i in range(n)]


@pytest.mark.parametrize("block", [minhash.BLOCK, 2500])
def test_chains_and_crowds(spark, block):
    """A chain of links, a crowd of 300 near copies of one text and texts that share a third with it."""
    rng = random.Random(4)
    base = [f"v{rng.randrange(5000)}" for _ in range(240)]
    crowd = []
    for _ in range(300):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
        crowd.append(" ".join(w))
    third = [" ".join(base[:90] + [f"y{rng.randrange(10 ** 6)}" for _ in range(160)]) for _ in range(60)]
    docs = list(enumerate(chain(25, 200, 6) + crowd + third + crowd[:50]))
    rng.shuffle(docs)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    assert got(minhash.near_duplicates(table, block=block)) == key(plain(docs))


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5, 50, 191, 700, 5000):
        s = minhash.sketch(np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)))
        rounds = s >> np.uint64(32)
        assert len(s) == minhash.COORDS and rounds.max() < 2 * minhash.COORDS
        assert (rounds == 0).mean() > 0.95 if n > 5000 else True
    errors = []
    for n in (30, 200, 3000):
        for share in (0.3, 0.85):
            both = rng.integers(0, 1 << 63, round(n * share)).astype(np.uint64)
            a, b = (np.concatenate((both, rng.integers(0, 1 << 63, round(n * (1 - share) / 2)).astype(np.uint64)))
                    for _ in range(2))
            true = len(both) / (len(a) + len(b) - len(both))
            errors.append(abs((minhash.sketch(np.unique(a)) == minhash.sketch(np.unique(b))).mean() - true))
    assert max(errors) < 0.15 and np.mean(errors) < 0.05


def test_sketch_equals_rounds_one_by_one():
    """Bins and values drawn round by round, with the smallest kept."""
    rng = np.random.default_rng(1)
    for n in (1, 3, 40, 300):
        h = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        want = [None] * minhash.COORDS
        for i in range(2 * minhash.COORDS):
            new = {}
            for x in minhash._mixed(h + np.uint64(i * 0x9E3779B97F4A7C15 % 2 ** 64)).tolist():
                at = i - minhash.COORDS if i >= minhash.COORDS else (x >> 32) * minhash.COORDS >> 32
                new[at] = min(new.get(at, 1 << 32), x & 0xFFFFFFFF)
            for at, v in new.items():
                if want[at] is None:
                    want[at] = i << 32 | v
            if None not in want:
                break
        assert minhash.sketch(h).tolist() == want


def test_odd_rows(spark, odd, nothing):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    rows = got(minhash.near_duplicates(odd))
    assert rows == key(plain(docs))
    assert all(r[1] == 0 and r[2] == r[0] and r[3] for r in rows if r[0] in (3, 4, 5))
    assert minhash.near_duplicates(nothing).collect() == []


def test_query_matches_sql_twin(spark, small_dir):
    name = "op12_minhash_near_dedup"
    problems = compare(spark_rows(queries.QUERIES[name](spark, small_dir)), duck_rows(duck(small_dir), ORACLES[name]))
    assert not problems, problems

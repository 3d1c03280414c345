import random

import numpy as np
import pytest
import xxhash

from windowlens.llm import graph, queries, simhash
from windowlens.sources.tables import read_table


def plain_fingerprint(text):
    """Bit by bit, from the definition."""
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ")
    words = [w for w in words.replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ")
             if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, bits=3):
    """Smallest id reachable, over all pairs."""
    label = [i for i, _ in rows]
    at = list(range(len(rows)))

    def find(x):
        while at[x] != x:
            x = at[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= bits:
                at[find(i)] = find(j)
    least = {}
    for i, x in enumerate(label):
        if x is not None:
            r = find(i)
            least[r] = min(least.get(r, x), x)
    return [least.get(find(i)) for i in range(len(rows))]


@pytest.mark.parametrize("limit,blocks", [(4096, 6), (3, 5)])
def test_equals_all_pairs(spark, prose, limit, blocks):
    docs = spark.createDataFrame(prose, "doc_id long, text string")
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs, blocks=blocks, run_limit=limit).collect()}
    fps = [(i, plain_fingerprint(t)) for i, t in prose]
    assert [int(got[i]["fingerprint"], 16) for i, _ in prose] == [f for _, f in fps]
    assert [got[i]["component_id"] for i, _ in prose] == plain_components(fps)
    assert len(got) == len(prose)


def test_crowded_keys_lose_no_link(spark):
    """A cluster of 600 fingerprints that differ in few bits, dealt again."""
    rng = random.Random(1)
    base = rng.getrandbits(64)
    fps = {base}
    while len(fps) < 600:
        f = rng.choice(list(fps))
        for _ in range(rng.randint(1, 3)):
            f ^= 1 << rng.randrange(20)
        fps.add(f)
    fps |= {rng.getrandbits(64) for _ in range(200)}
    rows = sorted(fps)
    signed = [(f - (1 << 64) if f >= 1 << 63 else f,) for f in rows]
    links = simhash.links(spark.createDataFrame(signed, "fp long"), run_limit=16)
    roots = {r["node"]: r["root"] for r in graph.components(links).collect()}
    got = {}
    for (s,), f in zip(signed, rows):
        got.setdefault(roots.get(s, s), set()).add(f)
    want = {}
    for f, c in zip(rows, plain_components(list(enumerate(rows)))):
        want.setdefault(c, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_tables_bring_every_near_pair_together():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    b = a.copy()
    for _ in range(3):
        b ^= np.uint64(1) << rng.integers(0, 64, 500, dtype=np.uint64)
    masks = simhash.table_masks(6, 3)
    assert len(masks) == 20
    assert (simhash.pivot_keys(a, masks) == simhash.pivot_keys(b, masks)).any(axis=0).all()


def test_path_of_links_has_one_root(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(5, 5), (100, 101)], "a long, b long")
    roots = {r["node"]: r["root"] for r in graph.components(path).collect()}
    assert roots == {**{i: 0 for i in range(1, 61)}, 101: 100}


def test_odd_rows(odd, nothing):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert by_id[1][0]["component_id"] == by_id[2][0]["component_id"] == 1 and len(by_id[2]) == 2
    assert {r["fingerprint"] for i in (3, 4, 5) for r in by_id[i]} == {"0" * 16}
    assert by_id[5][0]["component_id"] == 3
    assert simhash.near_duplicates(nothing).collect() == []


def test_query_equals_brute_force(spark, small_dir):
    docs = read_table(spark, small_dir, "documents").select("doc_id", "text").collect()
    fps = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs]
    got = {r["doc_id"]: r for r in queries.op1_simhash_near_dedup(spark, small_dir).collect()}
    assert [got[i]["fingerprint"] for i, _ in fps] == [f"{f:016x}" for _, f in fps]
    assert [got[i]["component_id"] for i, _ in fps] == plain_components(fps)

import hashlib
import math
import zlib

from windowlens.llm import queries, sharding
from windowlens.sources.tables import read_table


def plain_shard(doc, topology):
    """The descent, level by level."""
    rows = [t for t in topology if t[3] > 0]
    for level in range(3):
        names = {}
        for t in rows:
            names.setdefault(t[level] if level < 2 else f"shard{t[2]}", []).append(t)
        draws = []
        for i, (name, below) in enumerate(names.items()):
            u = (int(hashlib.md5(f"{doc}/{name}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
            draws.append((-math.log(u) / sum(t[3] for t in below), i, below))
        rows = min(draws)[2]
    return rows[0][2]


def placed(spark, topology, n=3000):
    docs = spark.range(n).selectExpr("id AS doc_id", "'t' AS text")
    return {r["doc_id"]: r["shard"] for r in sharding.shard_documents(docs, topology).collect()}


def test_equals_the_descent(spark):
    topology = [("a", "a1", 0, 1.0), ("a", "a1", 1, 3.0), ("a", "a2", 2, 2.0), ("b", "b1", 3, 4.0), ("b", "b1", 4, 0.0)]
    got = placed(spark, topology, 500)
    assert got == {i: plain_shard(i, topology) for i in range(500)}
    assert 4 not in got.values()


def test_shares_follow_the_weights(spark):
    topology = [("a", "a1", 0, 1.0), ("a", "a2", 1, 2.0), ("b", "b1", 2, 3.0), ("b", "b1", 3, 2.0)]
    got = list(placed(spark, topology, 8000).values())
    for _, _, shard, weight in topology:
        assert abs(got.count(shard) / 8000 - weight / 8) < 0.03


def test_changes_stay_in_their_subtree(spark):
    topology = sharding.even_topology()
    before = placed(spark, topology)
    heavier = [(r, k, s, w * 3 if s == 5 else w) for r, k, s, w in topology]
    after = placed(spark, heavier)
    region = {s: r for r, _, s, _ in topology}
    rack = {s: k for _, k, s, _ in topology}
    moved = [(before[d], after[d]) for d in before if before[d] != after[d]]
    assert moved and any(b == 5 for _, b in moved)
    # whoever moves ends where a weight has grown: its region, its rack, or the shard itself
    for a, b in moved:
        if region[a] != region[5]:
            assert region[b] == region[5]
        elif rack[a] != rack[5]:
            assert rack[b] == rack[5]
        else:
            assert b == 5
    one_more = placed(spark, sharding.grown(topology))
    assert {one_more[d] for d in before if before[d] != one_more[d]} == {16}
    two_more = placed(spark, sharding.grown(sharding.grown(topology)))
    assert {two_more[d] for d in before if one_more[d] != two_more[d]} == {17}


def check_slots(rows):
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))


def test_odd_rows(odd, nothing):
    rows = sharding.shard_documents(odd).collect()
    assert len(rows) == odd.count()
    check_slots(rows)
    assert len({r["shard"] for r in rows if r["doc_id"] is None}) == 1
    assert {r["size"] for r in rows if r["doc_id"] in (3, 4)} == {1}
    assert {r["text_crc32"] for r in rows if r["doc_id"] in (3, 4)} == {0}
    assert {r["size"] for r in rows if r["doc_id"] == 8} == {3}
    assert sharding.shard_documents(nothing).collect() == []


def test_query(spark, small_dir):
    text = {r["doc_id"]: r["text"] for r in read_table(spark, small_dir, "documents").collect()}
    rows = queries.op10_sharding(spark, small_dir).collect()
    check_slots(rows)
    topology = sharding.even_topology()
    more = sharding.grown(topology)
    for r in rows:
        raw = (text[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert (r["shard"], r["grown_shard"]) == (plain_shard(r["doc_id"], topology), plain_shard(r["doc_id"], more))
    assert sorted(r["doc_id"] for r in rows) == sorted(text)


def test_no_python_in_the_plan(spark, small_dir):
    plan = sharding.shard_documents(read_table(spark, small_dir, "documents"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "InArrow"))

import hashlib

import pyarrow as pa

from windowlens.llm import exact, oracle, queries
from tests.oracle_harness import compare, duck, duck_rows, spark_rows


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_odd_rows(odd, nothing):
    rows = exact.exact_duplicates(odd, capacity=200).collect()
    assert len(rows) == odd.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert [r["kept"] for r in by_id[2]] == [True, True] and not by_id[1][0]["kept"]
    assert by_id[1][0]["keep_id"] == 2 and by_id[1][0]["group_size"] == 3
    # null and empty are equal; the largest id stays, a null id never wins
    assert by_id[3][0]["keep_id"] == 4 and by_id[4][0]["kept"] and by_id[4][0]["group_size"] == 3
    assert by_id[4][0]["text_sha256"] == hashlib.sha256(b"").hexdigest()
    # only A-Z are lower-cased
    assert by_id[8][0]["kept"] and by_id[9][0]["kept"]
    assert exact.exact_duplicates(nothing).collect() == []


def test_index_holds_every_text_once(spark, prose, tmp_path):
    docs = spark.createDataFrame(prose + [(1000 + i, t.upper()) for i, t in prose], "doc_id long, text string")
    path = str(tmp_path / "index")
    got = {r["doc_id"]: r for r in exact.exact_duplicates(docs, path=path, capacity=2_000).collect()}
    groups = {}
    for r in docs.collect():
        groups.setdefault(lowered(r["text"]), []).append(r["doc_id"])
    for text, ids in groups.items():
        for i in ids:
            assert (got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) == (max(ids), len(ids), i == max(ids))
            assert got[i]["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    index = spark.read.parquet(path)
    assert sorted(r["text"] for r in index.collect()) == sorted(groups)
    assert index.select("bucket").distinct().count() > 8


def test_directory_doubles_and_splits():
    depth, slots, local = exact.build_directory({0: 50, 1: 60, 9: 10, 15: 5}, 4, 64)
    assert depth == 4 and len(slots) == 16
    for bucket, d in enumerate(local):
        at = [i for i, s in enumerate(slots) if s == bucket]
        assert len(at) == 1 << (depth - d) and at == list(range(at[0], at[0] + len(at)))
    assert slots[0] != slots[1] and slots[8] == slots[15]
    assert exact.build_directory({}, 4, 64) == (0, [0], [0])
    # one overfull cell ends at the deepest level
    assert exact.build_directory({3: 1000}, 4, 64)[0] == 4


def test_texts_with_one_key_are_chained():
    cols = {"bucket": [0, 0, 0, 0], "key": [7, 7, 7, 8], "keep_id": [1, 5, 3, 2], "copies": [1, 2, 4, 1],
            "text": ["a", "b", "a", "a"]}
    batch = pa.RecordBatch.from_pydict(cols, schema=exact._COPIES)
    rows = [r for b in exact._own(iter([batch.slice(0, 2), batch.slice(2)])) for r in b.to_pylist()]
    assert [(r["key"], r["chain"], r["keep_id"], r["group_size"], r["text"]) for r in rows] == [
        (7, 0, 3, 5, "a"), (7, 1, 5, 2, "b"), (8, 0, 2, 1, "a")]


def test_combining_holds_little():
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([1, 2, 3, 4], pa.int64()),
                                        "text": ["A", "b", "a", None]})
    small = [r for b in exact._combine(0, [0], held=0)(iter([batch])) for r in b.to_pylist()]
    whole = [r for b in exact._combine(0, [0])(iter([batch])) for r in b.to_pylist()]
    assert sum(r["copies"] for r in small) == sum(r["copies"] for r in whole) == 4
    assert {(r["text"], r["keep_id"], r["copies"]) for r in whole} == {("a", 3, 2), ("b", 2, 1), ("", 4, 1)}


def test_texts_that_are_not_utf8_have_a_row(spark):
    docs = spark.sql("""select * from values (1L, cast(X'61FF' as string)), (2L, cast(X'41FF' as string)),
                        (3L, cast(X'61FE' as string)), (4L, 'a\\\\xff'), (5L, 'a') t(doc_id, text)""")
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact.exact_duplicates(docs).collect()}
    assert got == {1: (2, 2, False), 2: (2, 2, True), 3: (3, 1, True), 4: (4, 1, True), 5: (5, 1, True)}


def test_query_equals_sql(spark, small_dir):
    sql = oracle.ORACLES["op9_exact_dedup"]
    assert compare(spark_rows(queries.op9_exact_dedup(spark, small_dir)), duck_rows(duck(small_dir), sql)) == []

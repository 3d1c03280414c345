import hashlib
import random
import re

from windowlens.llm import decontaminate as dc
from windowlens.llm import oracle, queries
from tests.oracle_harness import compare, duck, duck_rows, spark_rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(doc, items, window):
    """Hit positions and items, from the definition."""
    w, hit, found = plain_words(doc), set(), set()
    for item_id, item in items:
        x = plain_words(item)
        n = min(window, len(x))
        windows = {tuple(x[i:i + n]) for i in range(len(x) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i:i + n]) in windows:
                hit.update(range(i, i + n))
                found.add(item_id)
    return w, hit, found


def made(seed, n_docs=60):
    rng = random.Random(seed)
    letters = ["a", "b", "c", "d"]
    items = [(f"i{k}", " ".join(rng.choices(letters, k=rng.randint(0, 14)))) for k in range(25)]
    docs = []
    for k in range(n_docs):
        parts = [" ".join(rng.choices(letters + ["zz"], k=rng.randint(0, 20))), rng.choice(items)[1].upper(),
                 " ".join(rng.choices(letters + ["Q9", "é"], k=rng.randint(0, 9)))]
        docs.append((k, rng.choice([" ", "; ", "\n"]).join(parts)))
    return docs, items


def test_automaton_equals_brute_force():
    for seed in range(25):
        docs, items = made(seed, 12)
        window = random.Random(seed).choice([2, 3, 5, 10])
        automaton = dc.SuffixAutomaton(window)
        for item_id, text in items:
            automaton.add(item_id, dc.words(text.encode()))
        automaton.finish()
        for _, text in docs:
            w, hit, found = plain(text, items, window)
            spans, got = automaton.hits(dc.words(text.encode()))
            assert [x.encode() for x in w] == dc.words(text.encode())
            assert {p for a, b in spans for p in range(a, b)} == hit and got == found


def test_blocks_of_items_give_the_same(spark):
    docs, items = made(99)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id string, text string")
    one = dc.decontaminate(d, b, window=4).orderBy("doc_id").collect()
    many = dc.decontaminate(d, b, window=4, block_words=30).orderBy("doc_id").collect()
    assert one == many
    for (_, text), r in zip(docs, one):
        w, hit, found = plain(text, items, 4)
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (len(w), len(hit), len(found))
        assert r["items_sha256"] == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert {p for s in r["spans"] for p in range(s["first_word"], s["first_word"] + s["words"])} == hit
        assert plain_words(r["clean_text"]) == [x for i, x in enumerate(w) if i not in hit]


def test_blocks_keep_the_same_rows(spark, odd):
    docs, items = made(7)
    d = spark.createDataFrame(docs + [(None, docs[0][1]), (3, None), (3, None)], "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id string, text string")
    one = sorted(map(str, dc.keep_clean(d, b, window=6).collect()))
    assert one == sorted(map(str, dc.keep_clean(d, b, window=6, block_words=25).collect()))
    dirty = {i for i, t in docs if plain(t, items, 6)[1]}
    assert 0 < len(dirty) and not {f"Row(doc_id={i}, text={t!r})" for i, t in docs if i in dirty} & set(one)
    kept = dc.keep_clean(odd, b, window=6, block_words=25)
    assert kept.columns == odd.columns and kept.count() == odd.count()


def test_long_items_are_cut_into_parts(spark):
    """One item longer than a block, given twice."""
    rng = random.Random(1)
    item = [f"w{rng.randrange(400)}" for _ in range(700)]
    docs = [(k, " ".join(["zz"] + item[k * 13:k * 13 + rng.randint(2, 40)] + ["zz"])) for k in range(50)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([("long", " ".join(item))] * 2 + [("none", None), ("blank", " ")],
                              "item_id string, text string")
    one = dc.decontaminate(d, b).orderBy("doc_id").collect()
    assert one == dc.decontaminate(d, b, block_words=60).orderBy("doc_id").collect()
    for (_, text), r in zip(docs, one):
        w, hit, found = plain(text, [("long", " ".join(item))], 10)
        assert (r["n_hit"], r["n_items"]) == (len(hit), len(found))


def test_removal_limits(spark):
    d = spark.createDataFrame([(1, "x y one two three four five z"), (2, "one two three four five"), (3, "q")],
                              "doc_id long, text string")
    b = spark.createDataFrame([("t", "one two three four five")], "item_id string, text string")
    out = {r["doc_id"]: r for r in dc.decontaminate(d, b, window=5, max_coverage=0.8).collect()}
    assert out[1]["clean_text"] == "x y  z" and out[1]["spans"][0]["first_word"] == 2
    assert out[2]["removed"] and out[2]["clean_text"] is None and out[3]["clean_text"] == "q"
    long_only = {r["doc_id"]: r for r in dc.decontaminate(d, b, window=5, max_span=5).collect()}
    assert long_only[1]["clean_text"] == "x y one two three four five z"
    none = {r["doc_id"]: r["removed"] for r in dc.decontaminate(d, b, window=5, max_coverage=0.0).collect()}
    assert none == {1: True, 2: True, 3: False}


def test_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame([("a", "cat sat on the mat"), ("a", None), (None, "é"), ("c", "")],
                                  "item_id string, text string")
    rows = dc.decontaminate(odd, items).collect()
    assert len(rows) == odd.count()
    hits = {(r["doc_id"], tuple(r["items"])) for r in rows if r["contaminated"]}
    assert hits == {(1, ("a",)), (2, ("a",)), (9, ("null",))}
    assert all(r["n_words"] == 0 for r in rows if r["doc_id"] in (3, 4, 5))
    assert dc.decontaminate(nothing, items).collect() == []
    empty = dc.decontaminate(odd, items.limit(0)).collect()
    assert len(empty) == odd.count() and not any(r["contaminated"] for r in empty)


def test_query_equals_sql(spark, small_dir):
    sql = oracle.ORACLES["op2_benchmark_decontamination"]
    got = spark_rows(queries.op2_benchmark_decontamination(spark, small_dir))
    assert compare(got, duck_rows(duck(small_dir), sql)) == []

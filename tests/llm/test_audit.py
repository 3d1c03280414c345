import random
import re
from itertools import permutations

from tests.oracle_harness import compare, duck, duck_rows, spark_rows
from windowlens.llm import audit, queries
from windowlens.llm.oracle import ORACLES

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def plain(docs, labels, names="ABCDE"):
    """The filters applied one after the other, order by order."""
    marks = {}
    for d, q, t in labels:
        if d is not None:
            old = marks.get(d, (0, 0))
            marks[d] = (max(old[0], int(q == 1)), max(old[1], int(t == 1)))
    rows = []
    for d, text, part in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)),
                 "E": d is not None and any(x is not None and x < d and (y or "") == t for x, y, _ in docs)}
        rows.append((part or "", {f for f in names if fails[f]}, *marks.get(d, (0, 0))))
    out = {}
    for part in {r[0] for r in rows}:
        shapley = dict.fromkeys(names, 0)
        for order in permutations(names):
            left, gone = [r for r in rows if r[0] == part], []
            for step, f in enumerate(order, 1):
                now = [r for r in left if f in r[1]]
                shapley[f] += len(now)
                redundant = sum(f in r[1] for r in gone)
                left, gone = [r for r in left if f not in r[1]], gone + now
                out[part, "".join(order), step] = [
                    len(left), len(now), redundant, sum(r[0] == part and r[1] == {f} for r in rows),
                    sum(r[2] for r in now), sum(r[3] for r in now)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def got(df):
    rows = df.collect()
    out = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in COUNTS) for r in rows}
    assert len(out) == len(rows)
    return out


def tables(spark, docs, labels):
    return (spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_equals_filters_in_sequence(spark):
    rng = random.Random(2)
    docs = []
    for i in range(400):
        n = rng.choice([0, 20, 199, 200, 260])
        w = rng.choices([f"w{j}" for j in range(rng.choice([60, 2000]))], k=n)
        if rng.random() < 0.3:
            w = [x.upper() for x in w]
        if rng.random() < 0.3:
            w.append("50%")
        docs.append((i, " ".join(w), rng.choice(["a", "a", "b", "", None])))
    docs += [(400 + i, docs[rng.randrange(400)][1], rng.choice("ab")) for i in range(120)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in rng.sample(range(520), 300)]
    assert got(audit.interactions(*tables(spark, docs, labels))) == plain(docs, labels)


def test_hot_copies(spark):
    """Half of all rows share one text, a third one id."""
    docs = [(i, "the same text", "a") for i in range(300)] + [(5, f"text {i}", "b") for i in range(200)] \
        + [(None, "the same text", None)] * 50
    labels = [(i, 1, i % 2) for i in range(0, 300, 3)] + [(5, 1, 1), (5, 0, None), (None, 1, 1)]
    assert got(audit.interactions(*tables(spark, docs, labels))) == plain(docs, labels)


def test_other_filters(spark):
    docs = [(i, "x" * (i % 7), "p") for i in range(50)]

    def filters(text):
        return ["S"] * (text == b"") + ["L"] * (b"xxxx" in text)
    found = got(audit.interactions(*tables(spark, docs, []), filters=filters, repeated=None, names="SL"))
    assert found == {("p", "SL", 1): (42, 8, 0, 8, 0, 0, 16), ("p", "SL", 2): (21, 21, 0, 21, 0, 0, 42),
                     ("p", "LS", 1): (29, 21, 0, 21, 0, 0, 42), ("p", "LS", 2): (21, 8, 0, 8, 0, 0, 16)}


def test_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, None), (None, 1, 1), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    docs = [(r["doc_id"], r["text"], r["source"]) for r in odd.collect()]
    assert got(audit.interactions(odd, labels)) == plain(docs, [tuple(r) for r in labels.collect()])
    assert audit.interactions(nothing, labels).collect() == []


def test_nothing_fails(spark):
    docs = [(i, " ".join(f"w{j}x{i}" for j in range(220)), "p") for i in range(4)]
    rows = got(audit.interactions(*tables(spark, docs, [(1, 1, 1)])))
    assert len(rows) == 600 and set(rows.values()) == {(4, 0, 0, 0, 0, 0, 0)}


def test_query_matches_sql_twin(spark, small_dir):
    name = "op13_filter_audit"
    problems = compare(spark_rows(queries.QUERIES[name](spark, small_dir)), duck_rows(duck(small_dir), ORACLES[name]))
    assert not problems, problems

import random

import numpy as np

from windowlens.llm import queries, substring


def ends(text):
    data = np.frombuffer(text, np.uint8)
    return substring.borders(data, [0], [len(text)])[0]


def plain_ends(text, low=substring.MIN_CHUNK, high=substring.MAX_CHUNK, bits=substring.CUT_BITS):
    """Byte by byte with a rolling state."""
    out, last, h = [], 0, 0
    for i, b in enumerate(text):
        window = text[max(0, i - 15):i + 1]
        h = 0
        for x in window:
            h = (h << 1) + int(substring._GEAR[x]) & 0xFFFFFFFF
        at = i + 1
        while at - last > high:
            last += high
            while text[last] & 0xC0 == 0x80:
                last -= 1
            out.append(last)
        if at < len(text) and at - last >= low and h >> (32 - bits) == 0 and text[at] & 0xC0 != 0x80:
            out.append(at)
            last = at
    return out + [len(text)] * (len(text) > 0)


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefgéß", k=rng.randint(2, 9))) for _ in range(n))


def test_borders_equal_the_rolling_hash():
    rng = random.Random(3)
    for n in (0, 1, 5, 200):
        text = words(rng, n).encode()
        assert ends(text) == plain_ends(text)
    same = ("é" * 3000).encode()
    assert ends(same) == plain_ends(same) and max(np.diff([0, *ends(same)])) <= substring.MAX_CHUNK
    both = b"".join([same, b"", words(rng, 90).encode()])
    assert substring.borders(np.frombuffer(both, np.uint8), [0, len(same), len(same)],
                             [len(same), len(same), len(both)])[2][-1] == len(both)


def test_an_insertion_moves_few_borders():
    rng = random.Random(8)
    text = words(rng, 600)
    more = text[:900] + " inserted words " + text[900:]
    a, b = text.encode(), more.encode()
    chunks = [{t[x:y] for x, y in zip([0, *e], e)} for t, e in ((a, ends(a)), (b, ends(b)))]
    assert len(chunks[0] - chunks[1]) <= 3


def test_the_text_before_moves_no_border():
    rng = random.Random(5)
    texts = [words(rng, rng.randint(0, 12)).encode() for _ in range(300)]
    last = np.cumsum([len(t) for t in texts])
    found = substring.borders(np.frombuffer(b"".join(texts), np.uint8), [0, *last[:-1].tolist()], last.tolist())
    for t, begin, f in zip(texts, [0, *last[:-1].tolist()], found):
        assert [e - begin for e in f] == ends(t) == plain_ends(t)


def test_no_passage_of_51_words_is_missed(spark):
    """Each passage in two documents, between words of their own."""
    rng = random.Random(51)
    prose = [" ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 8))) for _ in range(51)) for _ in range(1000)]
    docs = [(2 * i + j, f"{words(rng, 30)} {p} {words(rng, 30)}") for i, p in enumerate(prose) for j in (0, 1)]
    rows = substring.repeated_spans(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in rows} == set(range(1, 2000, 2))
    text = dict(docs)
    for r in rows:
        cut = text[r["doc_id"]].encode()[r["start"]:r["start"] + r["size"]]
        assert r["first_doc_id"] == r["doc_id"] - 1 and cut.decode() in text[r["first_doc_id"]]


def test_passages_are_found_and_cut(spark):
    rng = random.Random(11)
    passage = words(rng, 60)
    docs = [(i, words(rng, rng.randint(40, 200))) for i in range(60)]
    hit = set(range(5, 60, 6))
    docs = [(i, t[:57] + " " + passage + " " + t[57:] if i in hit else t) for i, t in docs]
    docs += [(100, docs[7][1]), (101, None), (102, "")]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    spans = substring.repeated_spans(table)
    rows = spans.collect()
    assert {r["doc_id"] for r in rows} == (hit - {5}) | {100}
    assert all(r["first_doc_id"] == (7 if r["doc_id"] == 100 else 5) and r["n_words"] >= 20 for r in rows)
    text = dict(docs)
    for r in rows:
        cut = text[r["doc_id"]].encode()[r["start"]:r["start"] + r["size"]]
        assert cut.decode() in text[r["first_doc_id"]]
    left = {r["doc_id"]: r["text"] for r in substring.without_repeats(table, spans).collect()}
    assert len(left) == len(docs) and left[101] is None and left[100] == ""
    for i, t in docs[:60]:
        lost = len((t or "").encode()) - len(left[i].encode())
        assert lost == sum(r["size"] for r in rows if r["doc_id"] == i)


def test_a_passage_in_very_many_documents(spark):
    rng = random.Random(2)
    passage = words(rng, 60)
    docs = [(i, f"{words(rng, 30)} {passage} {words(rng, 30)}") for i in range(400)]
    rows = substring.repeated_spans(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in rows} == set(range(1, 400)) and {r["first_doc_id"] for r in rows} == {0}


def test_the_filter_stops_no_repeated_chunk(spark, prose):
    """Small filters let more single chunks pass; spans stay the same."""
    table = spark.createDataFrame(prose, "doc_id long, text string").repartition(5)
    rows = [tuple(r) for r in substring.chunks(table).collect()]
    times = {}
    for r in rows:
        times[r[-2:]] = times.get(r[-2:], 0) + 1
    passed = {}
    for bits in (27, 12):
        passed[bits] = {tuple(r) for r in substring.chunks(table, filter_bits=bits).collect()}
        assert {r for r in rows if times[r[-2:]] > 1} <= passed[bits] <= set(rows)
    assert len(passed[27]) < len(passed[12])
    spans = [sorted(tuple(r) for r in substring.repeated_spans(table, filter_bits=b).collect()) for b in (None, 27, 12)]
    assert spans[0] == spans[1] == spans[2] != []


def test_odd_rows(odd, nothing):
    rows = substring.repeated_spans(odd).collect()
    assert {r["doc_id"] for r in rows} <= {7}          # the long text repeats itself
    assert substring.repeated_spans(nothing).collect() == []


def test_query_equals_chunk_counts(spark, small_dir):
    """Brute force: chunks in document order, spans of chunks seen before."""
    from windowlens.sources.tables import read_table

    docs = sorted((r["doc_id"], (r["text"] or "").encode()) for r in read_table(spark, small_dir, "documents").collect())
    first, want = {}, set()
    for doc, text in docs:
        run, at = [], 0
        for e in ends(text):
            chunk, here = text[at:e], (doc, at)
            at = e
            if first.setdefault(chunk, here) == here:
                _close(run, doc, text, want)
                run = []
            else:
                run.append((here[1], e))
        _close(run, doc, text, want)
    got = {(r["doc_id"], r["start"], r["size"]) for r in queries.op3_substring_dedup(spark, small_dir).collect()}
    assert got == want and want


def _close(run, doc, text, want):
    if run and sum(_words(text, a, b) for a, b in run) >= substring.MIN_WORDS:
        want.add((doc, run[0][0], run[-1][1] - run[0][0]))


def _words(text, a, b):
    space = b" \t\n\r\x0b\x0c"
    return sum(text[i] not in space and (i == 0 or text[i - 1] in space) for i in range(a, b))

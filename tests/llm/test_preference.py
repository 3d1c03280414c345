import random

import numpy as np
from tokenizers import Tokenizer

from windowlens.llm import preference, queries
from windowlens.sources.tables import read_table

TURNS = "conv_id long, turn long, role string, text string, `prompt` int, `TEXT_` string"


def pairs(spark, rows):
    return spark.createDataFrame(rows, "pair_id long, chosen array<struct<role:string,text:string>>, "
                                       "rejected array<struct<role:string,text:string>>, n_common string")


def shown(turns):
    return "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in turns)


def test_prefix_is_rendered_once(spark):
    u, a, b = ("user", "hi"), ("assistant", "yes"), ("assistant", "no <|end|>")
    cases = [([u, a], [u, b]), ([u, a], [u, a]), ([u, a], [u, a, u, b]), ([], [u]), ([a], [b]), (None, [u, a]),
             ([u, ("user", "yes")], [u, a])]
    rows = preference.format_pairs(pairs(spark, [(i, c, r, "x") for i, (c, r) in enumerate(cases)]),
                                   queries.CHAT_TOKENIZER).collect()
    tokenizer = Tokenizer.from_file(queries.CHAT_TOKENIZER)
    for row, (c, r) in zip(sorted(rows, key=lambda x: x["pair_id"]), cases):
        c, r = c or [], r or []
        n = 0
        while n < min(len(c), len(r)) and c[n] == r[n]:
            n += 1
        assert row["n_common"] == n and row["prompt"] == shown(c[:n])
        assert row["chosen"] == shown(c[n:]) and row["rejected"] == shown(r[n:])
        for side, turns in (("chosen", c), ("rejected", r)):
            ids, mask = row[f"{side}_ids"], row[f"{side}_mask"]
            assert tokenizer.decode(row["prompt_ids"] + ids, skip_special_tokens=False) == shown(turns)
            assert len(ids) == len(mask)
            scored = "".join(t + "<|end|>\n" for role, t in turns[n:] if role == "assistant")
            assert tokenizer.decode([x for x, m in zip(ids, mask) if m], skip_special_tokens=False) == scored
        assert row["usable"] == all(any(x == "assistant" for x, _ in side[n:]) for side in (c, r))


def test_conversations_and_answers(spark):
    rows = [(1, 1, "assistant", "b", 0, ""), (1, 0, "user", "a", 0, ""), (1, 0, "user", "a", 0, ""),
            (2, 0, None, None, 0, ""), (None, 0, "user", "lost", 0, ""), (3, 0, "assistant", "c", 0, ""),
            (3, None, "system", "s", 0, "")]
    table = spark.createDataFrame(rows, TURNS).withColumnRenamed("TEXT_", "TEXT")
    convs = preference.conversations(table)
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in convs.collect()}
    assert got == {1: [("user", "a"), ("assistant", "b")], 2: [("", "")],
                   3: [("system", "s"), ("assistant", "c")]}
    for parts in (1, 50):
        check_answers({r["pair_id"]: r for r in preference.replaced_answers(convs, parts).collect()})
    none = preference.conversations(table.limit(0))
    assert preference.format_pairs(preference.replaced_answers(none), queries.CHAT_TOKENIZER).collect() == []


def check_answers(made):
    assert [tuple(t) for t in made[1]["rejected"]] == [("user", "a"), ("assistant", "c")]
    assert [tuple(t) for t in made[3]["rejected"]] == [("system", "s"), ("assistant", "b")]
    assert made[2]["rejected"] == made[2]["chosen"]


def test_query(spark, small_dir):
    turns = {}
    for r in read_table(spark, small_dir, "conversations").orderBy("conv_id", "turn").collect():
        turns.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    rows = queries.op8_preference_formatting(spark, small_dir).collect()
    assert {r["conv_id"] for r in rows} == set(turns) and len(rows) == len(turns)
    for r in rows:
        own = turns[r["conv_id"]]
        assert r["chosen"] == shown(own[r["n_common"]:])
        last = max((i for i, t in enumerate(own) if t[0] == "assistant"), default=len(own))
        assert r["n_common"] in (last, len(own))
    assert sum(r["usable"] for r in rows) == sum(any(x == "assistant" for x, _ in t) for t in turns.values())


def test_ids_equal_the_whole_tokenizer():
    whole = Tokenizer.from_file(queries.CHAT_TOKENIZER)
    whole.encode_special_tokens = True
    own = preference.ByteLevelTokenizer(queries.CHAT_TOKENIZER)
    rng = random.Random(3)
    bits = ["a", "Word", " ", "  ", "\n", "\t", "\r\n", "é", "ß", "x²", "'s", "'LL", "12½", "<|end|>", "<|endoftext|>",
            "你好", "\U0001f600", "\x1c", "\x85", "\xa0", "　", "é", "​", "¿que?", "-", "×", "", " x", "y "]
    texts = ["", " ", "\n", " a", "a ", "a  b", "a\n b", "a \nb", "a" * 3000, "plain words in a row.<|end|>\n"]
    texts += ["".join(rng.choices(bits, k=rng.randint(1, 12))) for _ in range(3000)]
    texts += [" ".join(rng.choices(bits, k=rng.randint(1, 12))) for _ in range(3000)]
    for text in texts + texts[:200]:
        assert np.frombuffer(own(text), np.int32).tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_text_without_blanks_does_not_fill_the_caches(monkeypatch):
    monkeypatch.setattr(preference, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(preference, "WORD_BYTES", 20_000)
    own = preference.ByteLevelTokenizer(queries.CHAT_TOKENIZER)
    for i in range(300):
        own(f"start {'你好吗' * 300}{i} mid{i}dle {'x' * 500}{i} end")
        assert own.chunks.held <= 20_000 and own.words.held <= 20_000
        assert all(len(k) <= 256 for k in own.chunks) and all(len(k) <= 256 for k in own.words)


def test_long_and_repeated_conversations(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"turn {i} " * 50, 0, "") for i in range(400)]
    rows = rows * 3 + [(2, 0, "assistant", "z" * 100_000, 0, "")] * 50 + [(2, 0, "user", "u", 0, "")]
    table = spark.createDataFrame(rows, TURNS).repartition(7)
    made = {r["pair_id"]: r for r in preference.format_pairs(
        preference.replaced_answers(preference.conversations(table)), queries.CHAT_TOKENIZER).collect()}
    assert made[1]["n_common"] == 399 and made[1]["chosen"] == shown([("assistant", "turn 399 " * 50)])
    assert made[1]["rejected"] == shown([("assistant", "z" * 100_000)])
    assert made[2]["n_common"] == 0 and made[2]["rejected"] == shown([("assistant", "turn 399 " * 50), ("user", "u")])
    assert len(made) == 2 and made[1]["usable"] and sum(made[2]["chosen_mask"]) > 0


def test_donors_are_a_cycle(spark):
    rows = [(i, 0, "assistant", str(i), 0, "") for i in range(100)]
    convs = preference.conversations(spark.createDataFrame(rows, TURNS))
    for parts in (1, 7, 500):
        donor = {r["conv_id"]: r["donor"] for r in preference.donors(convs, parts).collect()}
        assert sorted(donor) == sorted(donor.values()) == list(range(100))
        assert all(a != b for a, b in donor.items())

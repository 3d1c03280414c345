import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `Text` string, `kept` int, `key` string"

LONG = " ".join(f"word{i % 977} tail{i % 31}" for i in range(30_000))


def odd_rows():
    """Nulls in every column, empty and blank texts, a very long one, ties,
    repeated rows, characters outside ASCII."""
    return [
        (1, "The cat sat on the mat and looked at the moon.", "en", "a", 46, "x", 1, "k"),
        (2, "the CAT sat on the mat and looked at the moon.", "en", "a", 46, "x", 1, "k"),
        (2, "the CAT sat on the mat and looked at the moon.", "en", "a", 46, "x", 1, "k"),
        (3, None, None, None, None, None, None, None),
        (4, "", "en", None, 0, "y", 0, "k"),
        (5, "   \n\t ", "fr", "b", 6, "y", 0, None),
        (None, "Un chat était sur le toit de la maison, très loin.", "fr", "b", 50, None, None, None),
        (None, None, None, None, None, None, None, None),
        (6, "12345 --- 67 ¿?", None, "c", 14, None, 2, "z"),
        (7, LONG, "en", "c", len(LONG), None, 2, "z"),
        (8, "É", "fr", "c", 1, None, 2, "z"),
        (9, "é", "fr", "c", 1, None, 2, "z"),
        (10, "Ein Hund läuft über die Straße, 你好 \U0001f600 é H̱", "de", "d", 40, None, 2, "z"),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return _frame(spark, odd_rows())


@pytest.fixture(scope="session")
def nothing(spark):
    return _frame(spark, [])


def _frame(spark, rows):
    """The last three columns clash with names the operators use, one of them
    in case only."""
    return spark.createDataFrame(rows, SCHEMA.replace("`Text`", "`Text_`")).withColumnRenamed("Text_", "TEXT")


@pytest.fixture(scope="session")
def prose():
    """Random texts with exact and near copies."""
    rng = random.Random(5)
    vocabulary = [f"{a}{b}" for a in ("ba", "co", "du", "fe", "gi", "lo") for b in ("n", "rt", "sk", "m", "pel", "x")]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 120))) for _ in range(150)]
    for _ in range(150):
        words = rng.choice(texts).split()
        for _ in range(rng.randint(0, 3)):
            if words:
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    return [(i, t) for i, t in enumerate(texts)]

import random

import pytest

from tests.conftest import SF_MID

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "x string, stats string, __stats string, tokens string, start string, toxic string")


def prose(seed: int, n: int, words: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"{r.choice('bcdfglmnprst')}{r.choice('aeiou')}{r.choice('lmnrst')}{r.randrange(words) % 97}x".replace("0", "o")
                    for _ in range(n))


@pytest.fixture(scope="session")
def sf_dir():
    return SF_MID


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows."""
    base = prose(1, 120)
    words = base.split()
    near = " ".join(words[:60] + ["changed"] + words[61:])
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"), (3, near, "en", "b"),
        (4, None, "en", "a"), (5, "", None, None), (6, " \n\t ", "de", None), (None, prose(2, 40), "de", "a"),
        (None, base, None, "b"), (7, "Two words", "en", "a"), (8, "two WORDS", "en", "a"),
        (9, prose(3, 30_000), "en", "hot"), (10, "a b c d e", "fr", "c"), (11, "A B C D E", "fr", "c"),
        (12, "é ü 日本語 😀 ß İ", "fr", "c"), (13, "12 34 !! --", "fr", "c"),
        (14, "mail joe@example.com or +1 (555) 123-4567 from 10.0.0.1 card 4111 1111 1111 1111 end", "en", "a"),
        (15, base.upper(), "en", "a"),
    ]
    return [(*r, len(r[1] or ""), "c", "c", "c", "c", "c", "c") for r in rows]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)

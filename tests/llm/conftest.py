"""Documents with everything that may go wrong: nulls, empty and long texts, repeated rows, clashing columns."""

import pytest

WORDS = "the quick brown fox jumps over a lazy dog while seven wise owls watch from old oak trees near quiet lakes".split()


def prose(n, step=7, start=0):
    """n words in which few runs repeat."""
    return " ".join(f"{WORDS[(start + i * step) % len(WORDS)]}{(start + i * i) % 97 + 100 * (i // 90)}" for i in range(n))


LONG = prose(60_000, 5)
ODD = [
    (1, prose(120), "x"),
    (2, prose(120), "x"),
    (2, prose(120), "x"),
    (3, prose(120).upper(), None),
    (4, "", "x"),
    (5, None, "x"),
    (6, " \t\n ", "x"),
    (7, "one", None),
    (None, prose(80, 3, 5), "x"),
    (None, None, None),
    (8, LONG, "x"),
    (9, prose(40, 3, 50) + " " + prose(120) + " " + prose(40, 3, 90), "x"),
    (10, "a a a a a a " * 30, "x"),
    (11, "é ü ñ 漢字 😀 <|endoftext|> it's 12 34\x00 ok", "x"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """doc_id, text and columns named like the operators' own."""
    return spark.createDataFrame(
        [(i, t, s, 1, "c", 2) for i, t, s in ODD],
        "doc_id long, text string, source string, n_words int, component_id string, fp int",
    )


@pytest.fixture(scope="session")
def none(spark, odd):
    return spark.createDataFrame([], odd.schema)

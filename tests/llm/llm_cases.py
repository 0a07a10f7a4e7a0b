"""Documents that tests of this folder share."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block int, key string, fp int, rank string, start int, word string, shard string, size int, row int, leaves string, d0 int"


def documents(spark, rows):
    """Documents (doc_id, text[, lang, source]) with extra columns named like the operators' own."""
    full = [(*r, *("en", "s")[len(r) - 2 :], None if r[1] is None else len(r[1]), 1, "k", 2, "r", 3, "w", "x", 4, 5, "l", 6) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


WORDS = "the of and to in is on that with as it for was at by an be this from are".split()


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    made = [draw.choice(WORDS) if draw.random() < 0.5 else "".join(draw.choice("abcdefgh") for _ in range(draw.randint(3, 7))) for _ in range(n)]
    return " ".join(w + ("." if i % 11 == 10 else "") for i, w in enumerate(made))


def odd_rows():
    """Null, empty, very long, repeated and tied documents."""
    long_text = prose(1, 30_000)
    passage = prose(2, 60)
    return [
        (5, prose(3, 80)), (1, None), (2, ""), (3, " \n\t "), (None, prose(4, 50)), (7, prose(5, 40)), (7, prose(5, 40)),
        (8, prose(6, 30) + " " + passage + " " + prose(7, 30)), (9, passage), (10, prose(8, 25) + "\n" + passage.replace(" ", "  ")),
        (11, prose(3, 80)), (12, "one"), (13, "x" * 5000), (14, long_text), (15, "É ß İ ﬁ 你好 🙂  a b \x00 \x1c z"), (16, "a a a a " * 40),
        (17, None), (18, "Line one is here\n\nLine one is here\nLine one is here"), (9, "another text under nine"),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return documents(spark, odd_rows()).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return documents(spark, [])

"""Small documents with every odd case: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, digest string, n bigint"


def sentence(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


@pytest.fixture(scope="session")
def words():
    rng = random.Random(1)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(3000)]


@pytest.fixture(scope="session")
def odd_rows(words):
    rng = random.Random(2)
    rows = [(k, sentence(rng, rng.randrange(20, 120), words), rng.choice(["en", "de"]), f"src{k % 4}") for k in range(60)]
    rows += [(100 + k, rows[k][1], "en", "src0") for k in range(10)]  # copies
    rows += [(200 + k, rows[20 + k][1] + " tail", "en", "src1") for k in range(10)]  # near copies
    rows += [(300, None, None, None), (301, "", "en", "src1"), (302, None, "de", "src2"), (None, "no id here at all", None, "src3"), (None, rows[3][1], "en", "src3")]
    rows += [rows[5], rows[5]]  # repeated rows
    rows += [(400, sentence(rng, 30_000, words), "en", "src2"), (401, "x" * 60_000, "en", "src2"), (402, "ünïcode 日本語 🙂 word " * 3, "de", "src😀")]
    return [(i, t, lang, src, None if t is None else len(t), 0.5, "own", 7) for i, t, lang, src in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)

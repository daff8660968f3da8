import random

import pytest

from ferrylog.llm.common import prepare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, equal rows, equal ids, near copies."""
    rng = random.Random(4)
    base = sentence(rng, 300)
    near = base.split(" ")
    near[40], near[200] = "changed", "words"
    long = sentence(rng, 30_000)
    rows = [
        (1, base, "en", "b", 1),
        (2, " ".join(near), "en", None, 2),
        (3, base, "en", "a", 3),
        (3, base, "en", "a", 3),
        (4, None, None, None, None),
        (5, "", "en", "c", 0),
        (6, " \n\t ", "en", "c", 0),
        (None, sentence(rng, 80), "en", "a", 5),
        (7, long, "en", "b", 6),
        (8, "tiny", "en", "b", 6),
        (8, "tiny text", "en", "b", 6),
        (9, "x" * 5_000, "en", "d", 6),
        (10, "so " * 4_000, "en", "d", 6),
        (11, "Überraschung 漢字 😀 <|endoftext|> <s> ▁x  y", "de", "d", 6),
    ]
    rows += [(100 + k, sentence(rng, 60), "en", rng.choice("abcd"), k) for k in range(60)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return prepare(spark).createDataFrame(odd_rows, SCHEMA).repartition(4).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return prepare(spark).createDataFrame([], SCHEMA)


def rows_of(df, *names):
    """Rows as sorted tuples, nulls first."""
    found = [tuple(r) for r in df.select(*names).collect()]
    return sorted(found, key=lambda r: [(x is not None, x if x is not None else 0) for x in r])

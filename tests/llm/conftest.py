import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rank int, size string, key string, words string, row string"


def odd_rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    rng = random.Random(5)
    vocab = ["alpha", "Beta", "gamma,", "delta", "über", "ñandú", "worthless", "idiot", "cc", "by", "General", "Public", "License", "all", "rights", "reserved", "x\ty", "don't"]
    some = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    common = "  This very common line is in many of the documents here \t"
    texts = [None, "", " \t\n ", "\n\n", "one", "All Rights Reserved. all rights reserved", "cc by cc by", some(3000) + "\n" + common + "\n" + some(9000)]
    texts += [some(rng.randint(1, 120)) + "\n" + (common.lower() if i % 2 else common) + "\n" + some(5) for i in range(14)]
    base = some(300)
    texts += [base, base, base + " end", base.replace("alpha", "ALPHA")]
    rows = [(i * 3, t, "en", None if i % 5 == 0 else f"s{i % 4}", None, i, "a", "b", "c", "d") for i, t in enumerate(texts)]
    rows += [(None, "a text without any id", "en", "s1", 1, 1, "a", "b", "c", "d"), (None, None, None, None, None, None, None, None, None, None)]
    return [*rows, rows[10], rows[10]]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def rows_of(df):
    return [tuple(r) for r in df.collect()]

"""The pipeline's near-dedup finds candidates by the method of op4, tiles of population counts."""

import random

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import rows_of
from tramline.llm import simhash


def test_fingerprints_alone_find_close_copies(spark, monkeypatch):
    """With least shingles that no two texts share, groups come from fingerprints within two bits."""
    rng, rows = random.Random(2), []
    for i in range(30):
        text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(1500))
        rows += [(2 * i, text), (2 * i + 1, text + f" end{i}")]
    fps = [simhash.majority(np.unique(simhash.shingle_hashes(t, 5))) for _, t in rows]
    close = {2 * i for i in range(30) if bin((fps[2 * i] ^ fps[2 * i + 1]) & (1 << 64) - 1).count("1") <= 2}
    assert len(close) >= 15
    sketches = simhash.sketches

    def apart(docs, shingle, whole=False):
        out = sketches(docs, shingle, whole)
        return out if whole else out.withColumn("keys", F.transform(F.sequence(F.lit(0), F.lit(7)), lambda k: F.xxhash64("set_id", k)))

    monkeypatch.setattr(simhash, "sketches", apart)
    got = dict(rows_of(simhash.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "least.doc_id")))
    assert {d - 1 for d, c in got.items() if d % 2 and c == d - 1} == close


def test_close_fingerprints_of_other_texts_stay_apart(spark):
    """Two-word texts have one shingle; single bits of chance don't make them copies, and wordless texts are one group."""
    rows = [(i, f"a{i} b{i}") for i in range(2000)] + [(5000, ""), (5001, " "), (5002, None)]
    got = rows_of(simhash.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "least.doc_id"))
    assert {d: c for d, c in got} == {d: min(d, 5000) for d, _ in rows}

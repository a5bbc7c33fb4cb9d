"""Python workers give memory back when a task of theirs ends."""

import pyarrow as pa
import pytest

from tramline.llm import packing, shared, simhash


class Pool:
    def __init__(self):
        self.calls = 0

    def release_unused(self):
        self.calls += 1


def test_lean_gives_memory_back_at_the_end(monkeypatch):
    pool = Pool()
    monkeypatch.setattr(pa, "default_memory_pool", lambda: pool)
    run = shared.lean(lambda batches: (b * 2 for b in batches))(iter([1, 2, 3]))
    assert next(run) == 2 and pool.calls == 0
    assert list(run) == [4, 6] and pool.calls == 1


def test_lean_gives_memory_back_after_an_error(monkeypatch):
    pool = Pool()
    monkeypatch.setattr(pa, "default_memory_pool", lambda: pool)
    with pytest.raises(ZeroDivisionError):
        list(shared.lean(lambda batches: (1 // b for b in batches))(iter([1, 0])))
    assert pool.calls == 1


def test_stages_of_the_pipeline_are_lean(spark, monkeypatch):
    """The functions that long texts pass through are given to Spark in this form."""
    seen = []
    for module in (packing, simhash):
        monkeypatch.setattr(module, "lean", lambda run, real=shared.lean: seen.append(run) or real(run))
    docs = spark.createDataFrame([(1, "a b c", 1)], "doc_id long, text string, row long")
    packing.tokens(docs, "unused")
    simhash.sketches(docs, 5)
    assert len(seen) == 2

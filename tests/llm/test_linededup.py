import hashlib
from collections import Counter, defaultdict

import pytest

from tests.llm.conftest import rows_of
from tramline.llm import linededup

LOW = {i: i + 32 for i in range(65, 91)}


def brute(rows):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOW)

    ids = lambda d: -(1 << 63) if d is None else d
    where = defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 40:
                where[key(x)].add(ids(d))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(where.get(key(x), ())) < 5 or max(where[key(x)]) == ids(d)]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("name", ["documents", "odd"])
def test_equals_brute_force(name, request):
    docs = request.getfixturevalue(name)
    want = brute(rows_of(docs.select("doc_id", "text")))
    assert Counter(rows_of(linededup.summary(docs))) == want
    assert sum(n for (_, _, dropped, _), n in want.items() if dropped) > 0


def test_runs_that_cross_partitions(spark):
    line = "the same line of more than forty characters in each document"
    rows = [(i, f"{line}\n{i} own line that nobody else has in any other document") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "31")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert Counter(rows_of(linededup.summary(docs))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_columns_and_empty(odd, empty):
    assert linededup.deduped(odd).columns == odd.columns
    assert linededup.deduped(odd, counts=("a", "b")).columns == [*odd.columns, "a", "b"]
    assert linededup.summary(empty).count() == 0
    texts = {r.doc_id: r.text for r in linededup.deduped(odd).collect() if r.doc_id is not None}
    assert texts[0] is None and texts[3] == ""


def test_ids_of_other_types(spark, odd):
    """Zero-padded texts sort like the numbers, so the same lines go."""
    name = lambda d: None if d is None else f"{d:08d}"
    rows = [(name(d), t) for d, t in rows_of(odd.select("doc_id", "text"))]
    got = linededup.summary(spark.createDataFrame(rows, "doc_id string, text string"))
    assert got.schema["doc_id"].dataType.simpleString() == "string"
    assert Counter(rows_of(got)) == Counter({(name(d), *x): n for (d, *x), n in brute(rows_of(odd.select("doc_id", "text"))).items()})

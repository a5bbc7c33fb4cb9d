"""Extra columns with every internal name, in every operator and stage, change nothing."""

import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import tramline.llm
from tests.llm.conftest import rows_of
from tramline.llm import embeddings, licenses, linededup, mixing, packing, simhash, toxicity, urls, warc, webp
from tramline.llm.queries import tokenizer_path


def internal_names():
    """Every quoted name in the package that could be a column's."""
    found = set()
    for path in Path(tramline.llm.__file__).parent.glob("*.py"):
        found |= set(re.findall(r"[\"'.](_{0,2}[a-z][a-z0-9_]{0,20})[\"']", path.read_text()))
    return sorted(found - {"doc_id", "text", "lang", "source", "n_chars", "url", "html", "page_id", "vec_id", "embedding", "label"})


@pytest.fixture(scope="module")
def more():
    return [F.lit(f"x{i}").alias(n) for i, n in enumerate(internal_names())]


def labels_of(spark):
    return spark.createDataFrame([(3 * i, i % 2, int(i % 3 == 0)) for i in range(15)], "doc_id long, quality int, toxic int")


BY_ID = {
    "licenses": licenses.scan,
    "mixing": mixing.mixed,
    "simhash": simhash.near_duplicates,
    "webp": webp.columns,
    "lines": linededup.summary,
    "packing": lambda d: packing.packed(d, tokenizer_path()).drop("sequence_id", "offset"),
    "toxicity": lambda d: toxicity.judge(d, labels_of(d.sparkSession)),
}
KEEPING = {
    "clean": lambda d: toxicity.clean(d, labels_of(d.sparkSession)),
    "deduped": linededup.deduped,
    "one of similar": simhash.one_of_similar,
    "one of each": simhash.one_of_each,
}


@pytest.mark.parametrize("name", BY_ID)
def test_results_by_document(odd, more, name):
    plain = odd.select("doc_id", "text", "lang", "source", "n_chars")
    key = lambda df: Counter(map(str, rows_of(df)))
    assert key(BY_ID[name](plain.select("*", *more))) == key(BY_ID[name](plain))


@pytest.mark.parametrize("name", KEEPING)
def test_rows_with_their_columns(odd, more, name):
    plain = odd.select("doc_id", "text", "lang", "source", "n_chars")
    wide = plain.select("*", *more)
    got = KEEPING[name](wide)
    assert got.columns == wide.columns
    base = ["doc_id", "text", "source"]
    assert Counter(rows_of(got.select(base))) == Counter(rows_of(KEEPING[name](plain).select(base)))
    assert got.where(" OR ".join(f"`{n}` <> 'x{i}'" for i, n in enumerate(internal_names()))).count() == 0


def test_mixed_documents(odd, more):
    wide = odd.select("doc_id", "text", "lang", "source", "n_chars", *more)
    got = mixing.mixed_documents(wide)
    assert got.columns == wide.columns
    assert Counter(r.doc_id for r in got.collect())[6] == Counter(r.doc_id for r in mixing.mixed_documents(odd).collect())[6]


def test_other_tables(spark, more):
    pages = spark.createDataFrame([(i, f"http://a.example.com/en/{i % 7}", "<p>x</p>") for i in range(12)] + [(5, None, None)], "page_id long, url string, html string")
    vectors = spark.createDataFrame([(i, [1.0, float(i % 4), 0.5]) for i in range(12)] + [(3, None)], "vec_id long, embedding array<double>")
    for run, table in ((urls.judge, pages), (lambda p: warc.derive(warc.responses_of_pages(p), keep=("page_id",)), pages), (embeddings.near_duplicates, vectors)):
        assert Counter(map(str, rows_of(run(table.select("*", *more))))) == Counter(map(str, rows_of(run(table))))
        assert run(table.limit(0)).count() == 0

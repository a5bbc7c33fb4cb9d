import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import rows_of
from tramline.llm import embeddings, licenses, toxicity, urls, warc, webp


def words_of(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


@pytest.mark.parametrize("name", ["documents", "odd"])
def test_license_phrases(name, request):
    docs, want = request.getfixturevalue(name), []
    for d, t in rows_of(docs.select("doc_id", "text")):
        w, at, labels = words_of(t), [], set()
        for phrase, label in licenses.BASE.items():
            p = phrase.split()
            found = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
            at += found
            labels |= {label} if found else set()
        want.append((d, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))))
    got = licenses.scan(docs)
    assert Counter(rows_of(got.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"))) == Counter(want)
    assert got.where("score < 0 OR score > 1 OR (n_base > 0 AND score < 1)").count() == 0


def test_license_notice_with_insertions(spark, empty):
    text = dict((b, a) for a, b in [(p, n) for n, p in licenses.NOTICES])
    bsd = next(p for n, p in licenses.NOTICES if n == "bsd").split()
    rows = [(1, " ".join(bsd)), (2, " ".join([*bsd[:8], "extra", *bsd[8:]])), (3, " ".join(bsd[:8]))]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].labels == got[2].labels == "bsd" and got[1].score == 1 and got[3].labels == "" and 0 < got[3].score < 0.8
    assert text and licenses.scan(empty).count() == 0


def test_url_rules_and_aliases(spark):
    link = '<head><link rel="canonical" href="{}"></head>'
    rows = [(1, "https://A.example.com/en/1?x#y", None), (2, "http://b.example.com/en/77", ""), (3, "http://x.org/fr/9", link.format("https://a.example.com/en/1#top")), (4, "http://x.org/fr/10", link.format("9?from=10")), (5, None, link.format("http://x.org/fr/9")), (6, "no scheme", None), (7, "http://y.org/fr/1", link.format("//b.example.com/en/77")), (8, "http://y.org/fr/2", link.format("/fr/1")), (9, "http://com.example.evil/en/1", None), (1, "https://A.example.com/en/1?x#y", None), (10, "http://y.org/fr/3", link.format("mailto:a@b") + link.format("#x"))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in urls.judge(pages).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("a.example.com", "/en/1", "com/en/", "block")
    assert got[2].rule == "example.com/en/7" and got[2].verdict == "allow"
    assert [got[i].verdict for i in (3, 4)] == ["block", "block"] and got[4].component == got[1].component
    assert (got[5].host, got[5].path, got[5].verdict) == ("", "", "allow") and got[6].verdict == "allow"
    assert got[7].verdict == got[8].verdict == "allow" and got[8].component == got[2].component and got[9].rule is None
    assert len({got[i].component for i in (9, 10)} | {got[8].component}) == 3
    assert urls.judge(pages.limit(0)).count() == 0
    many = [*urls.RULES, *(("block", f"host{i}.example/") for i in range(300))]
    assert Counter(rows_of(urls.judge(pages, many))) == Counter(rows_of(urls.judge(pages)))
    guessed = spark.createDataFrame([(1, "http://www.x.org/a.html", None), (2, "http://x.org/a/", None)], "page_id long, url string, html string")
    assert [urls.judge(guessed, forms=f).select("component").distinct().count() for f in (False, True)] == [2, 1]


def test_redirects_equal_a_closure(spark):
    """Chains, stars, cycles and a very long url, against plain union-find."""
    rng = random.Random(4)
    hosts = [f"h{i}.example.{t}" for i in range(40) for t in ("com", "net", "fr")]
    places = [f"{rng.choice(hosts)}/{rng.choice(['en', 'de', 'es', 'fr'])}/{rng.randrange(90)}" for _ in range(500)] + ["long.fr/" + "x" * 50_000]
    pairs = [(a, b) for a, b in zip(places[:60], places[1:61])] + [(places[100], x) for x in places[101:140]] + [(places[200 + i], places[200 + (i + 1) % 9]) for i in range(9)]
    pairs += [tuple(rng.sample(places, 2)) for _ in range(80)] + [("gone.fr/1", places[-1]), ("gone.fr/1", "h1.example.com/en/3")]
    up = {p: p for p in [*places, *(x for e in pairs for x in e)]}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        up[root(a)] = root(b)

    def rule(place):
        host, _, tail = place.partition("/")
        fits = [(len(r), v) for v, r in urls.RULES if ("." + host).endswith("." + r.partition("/")[0]) and ("/" + tail).startswith("/" + r.partition("/")[2])]
        return max(fits)[1] if fits else None

    carried = {}
    for p in up:
        if rule(p):
            carried[root(p)] = min(rule(p), carried.get(root(p), "block"))
    pages = spark.createDataFrame([(i, f"http://{p}", None) for i, p in enumerate(places)], "page_id long, url string, html string")
    edges = spark.createDataFrame([(f"http://{a}", f"https://{b}#x") for a, b in pairs], "a string, b string")
    got = {r.page_id: r for r in urls.judge(pages, edges=edges).collect()}
    assert {i: r.verdict for i, r in got.items()} == {i: rule(p) or carried.get(root(p), "allow") for i, p in enumerate(places)}
    assert len({(root(p), got[i].component) for i, p in enumerate(places)}) == len({root(p) for p in places}) == len({r.component for r in got.values()})
    assert sum(rule(p) is None and carried.get(root(p)) == "block" for p in places) > 5


def test_warc_derivatives(spark):
    html = "<html><head><title>T &amp; U</title><style>p{}</style></head><body><script>x='</p>'</script><h1>One</h1><p>a &lt;b&gt; <b>c</b><br>d</p><a href='/x'>link</a></body></html>"
    pages = spark.createDataFrame([(1, "http://e.org/", html), (2, None, None)], "page_id long, url string, html string")
    src = warc.responses_of_pages(pages)
    out = warc.derive(src, keep=("page_id",))
    got = {(r.page_id, r.warc_type): r for r in out.collect()}
    ids = {r.page_id: r for r in src.collect()}
    assert len(got) == 4 and all(r.refers_to == ids[k[0]].record_id and r.warc_date == ids[k[0]].date for k, r in got.items())
    assert got[1, "conversion"].block == "One\na <b> c\nd\nlink" and "outlink: /x" in got[1, "metadata"].block and "source-header: Content-Type: text/html" in got[1, "metadata"].block
    assert got[2, "conversion"].block == "" and got[2, "conversion"].target_uri is None
    data = b"".join(bytes(r.record) for r in warc.record_text(out.where("page_id = 1")).collect())
    back = list(warc.read_records(data))
    assert sorted(h["warc-type"] for h, _ in back) == ["conversion", "metadata"]
    for h, block in back:
        assert block.decode() == got[1, h["warc-type"]].block and h["warc-refers-to"] == ids[1].record_id


def test_warc_references_and_odd_pages(spark):
    html = "<p>&eacute;&#8212;&#x27;&mdash;&nbsp;&unknown; &amp;lt; & &#55296; &#x1F600; AT&T;</p>"
    long = "<p>" + "word &amp; " * 50_000 + "</p>"
    rows = [(1, "http://e.org/", html), (1, "http://e.org/", html), (2, "", ""), (3, "http://e.org/l", long), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = warc.derive(warc.responses_of_pages(pages), keep=("page_id",)).where("warc_type = 'conversion'").collect()
    text = Counter((r.page_id, r.block) for r in out)
    assert text == Counter({(1, "é—'— &unknown; &lt; & &#55296; 😀 AT&T;"): 2, (2, ""): 1, (3, ("word & " * 50_000).strip()): 1, (None, ""): 1})
    assert warc.derive(warc.responses_of_pages(pages.limit(0))).count() == 0


def test_warc_files(spark, tmp_path):
    """A plain and a compressed file, bytes that aren't UTF-8, other record types, and a record cut short."""
    import gzip

    def record(kind, i, body, size=None):
        head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{i}>\r\nWARC-Target-URI: http://e.org/{i}\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nContent-Length: {size or len(body)}\r\n\r\n"
        return head.encode() + body + b"\r\n\r\n"

    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    raw = b"<p>caf\xe9</p>"
    (tmp_path / "a.warc").write_bytes(record("warcinfo", 0, b"x: y\r\n") + record("response", 1, http + raw) + record("response", 2, http + b"cut", 999))
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(record("response", 3, http + b"<p>ok</p>")))
    src = warc.read_responses(spark, str(tmp_path))
    got = {r.record_id: r for r in src.collect()}
    sha = lambda b: "sha256:" + webp.hashlib.sha256(b).hexdigest()
    assert {k[-2]: (r.truncated, r.payload_digest) for k, r in got.items()} == {"1": (False, sha(raw)), "2": (True, sha(b"cut\r\n\r\n")), "3": (False, sha(b"<p>ok</p>"))}
    out = warc.derive(src).where("warc_type = 'metadata'").collect()
    assert {r.refers_to[-2]: (r.status, r.source_headers, r.payload_digest) for r in out}["1"] == (200, "Content-Type: text/html", sha(raw))


@pytest.mark.parametrize("whole", [2048, 60])
def test_embeddings_equal_all_pairs(spark, whole):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 16))
    x[100:260] = x[0] + 0.12 * rng.normal(size=(160, 16))
    x[260:280] = x[1]
    rows = [(i, [float(v) for v in e]) for i, e in enumerate(x)]
    odd = [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [None] + [1.0] * 15), (905, [float("inf")] * 16), (906, [1.0, 2.0]), (None, [1.0] * 16)]
    got = embeddings.near_duplicates(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>"), whole=whole, cell=16).collect()
    by = {r.vec_id: r for r in got}
    assert len(got) == 308 and all(by[i].n_links == 0 and by[i].component_id == i and by[i].kept for i in range(900, 907))
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    want = near.sum(1) - 1
    mine = np.array([by[i].n_links for i in range(300)])
    assert (mine <= want).all() and mine.sum() >= 0.99 * want.sum()
    assert all(by[i].component_id == 1 for i in range(260, 280))


def test_dense_region_reaches_the_recall(spark):
    """A third of the vectors lie in a broad cone, at cosine 0.7 to each other, with planted pairs at 0.91 within."""
    rng = np.random.default_rng(7)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    x = unit(rng.normal(size=(24_000, 64)))
    x[:8000] = unit(np.sqrt(0.7) * unit(rng.normal(size=64)) + np.sqrt(0.3) * x[:8000])
    aside = rng.normal(size=(400, 64))
    aside = unit(aside - (aside * x[:400]).sum(1, keepdims=True) * x[:400])
    pairs = 0.91 * x[:400] + np.sqrt(1 - 0.91**2) * aside
    rows = [(i, e.tolist()) for i, e in enumerate(np.concatenate([x, pairs]))]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    group = dict(rows_of(got.select("vec_id", "component_id")))
    found = sum(group[i] == group[24_000 + i] for i in range(400))
    assert found >= embeddings.RECALL * 400, found


def test_judge_learns_a_pair_that_no_word_tells(spark):
    """Toxic if exactly one of two words occurs: neither word alone says anything about the label."""
    rng, rows = random.Random(0), []
    for i in range(4000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = [f"word{rng.randrange(200)}" for _ in range(20)] + ["zorp"] * a + ["quix"] * b
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(a != b)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in rows], "doc_id long, quality int, toxic int")
    got = [r for r in toxicity.judge(docs, labels).collect() if r.held_out]
    assert len(got) > 700 and sum(r.predicted == rows[r.doc_id][2] for r in got) >= 0.95 * len(got)


def test_scores_equal_all_pairs_of_terms(spark, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(documents, labels)
    texts = rows_of(documents.select("doc_id", "text"))
    want = Counter()
    for d, text in texts:
        at = [model.at[i] for i in sorted({t % toxicity.BUCKETS for t in toxicity.terms(text)}) if i in model.at]
        x = model.b + sum(model.w[i] for i in at) + sum(float(model.v[i] @ model.v[j]) for k, i in enumerate(at) for j in at[:k])
        p = 1 / (1 + np.exp(-x))
        want[d, toxicity.zlib.crc32(str(d).encode()) % 5 == 0, round(float(p), 9), int(p >= 0.5)] += 1
    assert Counter((r.doc_id, r.held_out, round(r.score, 9), r.predicted) for r in toxicity.judge(documents, labels).collect()) == want


def test_toxicity_held_out_and_odd_rows(spark, odd, empty):
    rng = random.Random(1)
    some = lambda n: " ".join(rng.choice("lorem ipsum dolor sit amet vita nova".split()) + str(rng.randint(0, 30)) for _ in range(n))
    rows = [(i, some(30) + (" you idiot " if i % 4 == 0 else " fine ") + some(20), int(i % 4 == 0)) for i in range(600)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in rows], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.judge(docs, labels).collect()}
    out = [i for i in got if got[i].held_out]
    assert sum(got[i].predicted == rows[i][2] for i in out) >= 0.98 * len(out) > 50
    assert {i for i in got if got[i].held_out} == {i for i in got if toxicity.zlib.crc32(str(i).encode()) % 5 == 0}
    scores = rows_of(toxicity.judge(odd, labels).select("score"))
    assert len(scores) == odd.count() and all(0 <= s <= 1 for (s,) in scores)
    assert toxicity.clean(empty, labels).count() == 0 and toxicity.judge(odd, labels.limit(0)).where("predicted = 1").count() == 0


def test_webp_round_trips(odd, empty):
    rng = np.random.default_rng(0)
    for n in (1, 5, 70):
        for high in (1, 3, 40, 1 << 32):
            px = rng.integers(0, high, n * 16).astype(np.uint32)
            table = rng.integers(0, 1 << 32, ((16 + 3) // 4) * ((n + 3) // 4)).astype(np.uint32)
            for steps in (None, [], ["green"], [("cross", 2, table)], [("predict", 2, table)], ["green", ("predict", 2, table)]):
                for cache in (None, 0, 6):
                    ((w, h, got),) = webp.decode([webp.encode(px, 16, steps, cache)])
                    assert (w, h) == (16, n) and (got == px).all()
    with pytest.raises(webp.Corrupt):
        webp.decode([b"RIFF____WEBPVP8X"])
    rows = webp.columns(odd).collect()
    texts = Counter(t for (t,) in rows_of(odd.select("text")))
    want = Counter()
    for t, n in texts.items():
        p = webp.payload_of(t)
        want[len((t or "").encode()), len(p), webp.hashlib.sha256(p).hexdigest(), webp.zlib.crc32(p[-64:])] += n
    assert Counter((r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in rows) == want
    assert webp.columns(empty).count() == 0


def test_pipeline_stages(spark, sf_dir):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = pipeline.STAGES[0][1](spark, docs, sf_dir)
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in docs.collect() if model.score(r.text) < 0.5)
    out = pipeline.run(spark, sf_dir)
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0 and out.count() > 0

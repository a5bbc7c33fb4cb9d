import itertools
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from tests.llm.conftest import rows_of
from tramline.llm import simhash

LOW = {i: i + 32 for i in range(65, 91)}


def plain(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps, radius=2):
    """component of each distinct fingerprint, by all pairs"""
    fps = list(fps)
    up = {f: f for f in fps}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(fps, 2):
        if (a ^ b).bit_count() <= radius:
            up[root(a)] = root(b)
    return {f: root(f) for f in fps}


def brute(rows):
    fps = [(d, plain(t)) for d, t in rows]
    of = groups({f for _, f in fps})
    least = {}
    for d, f in fps:
        if d is not None:
            least[of[f]] = min(d, least.get(of[f], d))
    return Counter((d, f"{f:016x}", least.get(of[f])) for d, f in fps)


@pytest.mark.parametrize("name", ["documents", "odd"])
def test_equals_brute_force(name, request):
    docs = request.getfixturevalue(name)
    assert Counter(rows_of(simhash.near_duplicates(docs))) == brute(rows_of(docs.select("doc_id", "text")))


@pytest.mark.parametrize("parts", [None, 2, 3, 5, 8])
def test_links_of_dense_balls(spark, parts):
    rng = random.Random(parts or 1)
    fps = set()
    for _ in range(4):
        core = rng.getrandbits(64)
        for _ in range(150):
            fps.add(core ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    fps |= {0, (1 << 64) - 1, 3, *(rng.getrandbits(64) for _ in range(200))}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    edges = rows_of(simhash.links(spark.createDataFrame(signed, "fp long"), 2, parts))
    assert all(((u ^ v) & ((1 << 64) - 1)).bit_count() <= 64 for u, v in edges)
    up = {f: f for (f,) in signed}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for u, v in edges:
        up[root(u)] = root(v)
    want = groups(fps)
    mine = {f: root(f - (1 << 64) if f >> 63 else f) for f in fps}
    assert len(set(want.values())) == len(set(mine.values())) == len({(want[f], mine[f]) for f in fps})


def test_offsets_cover_half_of_the_ball():
    for m in (2, 4, 6):
        steps = {tuple(x) for x in simhash.half_offsets(m, 2).tolist()}
        full = {x for x in itertools.product(range(-2, 3), repeat=m) if sum(map(abs, x)) <= 2}
        assert steps | {tuple(-v for v in x) for x in steps} == full and len(steps) == (len(full) + 1) // 2


def test_one_of_each(odd, empty, documents):
    got = simhash.one_of_each(odd)
    assert got.columns == odd.columns
    ids = [r.doc_id for r in got.collect()]
    want = {c for _, _, c in brute(rows_of(odd.select("doc_id", "text"))) if c is not None}
    assert Counter(x for x in ids if x is not None) == Counter(want) and ids.count(None) == 2
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_of_each(empty).count() == 0


def test_long_text_fingerprint():
    text = " ".join(str(i % 977) for i in range(70_000))
    assert simhash.fingerprint(text) & ((1 << 64) - 1) == plain(text)
    assert np.int64(simhash.fingerprint("A  b\tC d")) == np.int64(simhash.fingerprint("a b c d"))


def sets_of(text, k=5):
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def alike(a, b):
    return a == b or bool(a and b and len(a & b) >= 0.8 * len(a | b))


def brute_similar(rows):
    """component_id by all pairs of distinct sets"""
    rows = [(d, sets_of(t)) for d, t in rows if d is not None]
    up = {s: s for _, s in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(list(up), 2):
        if alike(a, b):
            up[root(a)] = root(b)
    least = {}
    for d, s in rows:
        least[root(s)] = min(d, least.get(root(s), d))
    return Counter((d, least[root(s)]) for d, s in rows)


def near_copies(n=240):
    """Bases with copies in which some words are changed, from close ones to those past the threshold."""
    rng, out = random.Random(9), []
    for base in range(n // 12):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([6, 40, 200]))]
        for copy in range(12):
            changed = list(words)
            for _ in range(copy % 5):
                changed[rng.randrange(len(words))] = f"x{rng.randrange(3000)}"
            out.append((base * 12 + copy, " ".join(changed)))
    return out


@pytest.mark.parametrize("limit", [2048, 5])
@pytest.mark.parametrize("name", ["documents", "odd", "empty", "copies"])
def test_similar_groups_equal_brute_force(spark, name, limit, request):
    docs = spark.createDataFrame(near_copies(), "doc_id long, text string") if name == "copies" else request.getfixturevalue(name)
    got = Counter(rows_of(simhash.similar_groups(docs, rows=limit).select("doc_id", "least.doc_id")))
    assert got == brute_similar(rows_of(docs.select("doc_id", "text")))


def test_one_of_similar_keeps_the_columns(odd):
    got = simhash.one_of_similar(odd)
    assert got.columns == odd.columns
    want = {c for _, c in brute_similar(rows_of(odd.select("doc_id", "text")))}
    kept = [r.doc_id for r in got.collect()]
    assert sorted(d for d in kept if d is not None) == sorted(want)
    assert kept.count(None) == odd.where("doc_id IS NULL").count()


def test_much_repeated_short_line_hides_no_copy(spark):
    """The line's few shingles change the sets little, but most bits of a fingerprint that counts repeats."""
    rng, rows = random.Random(3), []
    for i in range(24):
        text = " ".join(f"w{rng.randrange(10**6)}" for _ in range(500))
        rows += [(2 * i, text), (2 * i + 1, text + f"\nsee note {i} on page {i + 7}" * 300)]
    got = rows_of(simhash.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "least.doc_id"))
    assert Counter(got) == brute_similar(rows) and all(c == d - d % 2 for d, c in got)


def test_maps_bound_the_difference_of_sets():
    rng = np.random.default_rng(4)
    for n in (1, 5, 60, 300, 9000):
        a = np.unique(rng.integers(0, 1 << 32, n).astype(np.uint32))
        for k in (0, 1, n // 10, n):
            b = np.unique(np.concatenate([a[k:], rng.integers(0, 1 << 32, k).astype(np.uint32)]))
            x, y = simhash.parities([a.view(np.int32), b.view(np.int32)], max(len(a), len(b), 1))
            assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("one_of", [simhash.one_of_similar, simhash.one_of_each])
def test_ids_that_repeat_lose_no_text(spark, one_of):
    words = lambda seed: " ".join(f"{seed}{i}" for i in range(30))
    rows = [(1, words("a"), 0), (1, words("b"), 1), (1, words("b"), 2), (2, words("b"), 3), (3, words("c"), 4), (3, words("c"), 4), (None, words("c"), 5)]
    got = Counter((r.doc_id, r.text) for r in one_of(spark.createDataFrame(rows, "doc_id long, text string, n long")).collect())
    assert got == Counter([(1, words("a")), (1, words("b")), (3, words("c")), (None, words("c"))])

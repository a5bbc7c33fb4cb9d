import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.conftest import rows_of
from tramline.llm import packing
from tramline.llm.queries import tokenizer_path


def whole_ids():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    return lambda text: [*tok.encode(text or "", add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("name", ["documents", "odd"])
def test_against_whole_encoding(name, request):
    docs, ids_of = request.getfixturevalue(name), whole_ids()
    want = []
    for d, t in rows_of(docs.select("doc_id", "text")):
        ids = ids_of(t)
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want.append((d, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = rows_of(packing.packed(docs, tokenizer_path()))
    key = lambda x: (x[0] is None, *[v or 0 for v in x])
    assert sorted((x[:5] for x in got), key=key) == sorted(want, key=key)
    bins = defaultdict(list)
    for x in got:
        bins[x[5]].append((x[6], x[3]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    least = -(-sum(x[3] for x in got) // 2048)
    assert len(bins) <= least * 1.03 + 2


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_everything_once(seed):
    rng = random.Random(seed)
    hist = defaultdict(int)
    for _ in range(rng.choice([3, 500, 20_000])):
        hist[min(2048, max(1, int(rng.lognormvariate(6, 1.2))))] += 1
    hist[2048] += seed
    plan = packing.plan(dict(hist))
    got, bins = defaultdict(list), defaultdict(list)
    for x, a, b, first, offset in plan.places:
        got[x].append((a, b))
        for k in range(b - a):
            bins[first + k].append((offset, x))
    assert {x: sorted(v) for x, v in got.items()}.keys() == {x for x, n in hist.items() if n}
    for x, spans in got.items():
        spans.sort()
        assert spans[0][0] == 0 and spans[-1][1] == hist[x] and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    for places in bins.values():
        at = 0
        for offset, x in sorted(places):
            assert offset == at
            at += x
        assert at <= 2048
    assert len(bins) == plan.bins
    least = -(-sum(x * n for x, n in hist.items()) // 2048)
    assert plan.bins <= least * 1.005 + 2


def test_patterns_are_fullest():
    rng = random.Random(3)
    for _ in range(40):
        sizes = sorted(rng.sample(range(5, 100), 6), reverse=True)
        left = [rng.randint(0, 3) for _ in sizes]
        if not any(left):
            continue
        top = next(i for i, n in enumerate(left) if n)
        best = 0

        def go(i, room, total):
            nonlocal best
            best = max(best, total)
            if i < len(sizes):
                for k in range((left[i] - (i == top)) + 1):
                    if k * sizes[i] <= room:
                        go(i + 1, room - k * sizes[i], total + k * sizes[i])

        go(top, 120 - sizes[top], sizes[top])
        got = packing.best_pattern(sizes, left, 120)
        assert all(k <= n for k, n in zip(got, left)) and got[top] and sum(k * s for k, s in zip(got, sizes)) == best


def test_words_with_unusual_characters():
    ids_of, words = whole_ids(), packing.Words(tokenizer_path(), most=50)
    texts = ["don't WE'LL 'tis x's", "a b c d", "<|endoftext|> a<|endoftext|>b", "Σας ΟΔΟΣ ́x é", "1234 a1b2 ###ab%%%", "\x0b\x0c\x1c\x85tail", "日本語 テスト", "", " \n"]
    texts += [f"word{i} other{i}." for i in range(200)]
    for lo in range(0, len(texts), 9):
        for t, got in zip(texts[lo : lo + 9], words.encode(texts[lo : lo + 9])):
            assert np.frombuffer(got, "<u4").tolist() == ids_of(t)[:-1], t


def test_empty(empty, spark):
    assert packing.packed(empty, tokenizer_path()).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 1, 0, 3000)], "doc_id long, row long, piece int, length long"))

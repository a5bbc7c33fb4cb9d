import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tramline.llm import mixing
from tramline.llm.shared import saved

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes):
    """Reshares the excess until none is above, as the contract says."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, target, open_ = 1.5 * sum(sizes.values()), dict.fromkeys(names, 0.0), set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total >= 2 * sizes[s]}
        if not full:
            return target | {s: left * weight[s] / total for s in open_}
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


@pytest.mark.parametrize("name", ["documents", "odd"])
def test_against_contract(name, request):
    docs = request.getfixturevalue(name)
    given = [(r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in docs.collect()]
    got = [(r.doc_id, r.source, r.size, r.source_size, r.target, r.taken) for r in mixing.mixed(docs).collect()]
    assert Counter(given) == Counter(x[:3] for x in got)
    sizes = defaultdict(int)
    for _, s, n in given:
        sizes[s] += n
    want, taken = brute_targets(sizes), defaultdict(int)
    for _, s, size, whole, target, words in got:
        assert whole == sizes[s] and target == pytest.approx(want[s])
        assert 0 <= words <= 2 * size
        taken[s] += words
    for s, t in want.items():
        assert abs(taken[s] - t) <= 1


def test_reruns_agree(documents):
    one = sorted(map(tuple, mixing.mixed(documents).select("doc_id", "taken").collect()))
    assert one == sorted(map(tuple, mixing.mixed(documents.repartition(3)).select("doc_id", "taken").collect()))


def test_prefixes_of_the_schedule_keep_the_weights(spark):
    targets = saved(spark.createDataFrame([("a", 10, 50_000.0), ("b", 10, 30_000.0), (None, 10, 20_000.4), ("z", 0, 0.0)], "source string, source_size long, target double"))
    rows = sorted(mixing.schedule(targets, 100).collect(), key=lambda r: r.slot)
    assert len({(r.source, r.block_no) for r in rows}) == len(rows) == 1000 and len({r.slot for r in rows}) == 1000
    for n in (50, 200, 900):
        got = Counter(r.source for r in rows[:n])
        for s, p in (("a", 0.5), ("b", 0.3), (None, 0.2)):
            assert abs(got[s] - p * n) < 6
    assert sum(r.tokens for r in rows) == 100_000


def test_slots_take_each_word_once_an_epoch(documents):
    sized = saved(mixing.sizes(documents))
    targets = saved(mixing.source_targets(sized))
    seen = defaultdict(list)
    for r in mixing.mix(sized, targets, block=64).collect():
        seen[r.doc_id, r.epoch].append((r.start, r.start + r.tokens))
    for spans in seen.values():
        spans.sort()
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_documents_of_the_mix(odd, empty):
    got = mixing.mixed_documents(odd)
    assert got.columns == odd.columns
    assert mixing.mixed_documents(empty).count() == 0 and mixing.mixed(empty).count() == 0
    per = Counter(r.doc_id for r in got.collect())
    assert max(v for k, v in per.items() if k not in (30, None)) <= 2
    wordless = {r.doc_id for r in odd.where(F.regexp_count(F.coalesce("text", F.lit("")), F.lit(mixing.WORD)) == 0).collect()}
    assert wordless <= set(per)


def brute_schedule(targets, block):
    """slot, block and words of each source by a loop over the points."""
    words = {s: round(t) for s, t in targets.items() if t > 0}
    names, total, at, out = sorted(words, key=lambda s: (s is None, s or "")), sum(targets.values()), 0.0, {}
    ends = []
    for s in names:
        at += targets[s]
        ends.append(at / total)
    need = {s: -(-w // block) for s, w in words.items()}
    given, slots = dict.fromkeys(names, 0), sum(need.values())
    for t in range(slots):
        p = ((t + 1) * mixing.GOLDEN) % 1.0
        s = next((n for n, e in zip(names, ends) if p < e), names[-1])
        if given[s] < need[s]:
            out[s, given[s]] = (t, min(block, words[s] - given[s] * block))
            given[s] += 1
    for s in names:
        for b in range(given[s], need[s]):
            out[s, b] = (slots + b, min(block, words[s] - b * block))
    return out


def test_slots_equal_a_loop_over_the_points(documents):
    rows = [(r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in documents.collect()]
    sizes = defaultdict(int)
    for _, s, n in rows:
        sizes[s] += n
    plan = brute_schedule(brute_targets(sizes), 256)
    key = lambda epoch, doc: int(hashlib.md5(f"0|{epoch}|{doc}".encode()).hexdigest()[:15], 16)
    want = defaultdict(lambda: [0, set(), 0])
    for source in sizes:
        at = 0
        for _, _, doc, n in sorted((e, key(e, d), d, n) for e in (0, 1) for d, s, n in rows if s == source and n):
            for b in range(at // 256, (at + n - 1) // 256 + 1):
                slot, tokens = plan.get((source, b), (None, 0))
                took = min(at + n, b * 256 + tokens) - max(at, b * 256)
                if took > 0:
                    x = want[doc]
                    x[0] += took
                    x[1].add(slot)
                    x[2] ^= slot * 65536 + took
            at += n
    got = {r.doc_id: (r.taken, r.first_slot, r.n_slots, r.slots_xor) for r in mixing.mixed(documents).collect()}
    assert len(got) == len(rows)
    for doc, x in got.items():
        taken, slots, xor = want[doc]
        assert x == (taken, min(slots, default=None), len(slots), xor)


def test_copies_follow_their_own_plan(spark):
    rng = random.Random(2)
    text = lambda: " ".join(rng.choice("abcdef") for _ in range(400))
    rows = [(1, text(), "a", i) for i in range(6)] + [(i, text(), "ab"[i % 2], 0) for i in range(10, 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n long")
    plan = {r.copy: r.epochs for r in mixing.mixed(docs).where("doc_id = 1").collect()}
    want = sorted(sum(2 * e >= 400 for e in plan[c]) for c in range(1, 7))
    got = Counter(r.n for r in mixing.mixed_documents(docs).where("doc_id = 1").collect())
    assert sorted([*got.values(), *[0] * (6 - len(got))]) == want

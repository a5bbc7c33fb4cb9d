"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

import string
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.llm.shared import lean, unused

#: Bounds of the training: labelled rows, and the rank of the interactions.
MOST_ROWS, RANK = 12_000, 4
#: Terms are hashed into so many buckets; all of them take part, common or rare.
BUCKETS = 1 << 18
#: A bucket's interactions are learnt if at least so many training rows have it; its weight always.
PAIRS_FROM = 20
#: A term is a word, or the first so many bytes of a longer one, since insults are inflected and compounded.
STEMS = (4, 5, 6, 7)
_KEEP = string.ascii_lowercase + string.digits
_TABLE = bytes(ord(chr(i).lower()) if chr(i).lower() in _KEEP else i if i > 127 else 32 for i in range(128)) + bytes(range(128, 256))


def terms(text: str | None) -> set[int]:
    """Hashes of the distinct terms of a text; null and empty texts have none."""
    words = set((text or "").lower().encode().translate(_TABLE).split())
    found = {w[:n] + b"*" for n in STEMS for w in words if len(w) > n}
    return set(map(zlib.crc32, words | found))


def buckets(text: str | None) -> np.ndarray:
    """The distinct buckets of a text's terms, ascending."""
    return np.unique(np.fromiter(terms(text), np.int64) % BUCKETS).astype("<i4")


def held_out(doc_id: str) -> Column:
    """Whether a row is kept from training: crc32 of its id as text is divisible by 5. Null ids are held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def labelled(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """text, toxic of at most `most` labelled rows that aren't held out, the first by a hash of the id."""
    some = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    some = some.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").select("text", "toxic")


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Machine:
    """score = sigmoid(b + sum w_i + sum over pairs <v_i, v_j>) over the buckets of a text that have learnt anything."""

    def __init__(self, rank: int = RANK):
        self.rank, self.b, self.at, self.w, self.v = rank, -2.0, {}, np.zeros(0), np.zeros((0, rank))

    def raw(self, text: str | None) -> float:
        at = sorted(map(self.at.__getitem__, {t % BUCKETS for t in terms(text)} & self.at.keys()))
        v = self.v[at]
        s = v.sum(0)
        return float(self.b + self.w[at].sum() + 0.5 * ((s * s).sum() - (v * v).sum()))

    def score(self, text: str | None) -> float:
        return float(_sigmoid(self.raw(text)))

    def fit(self, rows: list[np.ndarray], y: list[int], first: int = 4, epochs: int = 24, patience: int = 8, batch: int = 128, seed: int = 0) -> None:
        """Fits the logistic loss on rows of buckets, in batches, in an order fixed by the seed.

        The weights come first, for `first` epochs, by FTRL with an L1 term that keeps a bucket at zero until its
        gradients agree; then weights and interactions together for at most `epochs`. A row's gradient on interactions is
        divided by its number of terms, so that no long text is learnt by heart. The state with the least loss on a
        tenth of the rows, which no step sees, is kept, and `patience` epochs without a better one end the fit."""
        rng, y, rank = np.random.default_rng(seed), np.asarray(y, float), self.rank
        ptr = np.r_[0, np.cumsum([len(r) for r in rows])].astype(np.int64)
        flat = np.concatenate([np.zeros(0, np.int32), *rows]).astype(np.int32, copy=False)
        counts = np.bincount(flat, minlength=BUCKETS)
        used = np.flatnonzero(counts)
        number = np.zeros(BUCKETS, np.int32)
        number[used] = np.arange(len(used))
        number.take(flat, out=flat, mode="clip")
        perm = rng.permutation(len(rows))
        check, train = np.split(perm, [len(rows) // 10])
        pairs = np.flatnonzero(counts[used] >= PAIRS_FROM)
        place = np.full(len(used), -1)
        place[pairs] = np.arange(len(pairs))
        l1, l2, beta, decay = max(1.0, min(10.0, len(rows) / 400)), 1.0, 1.0, 0.01
        z, n, w, v = np.zeros(len(used)), np.zeros(len(used)), np.zeros(len(used)), rng.normal(0, 0.01, (len(pairs), rank))
        b, seen, alpha, best, since = self.b, 1.0, 0.2, None, 0

        def forward(some, both):
            size, k = ptr[some + 1] - ptr[some], len(some)
            doc = np.repeat(np.arange(k), size)
            at = flat[np.arange(size.sum()) + np.repeat(ptr[some] - np.r_[0, np.cumsum(size)[:-1]], size)]
            out = b + np.bincount(doc, w[at], k)
            if not both:
                return doc, at, out, None
            a = place[at]
            a, d = a[a >= 0], doc[a >= 0]
            va = v[a]
            s = np.stack([np.bincount(d, va[:, j], k) for j in range(rank)], 1)
            return doc, at, out + 0.5 * ((s * s).sum(1) - np.bincount(d, (va * va).sum(1), k)), (a, d, va, s)

        for epoch in range(first + epochs):
            both = epoch >= first
            if epoch == first:  # quicker steps from here on, from the same weights
                n, alpha = np.ones(len(used)), 0.5
                z = -w * ((beta + np.sqrt(n)) / alpha + l2) - np.sign(w) * l1
            order = train[rng.permutation(len(train))]
            for lo in range(0, len(order), batch):
                some = order[lo : lo + batch]
                doc, at, out, x = forward(some, both)
                g = _sigmoid(out) - y[some]
                dw = np.bincount(at, g[doc], len(used))
                z += dw - (np.sqrt(n + dw * dw) - np.sqrt(n)) / alpha * w
                n += dw * dw
                w = np.where(np.abs(z) <= l1, 0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))
                seen += g.sum() ** 2
                b -= 0.1 * g.sum() / np.sqrt(seen)
                if both and len(pairs):
                    a, d, va, s = x
                    t = (g / np.maximum(1, np.bincount(d, minlength=len(some))))[d, None] * (s[d] - va)
                    dv = np.stack([np.bincount(a, t[:, j], len(pairs)) for j in range(rank)], 1)
                    v -= np.clip(0.1 * (dv + decay * v), -0.2, 0.2)
            tried = check if len(check) else train
            out = np.concatenate([forward(tried[i : i + 512], both)[2] for i in range(0, len(tried), 512)])
            loss = np.logaddexp(0, np.where(y[tried] > 0, -out, out)).mean()
            since += 1
            if best is None or loss < best[0]:
                best, since = (loss, b, w.copy(), v.copy() if both else np.zeros_like(v)), 0
            if epoch >= first + patience and since >= patience:
                break
        _, self.b, w, v = best
        every = np.zeros((len(used), rank))
        every[pairs] = v
        told = np.flatnonzero((w != 0) | (np.abs(every).max(1, initial=0) > 1e-3))
        self.at, self.w, self.v = {int(i): k for k, i in enumerate(used[told])}, w[told], every[told]


def train(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, rank: int = RANK) -> Machine:
    """A machine fitted on at most `most_rows` labelled rows; without any, it scores every text alike, below 0.5."""

    def hashed(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([buckets(t).tobytes() for t in b.column(0).to_pylist()], pa.binary()), b.column(1).cast(pa.int32())], names=["rows", "toxic"])

    got = sorted((r.rows, r.toxic) for r in labelled(docs, labels, most_rows).mapInArrow(lean(hashed), "rows binary, toxic int").collect())
    model = Machine(rank)
    if got:
        model.fit([np.frombuffer(r, "<i4") for r, _ in got], [y for _, y in got])
    return model


def scored(docs: DataFrame, model: Machine, name: str) -> DataFrame:
    """`docs` with a column `name`, the score by text alone."""
    given = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for b in batches:
            scores = pa.array([model.score(t) for t in b.column(b.schema.get_field_index("text")).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, scores], names=[*given, name])

    return docs.mapInArrow(lean(run), schema)


def judge(docs: DataFrame, labels: DataFrame, **bounds) -> DataFrame:
    """doc_id, held_out, score, predicted for each document. Labels, lang, source and doc_id are no inputs. Null and
    empty texts have no terms and score alike; rows that repeat give rows that repeat; no documents give no rows; a
    text of any length is read whole; other columns, whatever their names, are left aside."""
    out = scored(docs.select("doc_id", "text"), train(docs, labels, **bounds), "score")
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean(docs: DataFrame, labels: DataFrame, **bounds) -> DataFrame:
    """The documents whose score is below 0.5, columns as given, whatever their names; cases as in `judge`."""
    name = unused("score", docs)
    return scored(docs, train(docs, labels, **bounds), name).where(F.col(name) < 0.5).select(*docs.columns)

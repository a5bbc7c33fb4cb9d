"""Best-fit packing of tokenized documents by linear grouping.

Lengths are at most the capacity, so everything that has to be decided depends on the number of pieces of each
length alone: `plan` packs that histogram on the driver, at a cost bound by the capacity and not by the data, and
`pack` gives each piece, by its rank among those of its length, the place that the plan has for it."""

from __future__ import annotations


import bisect
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.llm.shared import checked, lean, ranked, saved

CAPACITY = 2048
#: Groups of equal cardinality that large lengths are rounded up to. Rounding wastes about a group's width in each
#: place, so few groups cost sequences; the number bounds the work, whatever the number of pieces.
GROUPS = 768
#: Pieces of at least this part of the capacity are large.
LARGE = 1 / 4


#: Lower-case text of ASCII and Latin-1 letters, in UTF-8, which normalizes to itself; other words are encoded whole.
SAFE = re.compile(rb"[\x00-\x7f]*+(?:\xc3[\x80-\x96\x98-\xb6\xb8-\xbf][\x00-\x7f]*+)*+")
#: What the tokenizer splits such text into: letters (bytes past ASCII are parts of such), single digits, fixed
#: contractions, other marks.
RUNS = re.compile(rb"[a-z\x80-\xc3]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^ \t-\ra-z0-9\x80-\xc3]+")


class Words:
    """Ids of a text as bytes (little-endian, 32 bits each). The tokenizer encodes each run of letters, digit and
    run of marks on its own, so each distinct one is encoded once; the store is emptied when it holds `most`."""

    def __init__(self, path: str, most: int = 1_000_000):
        from tokenizers import Tokenizer

        self.tok, self.most, self.known = Tokenizer.from_file(path), most, {}
        vocab = self.tok.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for w, i in vocab.items() if w.endswith("</w>")]] = True

    def raw(self, some: list[bytes]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast([w.decode() for w in some], add_special_tokens=False)]

    def flat(self, runs: list[bytes]) -> list[bytes]:
        """Ids of many runs from one text: each ends with a token that ends a word."""
        ids = np.array(self.tok.encode_batch_fast([b" ".join(runs).decode()], add_special_tokens=False)[0].ids, "<u4")
        ends = ((np.flatnonzero(self.last[ids]) + 1) * 4).tolist()
        if len(ends) != len(runs):
            return self.raw(runs)
        flat = ids.tobytes()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def parts(self, text: str | None, odd: set[bytes]) -> list[bytes]:
        """Runs of a text; words that aren't safe stay whole and go to `odd` too."""
        low = (text or "").lower().encode() if (text or "").isascii() else text.encode()
        if not SAFE.fullmatch(low) or b"<|" in low:
            out = []
            for w in text.encode().split():
                if SAFE.fullmatch(w) and b"<|" not in w:
                    out += RUNS.findall(w.decode().lower().encode())
                else:
                    odd.add(w)
                    out.append(w)
            return out
        return RUNS.findall(low if text is None or text.isascii() else text.lower().encode())

    def encode(self, texts: list[str | None]) -> list[bytes]:
        odd: set[bytes] = set()
        split = [self.parts(x, odd) for x in texts]
        known = self.known
        if len(known) > self.most:
            known.clear()
        new = set().union(*split).difference(known) - odd
        odd = [w for w in odd if w not in known]
        known.update(zip(odd, self.raw(odd), strict=True))
        new = list(new)
        for lo in range(0, len(new), 20_000):
            some = new[lo : lo + 20_000]
            known.update(zip(some, self.flat(some), strict=True))
        of = known.__getitem__
        return [b"".join(map(of, words)) for words in split]


_words: dict[str, Words] = {}


def words_of(path: str) -> Words:
    """The tokenizer of this process, loaded once."""
    if path not in _words:
        _words[path] = Words(path)
    return _words[path]


def tokens(docs: DataFrame, path: str, end: int = 0, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """doc_id, row, piece, start, length, ids_crc32 (and ids, binary, if asked for): the pieces of each document. A
    document is its ids and the id `end`; longer ones than `capacity` are cut into pieces of it, the last may be
    shorter. A null text is empty. `row` tells documents apart that share an id."""
    more = [("row", T.LongType()), ("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType()), *[("ids", T.BinaryType())] * ids]
    schema = T.StructType([*docs.select("doc_id").schema.fields, *(T.StructField(n, t) for n, t in more)])

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tramline.llm.packing import words_of  # by name, so that tasks share the tokenizer

        words, last = words_of(path), np.array([end], "<u4").tobytes()
        try:
            for b in batches:
                types = [b.schema.field(0).type, pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * ids]
                for lo in range(0, b.num_rows, 256):
                    part = b.slice(lo, 256)
                    rows = []
                    for doc, row, all_ids in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), words.encode(part.column(2).to_pylist()), strict=True):
                        all_ids += last
                        for k, at in enumerate(range(0, len(all_ids), 4 * capacity)):
                            piece = all_ids[at : at + 4 * capacity]
                            rows.append((doc, row, k, at // 4, len(piece) // 4, zlib.crc32(piece), *[piece] * ids))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=schema.names)
        finally:
            words.known = {}  # the process lives on for other work

    return docs.select("doc_id", F.xxhash64("text").alias("row"), "text").mapInArrow(lean(run), schema)


class Plan:
    """Runs of sequences that are alike. A run is [residual, used, first, count]; `places` collects rows
    (length, first rank, end rank, first sequence, offset)."""

    def __init__(self, capacity: int):
        self.capacity, self.places, self.bins, self.taken = capacity, [], 0, {}
        self.open: dict[int, list] = {}

    def put(self, length: int, count: int, first: int, offset: int) -> None:
        r = self.taken.get(length, 0)
        self.places.append((length, r, r + count, first, offset))
        self.taken[length] = r + count

    def leave(self, residual: int, first: int, count: int) -> None:
        if residual:
            self.open.setdefault(residual, []).append((first, count))

    def new(self, count: int) -> int:
        self.bins += count
        return self.bins - count


def best_pattern(sizes: list[int], left: list[int], capacity: int) -> list[int]:
    """A fullest multiset of the sizes that holds the largest one left, within what is left of each; of equally
    full ones the one with larger sizes first (bounded subset sums, sizes in descending order)."""
    top = next(i for i, n in enumerate(left) if n)
    reach = np.full(capacity + 1, -1, np.int32)  # the group that reached a sum last
    count = np.zeros(capacity + 1, np.int32)
    before = {sizes[top]: (top, 0)}
    sums = [sizes[top]]
    reach[sizes[top]] = top
    for i in range(top, len(sizes)):
        most = left[i] - (i == top)
        if most <= 0:
            continue
        count[:] = 0
        for s in list(sums):
            used, at = 0, s
            while used < most and at + sizes[i] <= capacity and reach[at + sizes[i]] < 0:
                used, at = used + 1, at + sizes[i]
                reach[at] = i
                before[at] = (i, at - sizes[i])
                sums.append(at)
        if capacity in before:
            break
    at, pattern = max(sums), [0] * len(sizes)
    while at:
        i, at = before[at]
        pattern[i] += 1
    return pattern


def _configure(plan: Plan, hist: dict[int, int], groups: int) -> None:
    """Packs the large lengths: in descending order they fall into groups of equal cardinality, each rounded up to
    its longest; a fullest configuration of the few sizes is used as often as what is left allows, again and again;
    the actual lengths then take its places, longest first."""
    total, lengths = sum(hist.values()), sorted(hist, reverse=True)
    if not total:
        return
    runs: list[list[list[int]]] = []
    room, per = 0, -(-total // groups)
    for x in lengths:
        n = hist[x]
        while n:
            if not room:
                runs.append([])
                room = per
            k = min(n, room)
            runs[-1].append([x, k])
            n, room = n - k, room - k
    sizes, left = [g[0][0] for g in runs], [sum(n for _, n in g) for g in runs]
    merged: dict[int, int] = {}
    for i, s in enumerate(sizes):  # equal sizes are one
        j = merged.setdefault(s, i)
        if j != i:
            runs[j] += runs[i]
            left[j], left[i] = left[j] + left[i], 0
    while any(left):
        pattern = best_pattern(sizes, left, plan.capacity)
        times = min(left[i] // k for i, k in enumerate(pattern) if k)
        slots = [i for i, k in enumerate(pattern) for _ in range(k)]
        alike = [(plan.new(times), times, 0)]  # first, count, used
        for i in slots:
            left[i] -= times
            after = []
            for first, count, used in alike:
                while count:
                    x, n = run = runs[i][0]
                    k = min(n, count)
                    plan.put(x, k, first, used)
                    after.append((first, k, used + x))
                    first, count = first + k, count - k
                    run[1] -= k
                    if not run[1]:
                        runs[i].pop(0)
            alike = after
        for first, count, used in alike:
            plan.leave(plan.capacity - used, first, count)


def _best_fit(plan: Plan, hist: dict[int, int]) -> None:
    """Packs lengths in descending order, each into the fullest sequences that still hold it, else into new ones."""
    rooms = sorted(plan.open)
    for x in sorted(hist, reverse=True):
        n = hist[x]
        while n:
            i = bisect.bisect_left(rooms, x)
            if i < len(rooms):
                r = rooms[i]
                first, count = plan.open[r].pop()
                if count > n:
                    plan.open[r].append((first + n, count - n))
                    count = n
                if not plan.open[r]:
                    del plan.open[r]
                    rooms.pop(i)
            else:
                r = plan.capacity
                count = -(-n // (plan.capacity // x)) if x else n
                count = min(n, count)
                first = plan.new(count)
            plan.put(x, count, first, plan.capacity - r)
            n -= count
            if rest := r - x:
                if rest not in plan.open:
                    bisect.insort(rooms, rest)
                plan.leave(rest, first, count)


def plan(hist: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, large: float = LARGE) -> Plan:
    """Packs hist[length] pieces of each length: the large ones by linear grouping and configurations, then the
    small ones by best fit into what is left and into new sequences."""
    made, least = Plan(capacity), capacity * large
    _configure(made, {x: n for x, n in hist.items() if x >= least and n}, groups)
    _best_fit(made, {x: n for x, n in hist.items() if x < least and n})
    return made


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS, large: float = LARGE) -> DataFrame:
    """The rows with sequence_id and offset. `pieces` needs doc_id, row, piece, length (1 to `capacity`)."""
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    if any(x is None or not 0 < x <= capacity for x in counts):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    made = plan(counts, capacity, groups, large)
    spark = pieces.sparkSession
    starts, at = {}, 0
    for x in sorted(counts):
        starts[x], at = at, at + counts[x]
    rows = sorted((x, starts[x] + a, starts[x] + b, first, offset) for x, a, b, first, offset in made.places)
    place = spark.createDataFrame(rows, "p_length int, lo long, hi long, first long, p_offset int")
    order = ranked(pieces, ["length", "doc_id", "row", "piece"])
    # a place covers ranks lo to hi of one length; both sides meet on the length and a range of ranks of `wide`
    wide = max(256, at // 4096)
    place = place.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") / wide), F.floor((F.col("hi") - 1) / wide))))
    both = order.withColumn("__cell", F.floor(F.col("rank") / wide)).join(checked(place), (F.col("length") == F.col("p_length")) & (F.col("__cell") == F.col("cell")))
    both = both.where("rank >= lo AND rank < hi")
    return both.select(*pieces.columns, (F.col("first") + F.col("rank") - F.col("lo")).alias("sequence_id"), F.col("p_offset").cast("long").alias("offset"))


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece of each document."""
    pieces = saved(tokens(docs, path, capacity=capacity))
    return pack(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

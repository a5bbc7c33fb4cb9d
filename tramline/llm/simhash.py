"""SimHash near-dedup by exact comparison of tiles of equal population counts."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tramline.llm.shared import Forest, components, drop_saved, lean, saved, unused

BITS = 64
#: Fingerprints of a tile that are compared at once.
BLOCK = 2048


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of each shingle, repeats included. Words lie between the six ASCII white-space characters, A-Z
    lower-cased; a shingle is `shingle` words joined by a space, or all words if there are fewer; none: no hash."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    flat, size = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
    ends, starts = (size - 1).tolist(), [0, *size[:-1].tolist()]
    k = min(shingle, len(words))
    hashed = xxhash.xxh64_intdigest
    return np.fromiter((hashed(flat[a:b], 42) for a, b in zip(starts, ends[k - 1 :], strict=False)), np.uint64, len(words) - k + 1)


def majority(h: np.ndarray) -> int:
    """The 64 bits that over half the hashes set, signed as Spark's long; 0 for none."""
    if not h.size:
        return 0
    if h.size < 1 << 16:
        ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    else:
        ones = sum(np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64) for x in np.array_split(h, h.size // (1 << 15)))
    return int(np.packbits(ones * 2 > h.size, bitorder="little").view(np.int64)[0])


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of the shingles. Null and wordless texts: 0."""
    return majority(shingle_hashes(text, shingle))


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, row (a hash of the text), fp for each document."""

    def run(batches):
        for b in batches:
            fps = [fingerprint(x, shingle) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps, pa.int64())], names=["doc_id", "row", "fp"])

    keyed = docs.select("doc_id", F.xxhash64("text").alias("row"), "text")
    return keyed.mapInArrow(lean(run), docs.select("doc_id").schema.add("row", "long").add("fp", "long"))


def parts_for(n: int) -> int:
    """Bit ranges whose population counts name a tile, chosen for the least expected work on `n` fingerprints:
    copies of a fingerprint sent to neighbouring tiles, a thousand times dearer than a comparison, plus comparisons
    within tiles and with neighbours. Any number gives the same links."""

    def work(m: int) -> float:
        width = BITS / m
        same = sum((math.comb(round(width), k) / 2 ** round(width)) ** 2 for k in range(round(width) + 1)) ** m
        near = 1 + 4 * m + 2 * m * (m - 1)
        return n * (1000 * near / 2 + n * same * near / 2)

    return min(range(2, 11), key=work)


def half_offsets(m: int, radius: int) -> np.ndarray:
    """The differences of m counts that sum to at most `radius` in size, one of each pair x, -x, zero first."""
    found = []
    for count in range(radius + 1):
        for places in itertools.combinations(range(m), count):
            for values in itertools.product([v for v in range(-radius, radius + 1) if v], repeat=count):
                if sum(map(abs, values)) <= radius:
                    x = [0] * m
                    for p, v in zip(places, values, strict=True):
                        x[p] = v
                    found.append(tuple(x))
    zero = (0,) * m
    return np.array([zero, *sorted(x for x in found if x > zero)], np.int64)


def _tiles(m: int, radius: int):
    """(tile, own, fp): each fingerprint in the tile of its own counts, and as a guest in those tiles on one side
    that counts within the radius can reach. Two fingerprints differ in at least as many bits as their counts do,
    so all other pairs of tiles are skipped without loss."""
    edges = np.linspace(0, BITS, m + 1).round().astype(int)
    masks = np.array([((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in itertools.pairwise(edges)], np.uint64)
    widths, steps, base = np.diff(edges), half_offsets(m, radius), 6

    def run(batches):
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            for lo in range(0, len(fp), 4096):
                some = fp[lo : lo + 4096]
                counts = np.bitwise_count(some.view(np.uint64)[:, None] & masks).astype(np.int64)
                near = counts[:, None, :] + steps
                ok = ((near >= 0) & (near <= widths)).all(2)
                tile = np.zeros(ok.shape, np.int64)
                for k in range(m):
                    tile = (tile << base) | (near[:, :, k] & 63)
                row, col = np.nonzero(ok)
                yield pa.RecordBatch.from_arrays([pa.array(tile[row, col]), pa.array((col > 0).astype(np.int8)), pa.array(some[row])], names=["tile", "guest", "fp"])

    return run


def compare(own: np.ndarray, guests: np.ndarray, radius: int):
    """Pairs within the radius: own with own, each once, and own with guests; block by block."""
    for i in range(0, len(own), BLOCK):
        a = own[i : i + BLOCK]
        for others, first in ((own, i), (guests, 0)):
            for j in range(first, len(others), BLOCK):
                b = others[j : j + BLOCK]
                near = np.bitwise_count(a[:, None] ^ b[None, :]) <= radius
                if others is own and i == j:
                    near = np.triu(near, 1)
                x, y = np.nonzero(near)
                if len(x):
                    yield a[x], b[y]


def _linked(radius: int):
    """Reads a partition sorted by tile and returns a spanning forest of the links that it finds."""

    def tile(forest, cols):
        guest, fp = cols
        own, guests = fp[guest == 0], fp[guest == 1]
        if not len(own):
            return
        for x, y in compare(own.view(np.uint64), guests.view(np.uint64), radius):
            for u, v in zip(x.view(np.int64).tolist(), y.view(np.int64).tolist(), strict=True):
                forest.join(u, v)

    def run(batches):
        forest, held = Forest(), None
        for b in batches:
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
            cuts = [0, *(np.flatnonzero(cols[0][1:] != cols[0][:-1]) + 1).tolist()]
            for lo, hi in itertools.pairwise(cuts):
                tile(forest, [x[lo:hi] for x in cols[1:]])
            held = [x[cuts[-1] :] for x in cols]
        if held is not None:
            tile(forest, held[1:])
        yield forest.edges()

    return run


def links(fps: DataFrame, radius: int = 2, parts: int | None = None) -> DataFrame:
    """(u, v): edges between distinct fingerprints that join the same groups as all pairs within the radius.
    Tiles meet by a shuffle on their counts; a task keeps one tile and a forest, never the pairs."""
    one = saved(fps.select("fp").distinct())
    m = parts or parts_for(one.count())
    tiles = one.mapInArrow(lean(_tiles(m, radius)), "tile long, guest byte, fp long")
    return tiles.repartition("tile").sortWithinPartitions("tile", "guest").mapInArrow(lean(_linked(radius)), "u long, v long")


def near_duplicates(docs: DataFrame, radius: int = 2, shingle: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id of the group, itself included) for each
    document. Equal fingerprints are compared once. A group without any id has a null component_id. Null, empty and
    wordless texts have fingerprint zero and link like any other; rows that repeat give rows that repeat; no documents
    give no rows; texts of any length are read whole; other columns, whatever their names, are left aside."""
    fps, per = _groups(docs, radius, shingle)
    out = fps.join(per.select(F.col("fp").alias("of"), F.col("least.doc_id").alias("component_id")), F.col("fp") == F.col("of"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _groups(docs: DataFrame, radius: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """doc_id, row, fp of each document, and fp, least (struct of the group's smallest doc_id and row)."""
    fps = saved(fingerprints(docs, shingle))
    group = components(links(fps, radius))
    named = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "row"))
    per = fps.groupBy("fp").agg(F.min(named).alias("least"))
    per = per.join(group, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    per = saved(per)
    least = per.groupBy("component").agg(F.min("least").alias("least"))
    return fps, per.drop("least").join(least, "component").select("fp", "least")


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of `docs` whose (doc_id, hash of the text) is in `kept`, and all without an id. Of rows that agree in
    both, the one with the smallest hash of all its columns stays."""
    row, whole = unused("row", docs), unused("whole", docs)
    keyed = docs.where("doc_id IS NOT NULL").withColumns({row: F.xxhash64("text"), whole: F.xxhash64(*docs.columns)})
    one = keyed.select(F.col("doc_id").alias("k_doc"), F.col(row).alias("k_row"), F.col(whole).alias("k_whole"))
    one = one.join(kept.select(F.col("doc_id").alias("k_doc"), F.col("row").alias("k_row")), ["k_doc", "k_row"], "left_semi")
    one = one.groupBy("k_doc", "k_row").agg(F.min("k_whole").alias("k_whole"))
    a, b = keyed.alias("a"), one.alias("b")
    same = (F.col("a.doc_id") == F.col("b.k_doc")) & (F.col(f"a.{row}") == F.col("b.k_row")) & (F.col(f"a.{whole}") == F.col("b.k_whole"))
    named = a.join(b, same, "left_semi").dropDuplicates(["doc_id", row, whole]).drop(row, whole)
    return named.unionByName(docs.where("doc_id IS NULL"))


def one_of_each(docs: DataFrame, radius: int = 2, shingle: int = 3) -> DataFrame:
    """One document of each group, the smallest by (doc_id, hash of the text), columns as given, whatever their names.
    Rows that repeat an id with other texts are documents of their own; rows that repeat id and text stay once.
    Documents without an id can't be named and stay; null and empty texts are one group; no documents give none."""
    _, per = _groups(docs, radius, shingle)
    return _only(docs, per.where("least IS NOT NULL").select("least.doc_id", "least.row").distinct())


#: Most bits of the map of a set's shingles by which pairs of a tile are ruled out.
WIDEST = 4096
#: Odd factors that turn a shingle's hash into the independent orders whose least members name a text's tiles.
ORDERS = np.array([(0x9E3779B97F4A7C15 * (2 * k + 1) ^ (0xBF58476D1CE4E5B9 << k)) % (1 << 64) | 1 for k in range(8)], np.uint64)
#: Orders of the first round; the others follow for texts that it left apart.
FIRST = 4


def _sketch(shingle: int, whole: bool):
    """(doc_id, row, set_id, n, fp, keys) of each text, or with `whole` (doc_id, row, set_id, hashes), the distinct
    shingles as 32-bit hashes. Equal set_id: the same set of shingles, and fp, the fingerprint of the distinct shingles,
    is equal too. Wordless texts have set_id 0 and no keys."""

    def run(batches):
        for b in batches:
            out = []
            for text in b.column(2).to_pylist():
                u = np.unique(shingle_hashes(text, shingle))
                name = xxhash.xxh64_intdigest(u.tobytes(), 1) if u.size else 0
                mixed = u ^ (u >> np.uint64(29))
                extra = np.unique(u.astype(np.uint32)).view(np.int32) if whole else (mixed[:, None] * ORDERS).min(0).view(np.int64) if u.size else np.zeros(0, np.int64)
                out.append((name - (name >> 63 << 64), u.size, 0 if whole else majority(u), extra))
            ids, sizes, fps, extras = zip(*out, strict=True) if out else ((), (), (), ())
            cols = [b.column(0), b.column(1), pa.array(ids, pa.int64())]
            if whole:
                yield pa.RecordBatch.from_arrays([*cols, pa.array(extras, pa.list_(pa.int32()))], names=["doc_id", "row", "set_id", "hashes"])
            else:
                yield pa.RecordBatch.from_arrays([*cols, pa.array(sizes, pa.int64()), pa.array(fps, pa.int64()), pa.array(extras, pa.list_(pa.int64()))], names=["doc_id", "row", "set_id", "n", "fp", "keys"])

    return run


def sketches(docs: DataFrame, shingle: int, whole: bool = False) -> DataFrame:
    schema = docs.select("doc_id", "row").schema.add("set_id", "long")
    schema = schema.add("hashes", T.ArrayType(T.IntegerType())) if whole else schema.add("n", "long").add("fp", "long").add("keys", T.ArrayType(T.LongType()))
    return docs.select("doc_id", "row", "text").mapInArrow(lean(_sketch(shingle, whole)), schema)


def parities(sets, most: int) -> np.ndarray:
    """A bit map of each set: whether a bit's place is hit by an odd number of its hashes. Two maps differ in at most
    as many bits as there are hashes in one of the sets alone. As wide as the size `most` asks for, up to WIDEST."""
    bits = max(64, min(WIDEST, 1 << (most - 1).bit_length()))
    out = np.zeros((len(sets), bits // 64), np.uint64)
    for i, x in enumerate(sets):
        out[i] = np.packbits(np.bincount(x & np.int32(bits - 1), minlength=bits).astype(np.uint8) & 1).view(np.uint64)
    return out


def verify(names, sides, sets, similarity: float, forest) -> None:
    """Joins in the forest the names of the sets of one tile that are as similar: pairs of both sides, or all pairs if
    the tile has one. Blocks in the order of size are skipped whole where sizes rule out all pairs; XOR of the maps
    bounds the difference of two sets from below, so that it rules out none that is similar. All other pairs, if not
    joined yet, are decided by their sets."""
    held, kept = {}, 0

    def members(i):
        nonlocal kept
        if i not in held:
            if kept > 1 << 18:
                held.clear()
                kept = 0
            held[i] = set(sets[i].tolist())
            kept += len(held[i])
        return held[i]

    size = np.fromiter(map(len, sets), np.int64, len(sets))
    maps, apart = parities(sets, int(size.max())), (1 - similarity) / (1 + similarity)
    order, both, block = np.argsort(size, kind="stable"), len(np.unique(sides)) > 1, 512
    for i in range(0, len(order), block):
        a = order[i : i + block]
        for j in range(i, len(order), block):
            b = order[j : j + block]
            if size[a[-1]] < similarity * size[b[0]]:
                break
            roots = [np.array([forest.root(names[x]) for x in some.tolist()], np.int64) for some in (a, b)]
            near = (np.minimum(size[a][:, None], size[b]) >= similarity * np.maximum(size[a][:, None], size[b])) & (roots[0][:, None] != roots[1])
            if both:
                near &= sides[a][:, None] != sides[b]
            if i == j:
                near = np.triu(near, 1)
            x, y = np.nonzero(near)
            for lo in range(0, len(x), 1 << 15):
                u, v = a[x[lo : lo + (1 << 15)]], b[y[lo : lo + (1 << 15)]]
                differ = np.zeros(len(u), np.int64)
                for word in maps.T:
                    differ += np.bitwise_count(word[u] ^ word[v])
                fits = differ <= (size[u] + size[v]) * apart + 1e-6
                for u, v in zip(u[fits].tolist(), v[fits].tolist(), strict=True):
                    if forest.root(names[u]) != forest.root(names[v]):
                        shared = len(members(u) & members(v))
                        if shared >= similarity * (size[u] + size[v] - shared):
                            forest.join(names[u], names[v])


def _verified(similarity: float):
    """Reads a partition sorted by tile; keeps one tile and a forest."""

    def run(batches):
        forest, tile, rows = Forest(), None, []

        def close():
            if len(rows) > 1:
                names, sides, sets = zip(*rows, strict=True)
                verify(names, np.array(sides, np.int64), sets, similarity, forest)
            rows.clear()

        for batch in batches:
            keys = list(zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True))
            names, sides = (batch.column(i).to_pylist() for i in (3, 4))
            for i, key in enumerate(keys):
                if key != tile:
                    close()
                    tile = key
                rows.append((names[i], sides[i], batch.column(5)[i].values.to_numpy()))
        close()
        yield forest.edges()

    return run


def _tile_groups(one: DataFrame, dealt: DataFrame, keys: DataFrame, named: DataFrame, shingle: int, similarity: float, across: bool) -> DataFrame:
    """Groups of the names of similar sets that share one of `keys` (key, blocks, rep). A key of several blocks
    deals each member to its own block together with the key's representative, or, `across`, to all pairs of its block
    with others, so that no task holds a whole hot tile and none is cut short."""
    mine = dealt.join(keys, "key").withColumn("b", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
    if across:
        to = F.sequence(F.lit(0), F.col("blocks") - 1)
    else:
        to = F.when(F.col("set_id") == F.col("rep"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("b"))
    mine = mine.withColumn("j", F.explode(to))
    if across:
        place = [F.least("b", "j").alias("a"), F.greatest("b", "j").alias("z"), (F.col("b") < F.col("j")).cast("int").alias("side")]
    else:
        place = [F.col("j").alias("a"), F.col("j").alias("z"), F.lit(0).alias("side")]
    tiles = saved(mine.select("key", *place, "set_id", "name"))
    needed = tiles.select("set_id").distinct().join(one.select("set_id", F.col("least.doc_id").alias("k_doc"), F.col("least.row").alias("k_row")), "set_id")
    texts = named.join(needed.select("k_doc", "k_row"), (F.col("doc_id") == F.col("k_doc")) & (F.col("row") == F.col("k_row")), "left_semi")
    sets = sketches(texts, shingle, whole=True).dropDuplicates(["set_id"]).drop("doc_id", "row")
    full = tiles.join(sets, "set_id").select("key", "a", "z", "name", "side", "hashes")
    group = components(full.repartition("key", "a", "z").sortWithinPartitions("key", "a", "z").mapInArrow(lean(_verified(similarity)), "u long, v long"))
    drop_saved(tiles)
    return group


def similar_groups(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, rows: int = 2048, hashes: int = 1 << 20, radius: int = 2) -> DataFrame:
    """doc_id, row (hash of the text), least (struct of the smallest doc_id and row of its group) for each document
    with an id: groups joined by pairs whose sets of shingles have a Jaccard similarity of at least `similarity`.

    Candidates come from fingerprints first: all within `radius` bits are found in tiles of population counts (`links`),
    and each group so linked is a tile of sets. Pairs nearer 0.8 differ in far more bits, with which those tiles would
    compare all with all. For them a text enters one tile for each of eight orders of its shingles too, named by the
    least shingle: a pair at 0.8 shares none with probability 0.2 ** 8, 3 in a million. Tiles are split by the octave of a set's size; a set
    whose partners may lie in the next octave enters that too, so `similarity` has to be over a half. Within a tile
    sizes and the XOR of bit maps rule out pairs that can't be similar, and the sets decide all others. Equal sets are
    one member.

    Two rounds: first the tiles of fingerprints and of FIRST orders, where a tile of more than `rows` members or `hashes` shingles is cut
    into blocks that all hold its representative, the work on a large group of copies thus linear; then all blocks of
    such tiles with each other and the tiles of the other orders, but only where members are still of several groups,
    and only pairs of different ones."""
    named = docs.where("doc_id IS NOT NULL").select("doc_id", F.xxhash64("text").alias("row"), "text")
    all_ = saved(sketches(named, shingle))
    who = F.struct("doc_id", "row")
    one = saved(all_.groupBy("set_id").agg(F.min_by(F.struct("n", "fp", "keys"), who).alias("x"), F.min(who).alias("least")).select("set_id", "least", "x.n", "x.fp", "x.keys"))
    near = components(links(one.where("n > 0"), radius))
    tile = F.xxhash64(F.lit("fingerprint"), F.coalesce("near", "fp"))
    one = one.join(near.select(F.col("node").alias("fp"), F.col("component").alias("near")), "fp", "left")
    one = saved(one.select("set_id", "least", "n", F.when(F.col("n") > 0, F.concat(F.array(tile), "keys")).otherwise(F.col("keys")).alias("keys")))
    octave = lambda n: F.floor(F.log2(n)).cast("int")
    bands = F.array_distinct(F.array(octave(F.col("n")), octave(F.col("n") / F.lit(similarity * 0.9999))))
    size = F.greatest(F.ceil(F.col("c") / rows), F.ceil(F.col("w") / hashes)).cast("int").alias("blocks")

    def deal(of: DataFrame, name: str, orders) -> DataFrame:
        out = of.select("set_id", F.col(name).alias("name"), "n", F.explode(bands).alias("band"), "keys")
        return out.select("set_id", "name", "n", "band", F.explode(F.slice("keys", *orders)).alias("key")).withColumn("key", F.xxhash64("key", "band")).drop("band")

    dealt = deal(one, "set_id", (1, 1 + FIRST))
    keys = dealt.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("w"), F.min("set_id").alias("rep")).where("c > 1").select("key", size, "rep")
    keys = saved(keys)
    group = _tile_groups(one, dealt, keys, named, shingle, similarity, False)
    one = saved(one.join(group, F.col("set_id") == F.col("node"), "left").select("set_id", "least", "n", "keys", F.coalesce("component", "set_id").alias("component")))

    hot = deal(one, "component", (1, 1 + FIRST)).join(keys.where("blocks > 1").select("key"), "key", "left_semi")
    rest = hot.unionByName(deal(one, "component", (FIRST + 2, len(ORDERS) - FIRST)))
    apart = rest.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("w"), F.min("set_id").alias("rep"), F.min("name").alias("lo"), F.max("name").alias("hi"))
    apart = saved(apart.where("lo < hi").select("key", size, "rep"))
    group = _tile_groups(one, rest, apart, named, shingle, similarity, True).withColumnRenamed("component", "wider")
    per = one.join(group, F.col("component") == F.col("node"), "left").select("set_id", "least", F.coalesce("wider", "component").alias("last"))
    per = saved(per)
    least = per.groupBy("last").agg(F.min("least").alias("least"))
    per = per.drop("least").join(least, "last").select(F.col("set_id").alias("of"), "least")
    return all_.join(per, F.col("set_id") == F.col("of")).select("doc_id", "row", "least")


def one_of_similar(docs: DataFrame, similarity: float = 0.8, shingle: int = 5) -> DataFrame:
    """One document of each group of similar texts; which one stays, and all other cases, as in `one_of_each`."""
    return _only(docs, similar_groups(docs, similarity, shingle).select("least.doc_id", "least.row").distinct())

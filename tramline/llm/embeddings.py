"""Embedding near-dedup by sorted projection passes."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.shared import checked, components, ranked, saved

#: Each vector meets so many of its next neighbours in a pass.
WINDOW = 256
#: The passes find a pair at the threshold with this probability, counting hash bits as independent.
RECALL = 0.97
#: Most passes of one vector: where copies fill the windows, no number of passes reaches the recall.
MOST = 96
#: Members of a class that are compared in one task; larger classes are cut into cells.
WHOLE = 2048
CELL = 512


def passes_for(n: int, least: float, window: int = WINDOW, recall: float = RECALL) -> int:
    """Two vectors share a random hyperplane's bit with probability 1 - angle / pi; neighbours within the window
    share about log2(n / window) leading bits."""
    bits = max(1.0, math.log2(max(2, n / window)))
    found = (1 - math.acos(max(-1.0, min(1.0, least))) / math.pi) ** bits
    return max(4, math.ceil(math.log(1 - recall) / math.log(1 - found))) if found < 1 else 4


def matrix(column) -> np.ndarray:
    """Unit rows, in double precision, from a list column of one length."""
    x = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def usable() -> Column:
    """Whether a row has an id and a finite, nonzero vector; never null."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))


def vectors(table: DataFrame) -> DataFrame:
    """vec_id, node, e: the rows with an id and a finite, nonzero vector; node is a 64-bit hash of the vector."""
    return table.where(usable()).select("vec_id", F.xxhash64("embedding").alias("node"), F.col("embedding").alias("e"))


def signatures(distinct: DataFrame, passes: int, seed: int) -> DataFrame:
    """pass, dim, sig, node: 64 concatenated hash bits of each vector for each pass, the first the most significant."""

    def run(batches):
        planes = {}
        for b in batches:
            node, e = b.column(0), b.column(1)
            dims = np.asarray(pa.compute.list_value_length(e))
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                if int(d) not in planes:
                    planes[int(d)] = np.random.default_rng([seed, int(d)]).normal(size=(int(d), passes * 64))
                bits = matrix(e.take(pa.array(at))) @ planes[int(d)] > 0
                sig = np.packbits(bits.reshape(len(at), passes, 64), axis=2).view(">u8")[:, :, 0].astype(np.uint64).view(np.int64)
                cols = [np.tile(np.arange(passes, dtype=np.int32), len(at)), np.full(len(at) * passes, d, np.int32), sig.reshape(-1), np.repeat(node.to_numpy(zero_copy_only=False)[at], passes)]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in cols], names=["pass", "dim", "sig", "node"])

    return distinct.select("node", "e").mapInArrow(run, "pass int, dim int, sig long, node long")


def _window(least: float, window: int):
    """Links of one block with itself and the next: edges to the smallest member of each row's group there."""

    def run(table):
        table = table.combine_chunks()
        rank, node = (table.column(c).to_numpy() for c in ("rank", "node"))
        order = np.argsort(rank)
        rank, node = rank[order], node[order]
        own = table.column("own").to_numpy(zero_copy_only=False)[order]
        dim = table.column("dim").to_numpy()[order]
        e = table.column("e").combine_chunks().take(pa.array(order))
        near = np.zeros((len(rank), len(rank)), bool)
        for d in np.unique(dim):
            at = np.flatnonzero(dim == d)
            x = matrix(e.take(pa.array(at)))
            gap = rank[at][None, :] - rank[at][:, None]
            near[np.ix_(at, at)] = (x @ x.T >= least) & (gap > 0) & (gap <= window) & own[at][:, None]
        near |= near.T
        np.fill_diagonal(near, True)
        label = np.arange(len(rank))
        while True:
            new = np.where(near, label[None, :], len(rank)).min(1)
            if (new == label).all():
                break
            label = new
        at = np.flatnonzero(label != np.arange(len(rank)))
        return pa.table({"u": pa.array(node[at]), "v": pa.array(node[label[at]])})

    return run


def missed(order: DataFrame, least: float, window: int) -> DataFrame:
    """node, miss: the log of the chance that all passes of `order` miss a pair of the node at the threshold. In a
    pass the members with one more leading bit than the node shares with those `window` places before and behind
    all lie within its window, and a pair shares each bit with probability 1 - angle / pi."""
    same = 1 - math.acos(max(-1.0, min(1.0, least))) / math.pi
    far = order.select(F.col("pass").alias("f_pass"), F.col("dim").alias("f_dim"), F.col("sig").alias("f_sig"), F.col("node").alias("f_node"), F.col("rank").alias("f_rank"))
    ahead = order.select("pass", "dim", "sig", "node", (F.col("rank") + window).alias("at"))
    met = ahead.join(far, (F.col("at") == F.col("f_rank")) & (F.col("pass") == F.col("f_pass")) & (F.col("dim") == F.col("f_dim")))
    x = F.col("sig").bitwiseXOR(F.col("f_sig"))
    met = met.withColumn("bits", F.when(x == 0, 64).when(x < 0, 0).otherwise(63 - F.floor(F.log2(x))).cast("int") + 1)
    each = met.select("pass", "bits", F.explode(F.array("node", "f_node")).alias("node")).groupBy("pass", "node").agg(F.max("bits").alias("bits"))
    # who has no one so far away in a pass, before or behind, meets all there and is not in `each`
    chance = F.pow(F.lit(same), F.least("bits", F.lit(64)))
    dense = each.groupBy("node").agg(F.sum(F.log(F.greatest(1 - chance, F.lit(1e-12)))).alias("miss"), F.count(F.lit(1)).alias("seen"))
    passes = order.groupBy("node").agg(F.count(F.lit(1)).alias("passes"))
    miss = F.when(F.col("seen") == F.col("passes"), F.col("miss")).otherwise(F.lit(-1e9))
    return passes.join(dense, "node", "left").select("node", F.coalesce(miss, F.lit(-1e9)).alias("miss"))


def links(distinct: DataFrame, least: float = 0.9, window: int = WINDOW, recall: float = RECALL, seed: int = 0, passes: int | None = None, at_once: int = 4, most: int = MOST) -> DataFrame:
    """(u, v): edges that join the same groups as all pairs that the passes verify.

    For each pass the vectors are ordered by their hash bits, and each is compared with the `window` after it: blocks
    of the order meet the block behind them, and each task holds two blocks. Passes run in rounds of at least
    `at_once`, with at most that many times the table's rows in flight. After a round a vector leaves if the bits that
    it shared with the ends of its windows say that its pairs were found with probability `recall`; a pair's vectors
    are together until the first of them leaves. Vectors of dense regions stay for more passes, `most` in all.
    `passes` runs so many for all, in one round after another."""
    n = distinct.count()
    first = passes or min(most, passes_for(n, least, window, recall))
    active, left, done, found, scores = distinct.select("node", "e"), n, 0, [], None
    while left > 1 and done < (passes or most):
        k = max(at_once, min(at_once * n // left, 32)) if done else at_once
        k = min(k, (first if done < first else passes or most) - done)
        order = saved(ranked(signatures(active, k, seed + 1009 * done), ["pass", "dim", "sig", "node"]).select("pass", "dim", "sig", "node", "rank"))
        some = order.drop("sig").join(active, "node")
        block = F.floor(F.col("rank") / window)
        sides = F.explode(F.array(F.struct(block.alias("block"), F.lit(True).alias("own")), F.struct((block - 1).alias("block"), F.lit(False).alias("own"))))
        both = some.select("pass", "dim", "node", "rank", "e", sides.alias("s")).select("pass", "dim", "node", "rank", "e", "s.block", "s.own")
        found.append(saved(both.groupBy("pass", "block").applyInArrow(_window(least, window), "u long, v long").distinct()))
        done += k
        if passes is None:
            now = missed(order, least, window)
            if scores is not None:
                now = now.join(scores.withColumnRenamed("miss", "was"), "node").select("node", (F.col("miss") + F.col("was")).alias("miss"))
            scores = saved(now.where(F.col("miss") > math.log(1 - recall)))
            left = scores.count()
            active = distinct.select("node", "e").join(scores.select("node"), "node", "left_semi")
    if not found:
        return distinct.select(F.col("node").alias("u"), F.col("node").alias("v")).limit(0)
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out


def _count(least: float):
    """node, n: the copies of linked others of each member, all members against all."""

    def run(table):
        table = table.combine_chunks()
        node, copies = (table.column(c).to_numpy() for c in ("node", "copies"))
        e = table.column("e").combine_chunks()
        dims = np.asarray(pa.compute.list_value_length(e))
        n = np.zeros(len(node), np.int64)
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            x = matrix(e.take(pa.array(at)))
            for i in range(0, len(at), 1024):
                n[at[i : i + 1024]] = (x[i : i + 1024] @ x.T >= least) @ copies[at]
        return pa.table({"node": pa.array(node), "n": pa.array(n - copies)})

    return run


def _cells(table):
    """The centre of a cell, the largest angle to it, and its copies."""
    table = table.combine_chunks()
    x = matrix(table.column("e").combine_chunks())
    centre = x.mean(0)
    size = np.sqrt((centre * centre).sum())
    centre = centre / size if size > 1e-9 else x[0]
    radius = float(np.arccos(np.clip(x @ centre, -1, 1)).max()) + 1e-6
    return pa.table({"component": table.column("component")[:1], "cell": table.column("cell")[:1], "dim": pa.array([x.shape[1]], pa.int32()), "centre": pa.array([centre.tolist()], pa.list_(pa.float64())), "radius": pa.array([radius]), "size": pa.array([int(table.column("copies").to_numpy().sum())], pa.int64())})


def _large(members: DataFrame, least: float, cell: int) -> DataFrame:
    """node, n for classes too large for one task. Members in the order of their hash bits are cut into cells. Two
    cells whose centres and radii put all pairs within the angle add their sizes, those that keep all pairs apart
    add nothing, and only the others are compared member by member."""
    sig = signatures(members, 1, 99).select(F.col("node").alias("s_node"), "dim", "sig")
    order = ranked(members.join(sig, F.col("node") == F.col("s_node")).drop("s_node"), ["component", "dim", "sig", "node"])
    order = saved(order.drop("before", "sig"))
    first = checked(order.groupBy("component", "dim").agg(F.min("rank").alias("first")))
    celled = saved(order.join(first, ["component", "dim"]).withColumn("cell", F.floor((F.col("rank") - F.col("first")) / cell)).withColumn("cell", F.col("cell") * 65536 + F.col("dim")).drop("rank", "first", "dim"))
    stats = saved(celled.groupBy("component", "cell").applyInArrow(_cells, "component long, cell long, dim int, centre array<double>, radius double, size long"))
    a, b = (stats.select(*[F.col(c).alias(f"{p}_{c}") for c in stats.columns]) for p in "ab")
    pairs = a.join(b, (F.col("a_component") == F.col("b_component")) & (F.col("a_dim") == F.col("b_dim")))
    dot = F.aggregate(F.zip_with("a_centre", "b_centre", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    angle, reach, most = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot))), F.col("a_radius") + F.col("b_radius"), math.acos(least)
    kind = F.when(angle + reach < most - 1e-6, "all").when(angle - reach > most + 1e-6, "none").otherwise("some")
    pairs = saved(pairs.select(F.col("a_component").alias("component"), F.col("a_cell").alias("cell"), F.col("b_cell").alias("other"), "b_size", kind.alias("kind")).where("kind <> 'none'"))
    sure = pairs.where("kind = 'all'").groupBy("component", "cell").agg(F.sum("b_size").alias("sure"))
    open_ = pairs.where("kind = 'some'").select("component", "cell", "other")
    left = open_.join(celled, ["component", "cell"]).select("component", "cell", "other", F.lit(True).alias("own"), "node", "copies", "e")
    right = open_.join(celled.withColumnRenamed("cell", "other"), ["component", "other"]).select("component", "cell", "other", F.lit(False).alias("own"), "node", "copies", "e")

    def count(table):
        table = table.combine_chunks()
        own = table.column("own").to_numpy(zero_copy_only=False)
        x, copies = matrix(table.column("e").combine_chunks()), table.column("copies").to_numpy()
        return pa.table({"node": pa.array(table.column("node").to_numpy()[own]), "n": pa.array((x[own] @ x[~own].T >= least) @ copies[~own])})

    some = left.unionByName(right).groupBy("component", "cell", "other").applyInArrow(count, "node long, n long").groupBy("node").agg(F.sum("n").alias("some"))
    per = celled.join(sure, ["component", "cell"], "left").join(some, "node", "left")
    return per.select("node", (F.coalesce("sure", F.lit(0)) + F.coalesce("some", F.lit(0)) - F.col("copies")).cast("long").alias("n"))


def near_duplicates(table: DataFrame, least: float = 0.9, window: int = WINDOW, recall: float = RECALL, seed: int = 0, whole: int = WHOLE, cell: int = CELL) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row.

    Equal vectors are one node of the passes, with its copies counted. Links are counted in full within the classes
    that the passes find: every pair of a class with cosine >= `least`, in double precision, counts, whether or not a
    window held it. Vectors that are null, zero, or hold null or non-finite components, and rows without an id, link
    with nothing; so do vectors of different lengths. Rows that repeat are vectors of their own."""
    rows = vectors(table)
    distinct = saved(rows.groupBy("node").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("e").alias("e")))
    group = saved(components(links(distinct, least, window, recall, seed)))
    members = saved(distinct.join(group, "node"))
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("members"), F.min("rep").alias("least"))
    sizes = saved(sizes)
    small = members.join(sizes.where(F.col("members") <= whole).select("component"), "component").select("component", "node", "copies", "e")
    counts = small.groupBy("component").applyInArrow(_count(least), "node long, n long")
    big = sizes.where(F.col("members") > whole).select("component")
    if not big.isEmpty():
        counts = counts.unionByName(_large(members.join(big, "component").select("component", "node", "copies", "e"), least, cell))
    named = members.select("node", "component").join(sizes.select("component", "least"), "component").join(counts, "node").select("node", "least", "n")
    per = distinct.select("node", "rep", "copies").join(named, "node", "left")
    per = per.select(F.col("node").alias("p_node"), F.coalesce("least", "rep").alias("component_id"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    found = rows.select("vec_id", "node").join(per, F.col("node") == F.col("p_node")).select("vec_id", "n_links", "component_id")
    bad = table.where(~usable()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = found.unionByName(bad)
    return out.select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))

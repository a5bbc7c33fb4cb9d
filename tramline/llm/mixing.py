"""Mixing sources to target weights by a low-discrepancy schedule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tramline.llm.shared import checked, ranked, saved, stable_hash, unused

WORD = r"[^\x20\x09-\x0D]+"
#: Fraction of the golden ratio; slot t of the schedule lies at the point frac((t + 1) * GOLDEN).
GOLDEN = 0.6180339887498949


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, copy: the words of each text (null: 0); copy numbers rows that are alike."""
    out = docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    alike = Window.partitionBy("doc_id", "source", "size").orderBy("size")
    return out.withColumn("copy", F.row_number().over(alike))


def source_targets(sized: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, target. Sources by code point, null last, weigh `weights`, repeating, and share
    `share` of all sizes; no target exceeds `most` times its source's size, and the excess goes to the others by
    weight until none is above. The level at which that ends has a closed form over the sources in the order in
    which they fill up. The table has a row for each source."""
    per = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    k = (F.row_number().over(order) - 1) % len(weights)
    weigh = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (k + 1).cast("int"))
    per = per.select("source", "source_size", weigh.alias("w"), (F.lit(float(most)) * F.col("source_size")).alias("cap"))
    total = F.lit(float(share)) * F.sum("source_size").over(Window.partitionBy())
    fills = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    ahead, on = fills.rowsBetween(Window.unboundedPreceding, -1), fills.rowsBetween(0, Window.unboundedFollowing)
    level = (total - F.coalesce(F.sum("cap").over(ahead), F.lit(0.0))) / F.sum("w").over(on)
    per = per.withColumn("level", level).withColumn("open", F.col("level") * F.col("w") < F.col("cap"))
    final = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("w"), F.col("level")))).over(Window.partitionBy())
    per = per.withColumn("final", final["level"])
    return per.select("source", "source_size", F.least("cap", F.coalesce(F.col("final") * F.col("w"), F.col("cap"))).alias("target"))


def points(spark: SparkSession, slots: int) -> DataFrame:
    """t, p: the golden-ratio points frac((t + 1) * GOLDEN). t is split in two so that doubles stay exact enough."""
    step = 1 << 20
    t = F.col("id") + 1
    raw = F.floor(t / step) * F.lit(GOLDEN * step % 1.0) + (t % step) * F.lit(GOLDEN)
    return spark.range(slots).select(F.col("id").alias("t"), (raw - F.floor(raw)).alias("p"))


def schedule(targets: DataFrame, block: int) -> DataFrame:
    """source, block_no, slot, tokens: the mix as a sequence of slots of `block` words. Slot t belongs to the
    source in whose part of the cumulative weights its point lies, and takes that source's next block. A source's
    slots end with its target: later points pass it by, and blocks that it still lacks follow at the end; its last
    block holds the rest. Points find their part by an equal cell of a grid, then by its bounds."""
    ends = Window.orderBy(F.col("source").asc_nulls_last())
    bounds = targets.where("target > 0").select("source", F.round("target").cast("long").alias("words"), (F.sum("target").over(ends) / F.sum("target").over(Window.partitionBy())).alias("hi"))
    bounds = bounds.withColumn("lo", F.coalesce(F.lag("hi").over(ends), F.lit(0.0))).withColumn("blocks", F.ceil(F.col("words") / block).cast("long"))
    bounds = saved(bounds)
    slots = bounds.agg(F.coalesce(F.sum("blocks"), F.lit(0)).cast("long")).first()[0]
    cells = 4096
    cell = lambda c: F.least(F.floor(c * cells), F.lit(cells - 1)).cast("int")
    grid = bounds.withColumn("cell", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi")))))
    at = points(targets.sparkSession, slots).withColumn("cell", cell(F.col("p")))
    placed = at.join(checked(grid), "cell").where("p >= lo AND (p < hi OR hi >= 1.0)").select("source", F.col("source").isNull().alias("no_source"), "t", "blocks", "words")
    order = saved(ranked(placed, ["no_source", "source", "t"]).drop("no_source"))
    first = checked(order.groupBy("source").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("given")))
    regular = order.alias("o").join(first.alias("f"), F.expr("o.source <=> f.source"))
    regular = regular.select(F.col("o.source").alias("source"), (F.col("rank") - F.col("first")).alias("block_no"), F.col("t").alias("slot"), "words", "blocks").where("block_no < blocks")
    late = bounds.alias("b").join(first.alias("f"), F.expr("b.source <=> f.source"), "left").select(F.col("b.source").alias("source"), F.coalesce("given", F.lit(0)).alias("given"), "words", "blocks").where("given < blocks")
    late = late.select("source", F.explode(F.sequence(F.col("given"), F.col("blocks") - 1)).alias("block_no"), "words", "blocks")
    late = late.select("source", "block_no", (F.lit(slots) + F.col("block_no")).alias("slot"), "words", "blocks")
    tokens = F.least(F.lit(block), F.col("words") - F.col("block_no") * block)
    return regular.unionByName(late).select("source", "block_no", "slot", tokens.cast("long").alias("tokens"))


def mix(sized: DataFrame, targets: DataFrame, block: int = 256, seed: int = 0, epochs: int = 2) -> DataFrame:
    """doc_id, source, size, copy, epoch, slot, start, tokens: which words of which document a slot of the mix takes.

    A source's documents are shuffled by a hash once for each epoch and laid end to end, its stream is cut into
    blocks of `block` words, and the schedule's slots take them in turn, so any prefix of the mix keeps the weights.
    Words taken from a source come to its rounded target. Rows that repeat are documents of their own (copy 1, 2,
    ...). Documents without words give no row. Null ids and sources take part like any others."""
    sized = sized.where("size > 0")
    copies = sized.select("doc_id", "source", "size", "copy", F.explode(F.array(*[F.lit(i) for i in range(epochs)])).alias("epoch"))
    key = stable_hash(F.lit(str(seed)), F.col("epoch").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    copies = copies.select("*", key.alias("key"), F.col("source").isNull().alias("no_source"))
    streams = saved(ranked(copies, ["no_source", "source", "epoch", "key", "doc_id", "size", "copy"], weight="size").drop("rank", "key", "no_source"))
    starts = streams.groupBy("source").agg(F.min("before").alias("first"))
    ends = targets.select("source", F.round("target").cast("long").alias("words"))
    per = checked(saved(starts.alias("a").join(ends.alias("b"), F.expr("a.source <=> b.source")).select(F.col("a.source").alias("in_source"), "first", "words")))
    at = F.col("before") - F.col("first")
    pieces = streams.join(per, F.expr("source <=> in_source")).select("doc_id", "source", "size", "copy", "epoch", "words", at.alias("at")).where("at < words")
    number = F.explode(F.sequence(F.floor(F.col("at") / block), F.floor((F.col("at") + F.col("size") - 1) / block)))
    pieces = pieces.select("*", number.alias("block_no")).drop("words")
    joined = pieces.alias("p").join(schedule(targets, block).alias("q"), F.expr("p.source <=> q.source AND p.block_no = q.block_no"))
    lo = F.greatest(F.col("at"), F.col("p.block_no") * block)
    hi = F.least(F.col("at") + F.col("size"), F.col("p.block_no") * block + F.col("tokens"))
    return joined.select("doc_id", F.col("p.source").alias("source"), "size", "copy", "epoch", "slot", (lo - F.col("at")).alias("start"), (hi - lo).alias("tokens")).where("tokens > 0")


def mixed(docs: DataFrame, block: int = 256, seed: int = 0) -> DataFrame:
    """One row per document: doc_id, source, size, copy, source_size, target, taken, epochs (taken words by epoch), and
    where the schedule has them: first_slot (null if nothing is taken), n_slots, slots_xor (XOR over its parts of slot
    * 65536 + words). Null, empty and wordless texts have size 0 and take nothing; null ids and sources take part like
    any others; rows that repeat are documents of their own, told apart by copy; no documents give no rows; a text of
    any length counts whole and is cut into blocks; other columns, whatever their names, are left aside."""
    sized = saved(sizes(docs))
    targets = saved(source_targets(sized))
    parts = mix(sized, targets, block, seed)
    taken = parts.groupBy("doc_id", "source", "size", "copy").agg(
        F.sum("tokens").alias("taken"), F.sum(F.when(F.col("epoch") == 0, F.col("tokens"))).alias("first"), F.min("slot").alias("first_slot"),
        F.count_distinct("slot").alias("n_slots"), F.bit_xor(F.col("slot") * 65536 + F.col("tokens")).alias("slots_xor"),
    )
    same = "s.doc_id <=> k.doc_id AND s.source <=> k.source AND s.size = k.size AND s.copy = k.copy"
    out = sized.alias("s").join(taken.alias("k"), F.expr(same), "left").join(checked(targets).alias("t"), F.expr("s.source <=> t.source"))
    long = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return out.select(
        F.col("s.doc_id").alias("doc_id"), F.col("s.source").alias("source"), F.col("s.size").alias("size"), F.col("s.copy").alias("copy"), "source_size", "target", long("taken").alias("taken"),
        F.array(long("first"), long("taken") - long("first")).alias("epochs"), F.col("first_slot").cast("long").alias("first_slot"), long("n_slots").alias("n_slots"), long("slots_xor").alias("slots_xor"),
    )


def mixed_documents(docs: DataFrame, block: int = 256, seed: int = 0) -> DataFrame:
    """The documents of the mix: a row for each epoch that takes at least half of a document's words, so a document
    stays once, twice, or not at all. Documents without words stay once. Rows that agree in id, source and size are
    numbered by a hash of all their columns, and each follows the plan of its own number. Columns as given, whatever
    their names; other cases as in `mixed`."""
    half = lambda i: (F.element_at("epochs", i) * 2 >= F.col("size")).cast("int")
    times = F.when(F.col("size") == 0, 1).otherwise(half(1) + half(2))
    per = saved(mixed(docs, block, seed).select(F.col("doc_id").alias("p_doc"), F.col("source").alias("p_source"), F.col("size").alias("p_size"), F.col("copy").alias("p_copy"), times.alias("p_times")))
    size, number, again, times_ = (unused(n, docs) for n in ("words", "number", "again", "times"))
    per = per.withColumnRenamed("p_times", times_)
    keyed = docs.withColumn(size, F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))
    same = (F.col("d.doc_id").eqNullSafe(F.col("p.p_doc"))) & F.col("d.source").eqNullSafe(F.col("p.p_source")) & (F.col(f"d.{size}") == F.col("p.p_size"))
    several = checked(per.where("p_copy > 1").select("p_doc", "p_source", "p_size").distinct())
    alike = Window.partitionBy("doc_id", "source", size).orderBy(F.xxhash64(*docs.columns))
    numbered = keyed.alias("d").join(several.alias("p"), same, "left_semi").withColumn(number, F.row_number().over(alike))
    given = [*(F.col(f"d.`{c}`") for c in docs.columns), F.col(f"p.{times_}")]
    repeats = numbered.alias("d").join(checked(per.alias("a").join(several.alias("b"), F.expr("a.p_doc <=> b.p_doc AND a.p_source <=> b.p_source AND a.p_size = b.p_size"), "left_semi")).alias("p"), same & (F.col(f"d.{number}") == F.col("p.p_copy"))).select(*given)
    single = per.alias("a").join(several.alias("b"), F.expr("a.p_doc <=> b.p_doc AND a.p_source <=> b.p_source AND a.p_size = b.p_size"), "left_anti").where(F.col(times_) > 0)
    out = keyed.alias("d").join(single.alias("p"), same).select(*given).unionByName(repeats.where(F.col(times_) > 0))
    return out.withColumn(again, F.explode(F.sequence(F.lit(1), F.col(times_)))).select(*docs.columns)

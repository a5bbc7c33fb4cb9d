"""What several operators of this package need: tables, shared storage, global ranks and components."""

from __future__ import annotations

import ctypes
import string
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(name: str, *frames: DataFrame) -> str:
    """`name`, with underscores after it until no column of the frames has it, whatever the case."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(col: Column) -> Column:
    """Lower-cases A-Z alone. For texts without other characters lower() does the same, much faster."""
    plain = F.octet_length(col) == F.char_length(col)
    return F.when(plain, F.lower(col)).otherwise(F.translate(col, string.ascii_uppercase, string.ascii_lowercase))


def stable_hash(*cols: Column) -> Column:
    """60 bits of MD5 over the parts joined by '|', which other SQL engines can repeat."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *cols)), 1, 15), 16, 10).cast("long")


_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. A folder of our own only in local mode."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir is unset; a cluster has to name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="tramline-")
    return _own[app]


def saved(df: DataFrame) -> DataFrame:
    """The same rows from a table in the shared folder: lineage ends here and lost executors cost nothing twice."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tramline-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_at = path
    for run in _scratch:
        run.append(out)
    return out


_scratch: list[list[DataFrame]] = []


@contextmanager
def scratch(keep: list[DataFrame]):
    """Frees every table that saved() writes inside the block, when it ends, but those put into `keep`."""
    made: list[DataFrame] = []
    _scratch.append(made)
    try:
        yield
    finally:
        _scratch.remove(made)
        for df in made:
            if not any(df is k for k in keep):
                drop_saved(df)


def drop_saved(df: DataFrame) -> None:
    """Frees the table behind a frame from saved() that no later plan reads."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._saved_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """`run` for mapInArrow, which at its end gives back what its process holds but no longer uses: Python workers live
    on for the stages that follow, and else each keeps the most that it ever took."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            getattr(ctypes.CDLL(None), "malloc_trim", int)(0)  # glibc's; elsewhere nothing

    return whole


def ranked(df: DataFrame, order: Sequence[str], weight: str | None = None) -> DataFrame:
    """Adds `rank`, the place of each row in the global order from 0, and `before`, the sum of `weight` of all
    rows ahead of it. Rows are dealt by range over the whole order, so one hot leading value spreads over many
    tasks; the only table that is broadcast has one row for each partition."""
    spark, weight_of = df.sparkSession, weight
    schema = T.StructType([*df.schema.fields, T.StructField("__part", T.IntegerType()), T.StructField("__idx", T.LongType()), T.StructField("__before", T.LongType())])

    def number(batches):
        part, seen, total = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            n = b.num_rows
            w = b.column(b.schema.get_field_index(weight_of)).to_numpy(zero_copy_only=False).astype(np.int64) if weight_of else np.zeros(n, np.int64)
            ends = np.cumsum(w)
            more = [pa.array(np.full(n, part, np.int32)), pa.array(np.arange(seen, seen + n)), pa.array(total + ends - w)]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], names=[*b.schema.names, "__part", "__idx", "__before"])
            seen, total = seen + n, total + int(w.sum())

    numbered = saved(df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(lean(number), schema))
    weigh = F.col(weight) if weight else F.lit(0)
    parts = numbered.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"), F.sum(weigh).alias("__w"))
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("__part", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__n0"), F.coalesce(F.sum("__w").over(ahead), F.lit(0)).alias("__w0"))
    out = numbered.join(F.broadcast(starts), "__part")
    return out.select(*df.columns, (F.col("__n0") + F.col("__idx")).alias("rank"), (F.col("__w0") + F.col("__before")).cast("long").alias("before"))


def checked(df: DataFrame, limit: int = 200_000) -> DataFrame:
    """The frame marked for broadcast if a count finds at most `limit` rows, else left to an ordinary join."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


class Forest:
    """Union-find over any integers; the root of a tree is its smallest member."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        top = up.setdefault(x, x)
        while up[top] != top:
            up[top] = up[up[top]]
            top = up[top]
        up[x] = top
        return top

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def edges(self) -> pa.RecordBatch:
        nodes = [x for x in self.up if self.up[x] != x]
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([self.root(x) for x in nodes], pa.int64())], names=["u", "v"])


def _forest(batches):
    forest = Forest()
    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            forest.join(u, v)
    yield forest.edges()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected edges (u, v): a row (node, component) for each node that an edge
    names; component is the smallest node reachable. Each partition first keeps a spanning forest of its edges;
    then large-star and small-star rounds run until no edge changes. Each round ends in a shared table."""
    e = saved(edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u <> v").mapInArrow(lean(_forest), "u long, v long"))
    mark = None
    while True:
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.u", "x.v").where("u <> v").distinct()
        new = saved(small)
        now = new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop_saved(e)
        e = new
        if now == mark or not now[0]:
            break
        mark = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v")).distinct()

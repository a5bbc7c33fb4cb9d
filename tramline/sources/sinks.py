"""Writers: parts named by content, partitions replaced, tables published together, generations, and artifacts."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.plans.quality import missing_columns


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def digest(df: DataFrame) -> str:
    """A name for a frame's rows, whatever their order: sums of row hashes."""
    n, s = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()
    return f"{n:x}-{int(s or 0) % (1 << 64):016x}"


def append_once(df: DataFrame, path: str) -> str:
    """Adds the rows as a folder named by their content; a retry finds it and adds nothing. Works as a foreachBatch."""
    target = f"{path}/part={digest(df)}"
    fs, p = _fs(df.sparkSession, f"{target}/_SUCCESS")
    if not fs.exists(p):
        df.write.mode("overwrite").parquet(target)
    return target


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replaces exactly the partitions that the rows are in."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame], checks: Sequence[Callable[[dict[str, DataFrame]], None]] = ()) -> dict:
    """Writes tables as one generation, checks what was written, and only then points the manifest at it: readers see all
    of it or the one before. The manifest's rename is the one step that counts."""
    name = f"{time.time_ns()}-{uuid.uuid4().hex[:8]}"
    written = {}
    for table, df in tables.items():
        df.write.parquet(f"{root}/{name}/{table}")
        written[table] = spark.read.parquet(f"{root}/{name}/{table}")
        if written[table].count() != df.count():
            raise ValueError(f"{table}: rows written differ from rows given")
    for check in checks:
        check(written)
    manifest = {"generation": name, "tables": {t: digest(df) for t, df in written.items()}}
    fs, target = _fs(spark, f"{root}/manifest.json")
    _, draft = _fs(spark, f"{root}/manifest-{name}.json")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    if fs.exists(target):
        fs.delete(target, False)
    fs.rename(draft, target)
    return manifest


def current(spark: SparkSession, root: str) -> dict:
    fs, p = _fs(spark, f"{root}/manifest.json")
    if not fs.exists(p):
        return {}
    return json.loads("".join(r.value for r in spark.read.text(f"{root}/manifest.json").collect()))


def views(spark: SparkSession, root: str) -> list[str]:
    """A view for each table of the current generation."""
    m = current(spark, root)
    for table in m.get("tables", {}):
        spark.read.parquet(f"{root}/{m['generation']}/{table}").createOrReplaceTempView(table)
    return sorted(m.get("tables", {}))


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Deletes generations but the current one and the latest `keep`."""
    fs, p = _fs(spark, root)
    now = current(spark, root).get("generation")
    names = sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())
    gone = [n for n in names[:-keep] if n != now] if keep else [n for n in names if n != now]
    for n in gone:
        fs.delete(_fs(spark, f"{root}/{n}")[1], True)
    return gone


def changed_partitions(source: DataFrame, cached: DataFrame, by: str) -> DataFrame:
    """Partitions to write or drop: those whose rows' digest differs on either side."""
    sum_of = lambda df, n: df.groupBy(by).agg(F.count(F.lit(1)).alias(f"{n}_n"), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")).alias(f"{n}_s"))
    both = sum_of(source, "a").join(sum_of(cached, "b"), by, "full")
    change = F.when(F.col("b_n").isNull(), "add").when(F.col("a_n").isNull(), "drop").when((F.col("a_n") != F.col("b_n")) | (F.col("a_s") != F.col("b_s")), "replace")
    return both.select(by, change.alias("change")).where("change IS NOT NULL")


def write_artifact(df: DataFrame, path: str, contract: dict[str, str], required: Sequence[str] = (), unique: Sequence[str] = ()) -> None:
    """The rows cast to a contract's types and checked: not empty, no null where one isn't allowed, keys that don't
    repeat. Nothing stands at `path` unless all holds."""
    out = df.select(*[F.col(c).cast(t).alias(c) for c, t in contract.items()])
    if wrong := missing_columns(out, contract):
        raise ValueError(f"types: {wrong}")
    rows, *nulls = out.agg(F.count(F.lit(1)), *[F.count_if(F.col(c).isNull()) for c in required]).first()
    if not rows or any(nulls):
        raise ValueError(f"{rows} rows, nulls in {dict(zip(required, nulls, strict=True))}")
    if unique and not out.groupBy(*unique).count().where("count > 1").isEmpty():
        raise ValueError(f"{list(unique)} repeat")
    draft = f"{path}-{uuid.uuid4().hex[:8]}"
    out.write.parquet(draft)
    fs, target = _fs(df.sparkSession, path)
    if fs.exists(target):
        fs.delete(target, True)
    fs.rename(_fs(df.sparkSession, draft)[1], target)

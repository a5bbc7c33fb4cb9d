"""Published tables: a table that several others read is written once to the folder that all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_written: dict[tuple[str, str, str], str] = {}
_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a folder of our own only in local mode, where there is one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is unset; a cluster has to name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="tramline-tables-")
    return _own[app]


#: Joins on several keys keep rows that are dealt out by one of them (a trip's) where they are; a job's shuffle files go
#: when it ends, for nothing reads a table's plan again once the table is written.
_PLANNING = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.maxConcurrentOutputFileWriters": "4"}
#: From so many calls on, tables of trips are stored in buckets by trip_id, of about so many calls each: what is made of a
#: trip is then made where its bucket is read, without dealing anything out again.
BUCKETED_FROM, BUCKET_CALLS = 2_000_000, 250_000
_buckets: dict[tuple[str, str], int] = {}


@contextmanager
def planning(spark: SparkSession):
    before = {k: spark.conf.get(k, None) for k in _PLANNING}
    for k, v in _PLANNING.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return spark.sparkContext.applicationId, os.path.abspath(sf_dir) if "://" not in sf_dir else sf_dir


def buckets(spark: SparkSession, sf_dir: str) -> int:
    """In how many buckets tables of trips are stored, all in as many; 0: in none. Never fewer than a join would deal out."""
    key = _key(spark, sf_dir)
    if key not in _buckets:
        calls = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
        _buckets[key] = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-calls // BUCKET_CALLS)) if calls >= BUCKETED_FROM else 0
    return _buckets[key]


def written(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame], by_trip: bool = False) -> str:
    """The table `name` of a folder of inputs as SQL names it, built and written when it's first asked for in this
    application. `by_trip`: in buckets by trip_id, if the folder is large enough."""
    key = (*_key(spark, sf_dir), name)
    if key not in _written:
        own = f"{name}_{uuid.uuid4().hex}"
        path = f"{shared_folder(spark)}/{own}"
        rows = build()  # what it reads is written first, under the same settings
        n = buckets(spark, sf_dir) if by_trip else 0
        with planning(spark):
            if n:  # rows that already lie so aren't dealt out again
                rows.repartition(n, "trip_id").write.bucketBy(n, "trip_id").option("compression", "zstd").option("path", path).saveAsTable(f"default.{own}")
            else:
                rows.write.option("compression", "zstd").parquet(path)
        _written[key] = f"default.{own}" if n else f"parquet.`{path}`"
    return _written[key]


def published(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame], by_trip: bool = False) -> DataFrame:
    """The table `name` of a folder of inputs as a frame."""
    return spark.sql(f"SELECT * FROM {written(spark, sf_dir, name, build, by_trip)}")

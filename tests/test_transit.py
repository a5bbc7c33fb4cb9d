import datetime as dt
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from tramline import queries as Q
from tramline.functions import columns as C
from tramline.operators import relational as R
from tramline.streaming import health

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return str(v)[:26] if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    df = Q.QUERIES[name](spark, sf_dir)
    rel = con.sql(Q.ORACLES[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    at = [rel.columns.index(c) for c in cols]
    mine = sorted(repr([plain(r[c]) for c in cols]) for r in df.collect())
    assert mine == sorted(repr([plain(r[i]) for i in at]) for r in rel.fetchall())


def test_on_time_boundaries(spark):
    got = spark.createDataFrame([(-60,), (-59,), (179,), (180,)], "d int").agg(*C.delay_block(F.col("d"))).first()
    assert (got.early_count, got.on_time_count, got.late_count, got.on_time_rate, got.median_delay) == (1, 2, 1, 0.5, 60.0)


def test_overnight_times_and_clock_changes(spark):
    rows = [("25:11:04", 90664), ("00:00:00", 0), ("7:5:00", None), (None, None), ("99:59:59", 359999)]
    got = spark.createDataFrame([(t,) for t, _ in rows], "t string").select(C.gtfs_seconds(F.col("t"))).collect()
    assert [r[0] for r in got] == [s for _, s in rows]
    days = spark.createDataFrame([(dt.date(2026, 3, 29),), (dt.date(2026, 10, 25),)], "d date")
    got = days.select(C.scheduled_time(F.col("d"), F.lit(0)).cast("string")).collect()
    assert [r[0] for r in got] == ["2026-03-28 22:00:00", "2026-10-24 23:00:00"]


def test_versions_open_a_new_period_when_a_state_returns(spark):
    day = lambda n: dt.date(2026, 1, n)
    daily = spark.createDataFrame([("a", day(2), "x"), ("a", day(3), "x"), ("a", day(4), "y"), ("a", day(6), "x")], "k string, day date, s string")
    got = sorted(tuple(r) for r in R.versions(daily, ["k"], "day", "s").collect())
    assert got == [("a", "x", day(2), day(3)), ("a", "x", day(6), None), ("a", "y", day(4), day(5))]
    spine = spark.createDataFrame([(day(n),) for n in range(2, 8)], "day date")
    got = sorted(tuple(r) for r in R.scd2(daily, spine, ["k"], "day", "s").collect())
    assert got == [("a", "x", day(2), day(3)), ("a", "x", day(6), day(6)), ("a", "y", day(4), day(4))]


def test_incidents(spark):
    rows = [("m", i, i in (2, 3, 4, 8, 11, 12, 13)) for i in range(14)]
    got = sorted(tuple(r) for r in health.incidents(spark.createDataFrame(rows, "k string, i int, bad boolean"), ["k"], "i", "bad", 3).collect())
    assert got == [("m", 2, 5, 3), ("m", 11, None, 3)]


def test_grid_join_equals_all_pairs(spark):
    import random

    rng = random.Random(1)
    pts = [(i, rng.uniform(-2, 2), rng.uniform(-2, 2)) for i in range(120)]
    df = spark.createDataFrame(pts, "i int, x double, y double")
    got = {(r.i, r.r_i) for r in R.grid_join(df, df, "x", "y", 0.3).collect()}
    assert got == {(a[0], b[0]) for a in pts for b in pts if math.dist(a[1:], b[1:]) <= 0.3}


def test_search_key_and_easter(spark):
    got = spark.createDataFrame([("  Żółta   ŁĄKA ",)], "t string").select(C.search_key(F.col("t"))).first()[0]
    assert got == "zolta laka"
    got = spark.createDataFrame([(2024,), (2025,), (2026,)], "y int").select(C.easter(F.col("y"))).collect()
    assert [r[0] for r in got] == [dt.date(2024, 3, 31), dt.date(2025, 4, 20), dt.date(2026, 4, 5)]

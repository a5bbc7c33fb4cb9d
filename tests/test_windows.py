"""Entity windows: arrivals are folded where their trip lies, ranks are found for stop lists, and rows are the same."""

import pytest
from pyspark.sql import functions as F

from tests.test_buckets import dealt, large  # noqa: F401
from tramline.functions import columns as C
from tramline.plans import marts as M
from tramline.plans import schedule as S
from tramline.queries_facts import _flagged_trips, flagged_serving, timetable, versions
from tramline.queries_marts import _windows, until
from tramline.queries_schedule import _f, _history


def test_entity_windows_deal_out_no_trips(spark, large):  # noqa: F811
    rows = M.entity_windows(flagged_serving(spark, large), _windows(spark, large), versions(spark, large), until())
    assert not [k for k in dealt(spark, rows) if "trip_id" in k or "trip_key" in k or k.startswith("run")]


def test_flag_of_trips_is_that_of_the_universe(spark, sf_dir):
    u = S.trip_universe(S.stop_profiles(_f(spark, sf_dir), _history(spark, sf_dir)))
    key = ["gtfs_snapshot_id", "trip_id", "service_date", "gps_date"]
    want = {tuple(r) for r in u.where("is_zone1_public_ranking_trip").withColumn("gps_date", F.col("processing_date")).select(*key).collect()}
    got = _flagged_trips(spark, sf_dir).select(*key, "is_ranked").collect()
    assert {r[4] for r in got} == {True, False} and all(r[4] == (tuple(r[:4]) in want) for r in got)


def test_a_trip_id_given_twice_is_ranked_by_either_row(spark, sf_dir):
    """As in the SQL, which asks whether a ranked row of the trip exists."""
    f, timed = _f(spark, sf_dir), timetable(spark, sf_dir)
    governed = S.processing_snapshots(f)
    once = {(r[0], r[1]): set(r[2]) for r in S.ranked_days(f, governed, timed).collect()}
    key = next(iter(once))
    other = timed.where((F.col("trip_id") == key[0]) & (F.col("gtfs_snapshot_id") == key[1])).withColumn("line", F.lit("C8"))
    twice = [r for r in S.ranked_days(f, governed, timed.unionByName(other)).collect() if (r[0], r[1]) == key]
    assert len(twice) == 1 and set(twice[0][2]) == once[key]


def test_equal_delays_count_as_often_as_they_occur(spark):
    rows = [(k, d, n) for k, ds in (("a", [(None, 2), (-400, 3), (-60, 1), (0, 4), (179, 2), (180, 5), (1201, 1)]), ("b", [(None, 3)]), ("c", [(7, 1)])) for d, n in ds]
    folded = spark.createDataFrame(rows, "k string, d long, n long")
    whole = folded.select("k", "d", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    d = F.col("d")
    want = whole.groupBy("k").agg(*C.delay_block(d), C.delay_histogram(d).alias("h")).orderBy("k").collect()
    got = folded.groupBy("k").agg(*C.delay_block(d, F.col("n")), C.delay_histogram(d, F.col("n")).alias("h")).orderBy("k").collect()
    assert [r.asDict(True) for r in got] == [r.asDict(True) for r in want] and got[1].mean_delay is None and got[0].mean_delay == pytest.approx(sum(x[1] * x[2] for x in rows[1:7]) / 16)

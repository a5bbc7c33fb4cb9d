"""What is a matter of a trip alone is stored and met once for each trip, and days give the same rows as before."""

from collections import Counter

from tramline.queries_facts import history, timetable
from tramline.queries_schedule import _f, _history
from tramline.sources.feeds import feed


def test_timetables_have_a_row_for_each_trip(spark, sf_dir):
    stored = timetable(spark, sf_dir)
    assert stored.count() == stored.select("gtfs_snapshot_id", "trip_id").distinct().count() > 0
    cols = stored.join(history(spark, sf_dir).limit(0), ["trip_id"], "left_anti").columns
    assert "processing_date" not in cols and "service_date" not in cols


def test_days_of_stored_timetables_equal_the_history(spark, sf_dir):
    got = history(spark, sf_dir)
    assert Counter(got.collect()) == Counter(_history(spark, sf_dir).select(*got.columns).collect())


def test_calls_times_runs_are_the_semantics(spark, sf_dir):
    runs = feed(spark, sf_dir, "matcher_runs").select("processing_date", "service_date", "gtfs_snapshot_id", "trip_id").distinct()
    want = feed(spark, sf_dir, "matcher_semantics").drop("scheduled_s")
    got = _f(spark, sf_dir)("matcher_calls").join(runs, ["gtfs_snapshot_id", "trip_id"]).select(*want.columns)
    assert Counter(got.collect()) == Counter(want.collect())

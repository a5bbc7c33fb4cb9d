"""Tables of trips in buckets: what is made of a trip isn't dealt out again, and rows are the same."""

import re
from collections import Counter

import pytest

from tramline.plans import facts as X
from tramline.plans import schedule as S
from tramline.plans import travel as T
from tramline.queries_facts import _trips, arrival_table, event_table, history, timetable
from tramline.queries_schedule import _f
from tramline.sources import published as P


@pytest.fixture
def large(spark, sf_dir, monkeypatch):
    """The same folder by another name, which counts as a large one; nothing is small enough to broadcast by itself."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    monkeypatch.setattr(P, "BUCKETED_FROM", 0)
    spark.conf.set(key, "-1")
    yield f"file://{sf_dir}"
    spark.conf.set(key, before)


def dealt(spark, df):
    with P.planning(spark):
        plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", k) for k in re.findall(r"Exchange hashpartitioning\((.*), \d+\)", plan)]


def test_bucketed_arrivals_deal_out_no_calls(spark, large):
    """Only the timetable's trips are, once: they come from another table."""
    rows = X.arrivals(_f(spark, large), _trips(spark, large), "is_served")
    assert [k for k in dealt(spark, rows) if "trip_id" in k] == ["trip_id"]


def test_segments_of_bucketed_arrivals_are_not_dealt_out(spark, large):
    seg = T.segments(arrival_table(spark, large), S.stops(_f(spark, large)))
    assert not [k for k in dealt(spark, seg) if "trip_id" in k]


def test_bucketed_tables_hold_the_same_rows(spark, sf_dir, large):
    for table in (_trips, arrival_table, event_table):
        want = table(spark, sf_dir)
        assert Counter(table(spark, large).select(*want.columns).collect()) == Counter(want.collect())


def test_fingerprints_by_service_are_those_of_the_history(spark, sf_dir):
    f = _f(spark, sf_dir)
    want = S.fingerprints(history(spark, sf_dir))
    got = S.service_fingerprints(f, S.processing_snapshots(f), timetable(spark, sf_dir))
    assert Counter(got.select(*want.columns).collect()) == Counter(want.collect())

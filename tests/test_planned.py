"""Feeds in Spark's order of joins hold the same rows."""

import re
from collections import Counter

import pytest

from tramline.plans import facts as X
from tramline.queries_facts import _trips, trip_table
from tramline.queries_schedule import _f
from tramline.sources.feeds import FEEDS, PLANNED, feed
from tramline.sources.published import planning


def plain(spark, sf_dir, name):
    """A feed by the text that other engines read."""
    tables = {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in ("region", "nation", "supplier", "orders", "lineitem", "events", "part", "customer")}
    return spark.sql("WITH " + ", ".join(f"{n} AS ({s.format(**tables)})" for n, s in FEEDS.items()) + f" SELECT * FROM {name}")


@pytest.mark.parametrize("name", sorted(set(PLANNED) & set(FEEDS)) + ["raw_timed", "matcher_arrivals", "matcher_semantics"])
def test_planned_feeds_hold_the_same_rows(spark, sf_dir, name):
    assert Counter(feed(spark, sf_dir, name).collect()) == Counter(plain(spark, sf_dir, name).collect())


def test_arrivals_are_dealt_out_by_trip_alone(spark, sf_dir):
    """As planned for tables too large to broadcast."""
    trip, key = _trips(spark, sf_dir), "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        with planning(spark):
            plan = X.arrivals(_f(spark, sf_dir), trip, "is_served")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    keys = {re.sub(r"#\d+L?", "", k) for k in re.findall(r"Exchange hashpartitioning\((.*), \d+\)", plan)}
    assert {k for k in keys if "trip_id" in k} == {"trip_id"}


def test_executions_are_a_flag_of_trips(spark, sf_dir):
    flagged = _trips(spark, sf_dir).where("is_served").drop("is_served")
    assert Counter(flagged.collect()) == Counter(X.executions(trip_table(spark, sf_dir)).collect())

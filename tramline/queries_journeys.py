"""Registered queries on journeys, each with SQL written from the rules and not from the code."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.plans import journeys as J
from tramline.plans import schedule as S
from tramline.queries_facts import history
from tramline.queries_schedule import ONE, _f
from tramline.queries_travel import footpaths
from tramline.registry import ORACLES, PARTS, query
from tramline.sources.published import published

#: The day whose timetable is searched.
DAY = "2024-03-28"
#: Late against usual rides, by the ride's seconds (over, up to, ratio).
CELLS = [(0, 600, 1.3), (600, 1800, 1.2), (1800, 3600, 1.15)]
DEPARTURES = (28800, 30600, 32400)

_LATE = "CASE WHEN {0} <= 600 THEN {0} * 1.3::DOUBLE WHEN {0} <= 1800 THEN greatest(780, {0} * 1.2::DOUBLE) WHEN {0} <= 3600 THEN greatest(2160, {0} * 1.15::DOUBLE) ELSE greatest(3600 * 1.15::DOUBLE, {0} * 1.1::DOUBLE) END"
_SAME = "o.request = x.request AND o.stop_id = x.stop_id AND o.t <= x.t"
PARTS |= {
    "j_calls": f"SELECT s.trip_id, s.stop_sequence AS pos, s.stop_id, s.departure_s AS dep_s, s.arrival_s AS arr_s, coalesce(s.pickup_type, 0) <> 1 AS may_board, coalesce(s.drop_off_type, 0) <> 1 AS may_alight FROM o_times s WHERE s.gtfs_snapshot_id = '{ONE}' AND s.departure_s IS NOT NULL AND s.arrival_s IS NOT NULL AND EXISTS (SELECT 1 FROM o_history h WHERE h.gtfs_snapshot_id = s.gtfs_snapshot_id AND h.trip_id = s.trip_id AND h.service_date = DATE '{DAY}' AND h.processing_date = DATE '{DAY}')",
    "j_walks": ORACLES["footpaths"],
    "j_edges": "SELECT from_stop_id, to_stop_id, min(s)::BIGINT AS s FROM (SELECT lag(stop_id) OVER w AS from_stop_id, stop_id AS to_stop_id, greatest(0, arr_s - lag(dep_s) OVER w) AS s FROM j_calls WINDOW w AS (PARTITION BY trip_id ORDER BY pos) UNION ALL SELECT from_stop_id, to_stop_id, walk_s FROM j_walks) x WHERE from_stop_id IS NOT NULL GROUP BY 1, 2",
    "j_hop_0": "SELECT from_stop_id, to_stop_id, min(s) AS s FROM (SELECT * FROM j_edges WHERE s <= 10800 UNION ALL SELECT stop_id, stop_id, 0 FROM j_calls) x GROUP BY 1, 2",
    "j_asked": "SELECT x.stop_id || '@' || d AS request, x.stop_id, d::BIGINT AS depart_s FROM (SELECT DISTINCT stop_id FROM j_calls WHERE stop_id LIKE '%01') x CROSS JOIN (SELECT unnest([28800, 30600, 32400]) AS d) y",
    "j_reached_0": "SELECT request, until_s, stop_id, min(t) AS t FROM (SELECT request, depart_s + 10800 AS until_s, stop_id, depart_s AS t FROM j_asked UNION ALL SELECT a.request, a.depart_s + 10800, w.to_stop_id, a.depart_s + w.walk_s FROM j_asked a JOIN j_walks w ON w.from_stop_id = a.stop_id) x GROUP BY 1, 2, 3",
}
for _n in range(1, 6):  # paths twice as long each time
    PARTS[f"j_hop_{_n}"] = f"SELECT a.from_stop_id, b.to_stop_id, min(a.s + b.s) AS s FROM j_hop_{_n - 1} a JOIN j_hop_{_n - 1} b ON b.from_stop_id = a.to_stop_id WHERE a.s + b.s <= 10800 GROUP BY 1, 2"
for _n in range(1, 6):
    _rides = " UNION ALL ".join(f"SELECT * FROM j_rode_{k}" for k in range(1, _n)) or "SELECT * FROM j_reached_0 WHERE false"
    _before = " UNION ALL ".join(f"SELECT * FROM j_reached_{k}" for k in range(_n))
    PARTS[f"j_rode_{_n}"] = f"""SELECT * FROM (SELECT f.request, f.until_s, a.stop_id, min(greatest(ceil(b.dep_s + {_LATE.format('greatest(0, a.arr_s - b.dep_s)')}), a.arr_s, b.dep_s))::BIGINT AS t FROM j_reached_{_n - 1} f JOIN j_calls b ON b.stop_id = f.stop_id AND b.may_board AND b.dep_s >= f.t AND b.dep_s < f.until_s JOIN j_calls a ON a.trip_id = b.trip_id AND a.pos > b.pos AND a.may_alight GROUP BY 1, 2, 3) x WHERE t < until_s AND NOT EXISTS (SELECT 1 FROM ({_rides}) o WHERE {_SAME})"""
    PARTS[f"j_reached_{_n}"] = f"""SELECT * FROM (SELECT request, until_s, stop_id, min(t) AS t FROM (SELECT * FROM j_rode_{_n} UNION ALL SELECT r.request, r.until_s, w.to_stop_id, r.t + w.walk_s FROM j_rode_{_n} r JOIN j_walks w ON w.from_stop_id = r.stop_id WHERE r.t + w.walk_s < r.until_s) y GROUP BY 1, 2, 3) x WHERE NOT EXISTS (SELECT 1 FROM ({_before}) o WHERE {_SAME})"""
PARTS["j_found"] = " UNION ALL ".join(f"SELECT request, stop_id, {n} AS vehicles, t FROM j_reached_{n}" for n in range(1, 6))
PARTS["j_journeys"] = "SELECT split_part(request, '@', 1) AS origin, stop_id, split_part(request, '@', 2)::BIGINT AS depart_s, t, vehicles FROM j_found"


def _calls(spark, d):
    def build():
        day = F.lit(DAY).cast("date")
        trips = history(spark, d).where((F.col(S.SNAP) == ONE) & (F.col("service_date") == day) & (F.col("processing_date") == day)).select("trip_id").distinct()
        t = S.of_snapshots(S.stop_times(_f(spark, d)), [ONE]).where("departure_s IS NOT NULL AND arrival_s IS NOT NULL").join(trips, "trip_id", "left_semi")
        allowed = lambda c: F.coalesce(F.col(c), F.lit(0)) != 1
        return t.select("trip_id", F.col("stop_sequence").alias("pos"), "stop_id", F.col("departure_s").alias("dep_s"), F.col("arrival_s").alias("arr_s"), allowed("pickup_type").alias("may_board"), allowed("drop_off_type").alias("may_alight"))

    return published(spark, d, "network_calls", build)


def _walks(spark, d):
    return published(spark, d, "network_walks", lambda: footpaths(spark, d))


def _keeper(spark, d):
    return lambda name, df: published(spark, d, f"journeys_{name}", lambda: df)


def _found(spark, d):
    calls = _calls(spark, d)
    asked = calls.where("stop_id LIKE '%01'").select("stop_id").distinct().select("stop_id", F.explode(F.array(*map(F.lit, DEPARTURES))).alias("depart_s"))
    asked = asked.withColumn("request", F.concat_ws("@", "stop_id", "depart_s"))
    return J.search(asked, calls, _walks(spark, d), _keeper(spark, d), lambda s: J.late_ride(s, CELLS))


@query("SELECT pattern, n AS stops, count(*) AS trips, min(s) AS first_s FROM (SELECT trip_id, string_agg(stop_id || CASE WHEN may_alight THEN '' ELSE '!' END, '>' ORDER BY pos) AS pattern, count(*) AS n, min(dep_s) AS s FROM j_calls GROUP BY 1) x GROUP BY 1, 2")
def network_patterns(spark, d):
    return J.patterns(_calls(spark, d))


@query("SELECT to_stop_id AS target, from_stop_id AS stop_id, s FROM j_hop_5 WHERE to_stop_id IN (SELECT stop_id FROM j_calls)")
def journey_lower_bounds(spark, d):
    """Least seconds from every stop to each stop that the day calls at."""
    calls = _calls(spark, d)
    return J.lower_bounds(J.shortest_edges(calls, _walks(spark, d)), calls.select(F.col("stop_id").alias("target")).distinct(), _keeper(spark, d))


@query(f"SELECT ride_s::BIGINT AS ride_s, {_LATE.format('ride_s')} AS late_s FROM (SELECT unnest(range(0, 10800, 50)) AS ride_s) x")
def late_envelope(spark, d):
    return spark.range(0, 10800, 50).select(F.col("id").alias("ride_s"), J.late_ride(F.col("id"), CELLS).alias("late_s"))


@query("SELECT request, stop_id, vehicles, t FROM j_found")
def journey_search(spark, d):
    """Where each stop's first post leads at three times of the day, with up to five vehicles."""
    return _found(spark, d)


@query("SELECT origin, stop_id, depart_s, t, vehicles FROM j_journeys j WHERE NOT EXISTS (SELECT 1 FROM j_journeys o WHERE o.origin = j.origin AND o.stop_id = j.stop_id AND o.depart_s >= j.depart_s AND o.t <= j.t AND o.vehicles <= j.vehicles AND (o.depart_s > j.depart_s OR o.t < j.t OR o.vehicles < j.vehicles))")
def journey_profile(spark, d):
    """Journeys over all departures that no other dominates."""
    origin, leaves = F.split("request", "@")[0], F.split("request", "@")[1].cast("long")
    j = _found(spark, d).select(origin.alias("request"), "stop_id", leaves.alias("depart_s"), "t", "vehicles")
    return J.undominated(j).withColumnRenamed("request", "origin")

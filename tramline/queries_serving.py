"""Registered lookups of served pages, each with SQL written from the rules and not from the code."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.plans import marts as M
from tramline.plans import schedule as S
from tramline.plans import serving as V
from tramline.plans import travel as T
from tramline.queries_facts import event_table, execution_table, versions
from tramline.queries_health import _based, _incidents
from tramline.queries_marts import END, _base, _eligible, _windows, entity_table, serving_table, until
from tramline.queries_schedule import ONE, _f, dim_stop_group_current
from tramline.queries_travel import _fitted, keyed_table
from tramline.registry import ORACLES, PARTS, query
from tramline.sources.published import published

for _name in ("line_reliability", "worst_delay_events", "entity_window_daily", "entity_timeline", "entity_rankings", "line_course_window", "line_course_stop_window", "trip_daily", "expected_stop_times", "dim_line_current", "dim_stop_group_current"):
    PARTS[f"v_{_name}"] = ORACLES[_name]
_SCOPE = f"(w.window_type NOT IN ('weekdays', 'weekend') OR EXISTS (SELECT 1 FROM o_versions v WHERE v.schedule_version_id = t.schedule_version_id AND DATE '{END}' BETWEEN v.valid_from_date AND coalesce(v.valid_to_date, DATE '9999-12-31')))"
PARTS |= {
    "o_typed": "SELECT * FROM (VALUES (1, '1004', 'Stop 1004'), (2, '1004', 'zolta'), (3, NULL, '  STOP 10'), (4, '1002', NULL), (5, 'gone', NULL), (6, NULL, 'x'), (7, '9999', 'bis')) t(request, chosen, typed)",
    "o_grouped": f"SELECT stop_group_id, stop_group_name, stop_post_count AS visits, lower(strip_accents(replace(replace(stop_group_name, 'ł', 'l'), 'Ł', 'L'))) AS k FROM o_group_states WHERE gtfs_snapshot_id = '{ONE}'",
    "o_point": "SELECT *, count(*) OVER p AS n, point_rank - 1 AS i, least(0.55::DOUBLE, 100.0::DOUBLE / greatest(1, count(*) OVER p - 1)) AS gap FROM v_entity_timeline WINDOW p AS (PARTITION BY entity_type, entity_id, mode, service_date)",
    "o_forward": "SELECT a.entity_type, a.entity_id, a.mode, a.service_date, a.i, a.n, a.gap, a.x_percent, max(b.x_percent + (a.i - b.i) * a.gap) AS x FROM o_point a JOIN o_point b ON b.entity_type = a.entity_type AND b.entity_id = a.entity_id AND b.mode = a.mode AND b.service_date = a.service_date AND b.i <= a.i GROUP BY 1, 2, 3, 4, 5, 6, 7, 8",
    "o_fitted": "SELECT * EXCLUDE (x), x - greatest(max(x) OVER (PARTITION BY entity_type, entity_id, mode, service_date) - 100, 0) AS x FROM o_forward",
    "o_backward": "SELECT a.entity_type, a.entity_id, a.mode, a.service_date, a.i, a.n, a.x_percent, min(b.x - (b.i - a.i) * a.gap) AS x FROM o_fitted a JOIN o_fitted b ON b.entity_type = a.entity_type AND b.entity_id = a.entity_id AND b.mode = a.mode AND b.service_date = a.service_date AND b.i >= a.i GROUP BY 1, 2, 3, 4, 5, 6, 7",
}


def _versions_windows(spark, d):
    return _windows(spark, d), versions(spark, d), until()


def _reliability(spark, d):
    return published(spark, d, "line_reliability", lambda: M.reliability(execution_table(spark, d)))


@query("SELECT line, mode, route_short_name, (row_number() OVER (ORDER BY try_cast(line AS BIGINT) NULLS LAST, line))::INT AS place FROM v_dim_line_current")
def lines_list(spark, d):
    """All lines of the current timetable, numbers first; they are a few hundred."""
    from pyspark.sql import Window

    lines = S.line_current(_f(spark, d), ONE)
    return lines.select("line", "mode", "route_short_name", F.row_number().over(Window.orderBy(V.line_number().asc_nulls_last(), "line")).alias("place"))


@query("SELECT stop_group_id, stop_group_name, lines_served FROM v_dim_stop_group_current WHERE list_contains(string_split(modes_served, ', '), 'bus') AND lower(stop_group_name) LIKE '%op 10%' ORDER BY stop_group_name, stop_group_id LIMIT 21")
def stops_page(spark, d):
    """A page of twenty stop groups that buses call at, and one more to tell whether there's a next page."""
    g = dim_stop_group_current(spark, d).where(F.array_contains(F.split("modes_served", ", "), "bus") & F.lower("stop_group_name").like("%op 10%"))
    return g.orderBy("stop_group_name", "stop_group_id").limit(21).select("stop_group_id", "stop_group_name", "lines_served")


@query(f"""SELECT mode, line, window_type, window_key, count(*) AS trip_count, avg(CASE WHEN end_delay_seconds > -60 AND end_delay_seconds < 180 THEN 1 ELSE 0 END) AS on_time_share, median(end_delay_seconds) AS median_end_delay FROM o_execution t JOIN o_windows w ON w.service_date = t.service_date WHERE t.trip_quality = 'complete' AND {_SCOPE} GROUP BY 1, 2, 3, 4""")
def schedule_lines(spark, d):
    return V.schedule_lines(V.in_period(execution_table(spark, d), *_versions_windows(spark, d)))


@query(f"""SELECT mode, line, direction_id, trip_headsign, window_type, window_key, sum(clean_count)::BIGINT AS clean_count, sum(partial_count)::BIGINT AS partial_count, sum(broken_count)::BIGINT AS broken_count, array_to_string(list_slice(flatten(list(string_split(outcomes, ',') ORDER BY t.service_date, display_rank)), 1, 160), ',') AS outcomes FROM v_line_reliability t JOIN o_windows w ON w.service_date = t.service_date WHERE {_SCOPE} GROUP BY 1, 2, 3, 4, 5, 6""")
def period_reliability(spark, d):
    r = V.period_reliability(V.in_period(_reliability(spark, d), *_versions_windows(spark, d)))
    return r.withColumn("outcomes", F.array_join(F.transform("outcomes", lambda x: F.concat_ws("/", x["trip_id"], x["vehicle_number"], x["outcome"], x["label"])), ","))


@query("""SELECT scope_id AS line, mode, window_type, window_key, service_date, trip_id, vehicle_number, stop_id, delay_seconds, CASE WHEN window_type = 'day' THEN time_label ELSE strftime(service_date, '%d %b') || ' · ' || time_label END AS time, place FROM (SELECT t.*, w.window_type, w.window_key, (row_number() OVER (PARTITION BY mode, scope_id, window_type, window_key ORDER BY delay_seconds DESC, t.service_date DESC, scheduled_arrival_s, trip_id, vehicle_number, stop_id))::INT AS place FROM v_worst_delay_events t JOIN o_windows w ON w.service_date = t.service_date WHERE scope_type = 'line') x WHERE place <= 6""")
def period_worst(spark, d):
    """The six worst events of each line over each window."""
    p = V.period_worst(M.worst_events(serving_table(spark, d)), _windows(spark, d))
    time = F.when(F.col("window_type") == "day", F.col("time_label")).otherwise(F.concat(F.date_format("service_date", "dd MMM"), F.lit(" · "), "time_label"))
    return p.select(F.col("scope_id").alias("line"), "mode", *V.PERIOD, "service_date", "trip_id", "vehicle_number", "stop_id", "delay_seconds", time.alias("time"), "place")


@query("SELECT * EXCLUDE (back), (row_number() OVER (PARTITION BY entity_type, entity_id, mode, window_type, window_key ORDER BY service_date))::INT AS bar FROM (SELECT *, row_number() OVER (PARTITION BY entity_type, entity_id, mode, window_type, window_key ORDER BY service_date DESC) AS back FROM v_entity_window_daily) x WHERE back <= 12")
def window_comparison(spark, d):
    return V.window_comparison(M.daily_in_windows(_base(spark, d)))


@query("""SELECT entity_type, entity_id, mode, service_date, (i + 1)::INT AS point_rank, round(CASE WHEN n <= 1 THEN x_percent ELSE least(100, greatest(0, x + greatest(0, -min(x) OVER (PARTITION BY entity_type, entity_id, mode, service_date)))) END, 6) AS x FROM o_backward""")
def timeline_spread(spark, d):
    s = V.spread(M.timeline(serving_table(spark, d)), ["entity_type", "entity_id", "mode", "service_date"])
    return s.select("entity_type", "entity_id", "mode", "service_date", "point_rank", F.round("x", 6).alias("x"))


_COURSE = "c.line = s.line AND c.mode = s.mode AND c.direction_id = s.direction_id AND c.trip_headsign IS NOT DISTINCT FROM s.trip_headsign AND c.route_pattern_id = s.route_pattern_id AND c.window_type = s.window_type AND c.window_key = s.window_key"


@query(f"""SELECT line, mode, window_type, window_key, direction_id, pattern_status, origin_stop_name, destination_stop_name, headsign, family, arg_min(route_pattern_id, course_rank) AS main_pattern_id, sum(trip_count)::BIGINT AS trip_count, count(*) - 1 AS deviations, (row_number() OVER (PARTITION BY line, mode, window_type, window_key, direction_id, pattern_status, origin_stop_name, destination_stop_name, headsign ORDER BY sum(trip_count) DESC, min(course_rank)))::INT AS family_rank
  FROM (SELECT c.*, CASE WHEN pattern_status <> 'classified' THEN c.trip_headsign END AS headsign, coalesce((SELECT string_agg(s.stop_group_id, '>' ORDER BY s.call_position) FROM v_line_course_stop_window s LEFT JOIN v_line_course_stop_window b ON b.line = s.line AND b.mode = s.mode AND b.direction_id = s.direction_id AND b.trip_headsign IS NOT DISTINCT FROM s.trip_headsign AND b.route_pattern_id = s.route_pattern_id AND b.window_type = s.window_type AND b.window_key = s.window_key AND b.call_position = s.call_position - 1 WHERE {_COURSE} AND b.stop_group_id IS DISTINCT FROM s.stop_group_id), c.route_pattern_id) AS family FROM v_line_course_window c) x GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10""")
def route_families(spark, d):
    courses = M.courses(_eligible(spark, d))
    return V.route_families(courses, M.course_stops(_eligible(spark, d), M.window_arrivals(serving_table(spark, d))))


@query("SELECT r.entity_type, r.entity_id, r.mode, r.window_type, r.window_key, r.metric, r.value, r.position, r.n_entities, e.arrivals, e.median_delay, e.route_label FROM v_entity_rankings r JOIN o_entity e ON e.entity_type = r.entity_type AND e.entity_id = r.entity_id AND e.mode = r.mode AND e.window_type = r.window_type AND e.window_key = r.window_key AND e.universe_type = 'zone1_public' WHERE r.position BETWEEN 1 AND 25")
def ranked_page(spark, d):
    """The first page of each ranking, with what the entities' summaries say."""
    e = entity_table(spark, d)
    s = e.select("entity_type", "entity_id", "mode", "universe_type", *V.PERIOD, "arrivals", "median_delay", "route_label")
    return V.ranked_summaries(M.rankings(e), s, 1, 25)


@query("SELECT service_date, mode, line, trip_id, vehicle_number, sorted_by, place FROM (SELECT service_date, mode, line, trip_id, vehicle_number, 'departure' AS sorted_by, departure_rank AS place FROM v_trip_daily UNION ALL SELECT service_date, mode, line, trip_id, vehicle_number, 'delay', line_end_delay_rank FROM v_trip_daily UNION ALL SELECT service_date, mode, line, trip_id, vehicle_number, 'erratic', line_erratic_rank FROM v_trip_daily) x WHERE place <= 5")
def line_trip_pages(spark, d):
    return V.trip_pages(M.trip_days(execution_table(spark, d), event_table(spark, d)), 5)


@query("""SELECT d.service_date, (SELECT max(x.service_date) FROM o_observed x WHERE date_trunc('month', x.service_date) = (SELECT max(date_trunc('month', y.service_date)) FROM o_observed y WHERE date_trunc('month', y.service_date) < date_trunc('month', d.service_date))) AS previous_month, (SELECT max(x.service_date) FROM o_observed x WHERE date_trunc('month', x.service_date) = (SELECT min(date_trunc('month', y.service_date)) FROM o_observed y WHERE date_trunc('month', y.service_date) > date_trunc('month', d.service_date))) AS next_month,
  (SELECT max(x.service_date) FROM o_observed x WHERE x.service_date <= d.service_date - 7) AS previous_week, (SELECT min(x.service_date) FROM o_observed x WHERE x.service_date >= d.service_date + 7) AS next_week FROM o_observed d""")
def date_navigation(spark, d):
    return V.date_neighbours(M.observed_dates(serving_table(spark, d)).select("service_date"))


@query("SELECT window_type FROM (SELECT DISTINCT window_type, 'windows' AS t FROM o_windows UNION SELECT DISTINCT window_type, 'summaries' FROM o_entity UNION SELECT DISTINCT window_type, 'daily' FROM v_entity_window_daily) x GROUP BY 1 HAVING count(DISTINCT t) = 3")
def window_availability(spark, d):
    """Windows that all three tables hold. Days within windows have a row for the mode of each arrival, so the dates and
    versions of arrivals tell their windows."""
    dated = M.window_arrivals(serving_table(spark, d)).select("service_date", "schedule_version_id", "mode").distinct()
    daily = M.fanned(M.in_windows(dated, *_versions_windows(spark, d)), {"mode": "mode"})
    tables = {"windows": _windows(spark, d), "summaries": entity_table(spark, d), "daily": daily}
    held = [t.select("window_type", F.lit(n).alias("t")).distinct() for n, t in tables.items()]
    return held[0].unionByName(held[1]).unionByName(held[2]).groupBy("window_type").agg(F.countDistinct("t").alias("n")).where("n = 3").select("window_type")


@query("""SELECT request, stop_group_id, stop_group_name FROM (SELECT q.request, g.stop_group_id, g.stop_group_name, row_number() OVER (PARTITION BY q.request ORDER BY g.stop_group_id = q.chosen AND (q.typed IS NULL OR g.k = q.t) DESC, g.k = q.t DESC, starts_with(g.k, q.t) DESC, contains(g.k, ' ' || q.t) DESC, visits DESC, stop_group_name, stop_group_id) AS r
  FROM (SELECT *, lower(strip_accents(trim(typed))) AS t FROM o_typed) q JOIN o_grouped g ON (g.stop_group_id = q.chosen AND (q.typed IS NULL OR g.k = q.t)) OR (length(q.t) >= 2 AND contains(g.k, q.t) AND NOT EXISTS (SELECT 1 FROM o_grouped c WHERE c.stop_group_id = q.chosen AND c.k = q.t))) x WHERE r = 1""")
def resolved_stop_groups(spark, d):
    asked = spark.createDataFrame([(1, "1004", "Stop 1004"), (2, "1004", "zolta"), (3, None, "  STOP 10"), (4, "1002", None), (5, "gone", None), (6, None, "x"), (7, "9999", "bis")], "request int, chosen string, typed string")
    g = published(spark, d, "group_states", lambda: S.group_states(S.stops(_f(spark, d))).where(F.col(S.SNAP) == ONE))
    return V.resolved_groups(asked, g.select("stop_group_id", "stop_group_name", F.col("stop_post_count").alias("visits")))


@query("""SELECT service_date, trip_id, vehicle_number, stop_sequence, ((shown + 30) // 60 * 60)::BIGINT AS shown_sod, abs(shown - sod) >= 120 AS differs FROM (SELECT e.*, greatest(expected_sod, arg_min(greatest(expected_sod, CASE WHEN leave_by IS NOT NULL THEN sod + leave_by END), stop_sequence) OVER (PARTITION BY service_date, trip_id, vehicle_number)) AS shown
  FROM (SELECT x.*, k.sod FROM v_expected_stop_times x JOIN o_keyed k USING (service_date, trip_id, vehicle_number, stop_sequence)) e) y""")
def ride_stops(spark, d):
    keyed = keyed_table(spark, d)
    e = T.expected_times(keyed, _fitted(spark, d))
    return V.ride_stops(e.join(keyed.select(*T.TRIP, "stop_sequence", "sod"), [*T.TRIP, "stop_sequence"]))


@query("SELECT i.mode, i.start_s, i.end_s, count(*) AS minutes, median(m.vehicles) AS median_fresh, median(m.usual) AS median_usual FROM o_incident i JOIN o_baseline m ON m.mode = i.mode AND m.at_s >= i.start_s AND m.at_s < i.end_s WHERE m.vehicles IS NOT NULL AND m.usual > 0 GROUP BY 1, 2, 3 HAVING count(*) >= 5")
def incident_medians(spark, d):
    return V.interval_medians(_incidents(spark, d), _based(spark, d))

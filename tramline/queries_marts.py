"""Registered queries over positions and serving tables, each with SQL written from the rules and not from the code."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.plans import gps as G
from tramline.plans import marts as M
from tramline.plans import schedule as S
from tramline.queries_facts import NOW, X, _history, arrival_table, event_table, execution_table, flagged_serving, history, serving_table, trip_table, versions
from tramline.queries_schedule import _f, local, start_of
from tramline.registry import PARTS, query
from tramline.sources.published import published

#: The date that windows end with.
END = "2024-04-21"


def until():
    return F.lit(END).cast("date")


_BLOCK = "count(*) AS arrivals, avg({0}) AS mean_delay, quantile_cont({0}, 0.5) AS median_delay, quantile_cont({0}, 0.9) AS p90_delay, count(*) FILTER ({0} <= -60) AS early_count, count(*) FILTER ({0} > -60 AND {0} < 180) AS on_time_count, count(*) FILTER ({0} >= 180) AS late_count, count(*) FILTER ({0} <= -60) / count(*)::DOUBLE AS early_rate, count(*) FILTER ({0} > -60 AND {0} < 180) / count(*)::DOUBLE AS on_time_rate, count(*) FILTER ({0} >= 180) / count(*)::DOUBLE AS late_rate".format("delay_seconds")
#: The buckets' bounds, written out here by hand.
_HIST = """concat_ws(';', 'early_over_5m=' || count(*) FILTER (d < -300), 'early_2_to_5m=' || count(*) FILTER (d BETWEEN -300 AND -121), 'early_1_to_2m=' || count(*) FILTER (d BETWEEN -120 AND -60), 'on_time_early_30_60s=' || count(*) FILTER (d BETWEEN -59 AND -31), 'on_time_early_0_30s=' || count(*) FILTER (d BETWEEN -30 AND -1), 'on_time_late_0_30s=' || count(*) FILTER (d BETWEEN 0 AND 30),
  'on_time_late_30_60s=' || count(*) FILTER (d BETWEEN 31 AND 60), 'on_time_late_1_to_3m=' || count(*) FILTER (d BETWEEN 61 AND 179), 'late_3_to_5m=' || count(*) FILTER (d BETWEEN 180 AND 300), 'late_5_to_10m=' || count(*) FILTER (d BETWEEN 301 AND 600), 'late_10_to_20m=' || count(*) FILTER (d BETWEEN 601 AND 1200), 'late_over_20m=' || count(*) FILTER (d > 1200))"""


def told(histogram):
    """The histogram as text, for results that are compared."""
    return F.array_join(F.transform(histogram, lambda x: F.concat(x["bucket_label"], F.lit("="), x["n"].cast("string"))), ";")


PARTS |= {
    "o_ping": """SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_type, vehicle_number, time_s ORDER BY ingested_s DESC NULLS LAST, line NULLS LAST, brigade NULLS LAST, lat NULLS LAST, lon NULLS LAST) AS place FROM (SELECT line, coalesce(nullif(ltrim(brigade, '0'), ''), '0') AS brigade, try_cast(lat AS DOUBLE) AS lat, try_cast(lon AS DOUBLE) AS lon, time_s, vehicle_number, vehicle_type, ingested_s, """
    + local("time_s")
    + """::DATE AS gps_date FROM raw_gps WHERE regexp_full_match(brigade, '[A-Z]?[0-9]+') AND regexp_full_match(vehicle_number, '[0-9]+')) x WHERE lat BETWEEN 51.0 AND 53.5 AND lon BETWEEN 19.5 AND 22.5) y WHERE place = 1""",
    "o_spine": f"SELECT gps_date, unnest(range({start_of('gps_date')}, {start_of('gps_date + 1')}, 3600)) AS hour_s, vehicle_type FROM (SELECT DISTINCT gps_date FROM o_ping) d CROSS JOIN (SELECT unnest([1, 2])::BIGINT AS vehicle_type) v",
    "o_hourly": """SELECT s.gps_date, s.hour_s, s.vehicle_type, p.a AS first_gps_s, p.z AS last_gps_s, coalesce(p.n, 0) AS row_count, coalesce(p.v, 0) AS vehicle_count, coalesce(p.b, 0) AS observed_10s_buckets, coalesce(p.b, 0) / 360.0::DOUBLE AS coverage_ratio, g.gap AS max_gap_seconds FROM o_spine s
  LEFT JOIN (SELECT gps_date, time_s - time_s % 3600 AS hour_s, vehicle_type, min(time_s) AS a, max(time_s) AS z, count(*) AS n, count(DISTINCT vehicle_number) AS v, count(DISTINCT time_s // 10) AS b FROM o_ping GROUP BY 1, 2, 3) p ON p.gps_date = s.gps_date AND p.hour_s = s.hour_s AND p.vehicle_type = s.vehicle_type
  LEFT JOIN (SELECT gps_date, hour_s, vehicle_type, max(t - before) AS gap FROM (SELECT *, lag(t) OVER (PARTITION BY gps_date, hour_s, vehicle_type ORDER BY t) AS before FROM (SELECT gps_date, time_s - time_s % 3600 AS hour_s, vehicle_type, time_s AS t FROM o_ping UNION SELECT gps_date, hour_s, vehicle_type, hour_s FROM o_spine UNION SELECT gps_date, hour_s, vehicle_type, hour_s + 3600 FROM o_spine) u) w GROUP BY 1, 2, 3) g ON g.gps_date = s.gps_date AND g.hour_s = s.hour_s AND g.vehicle_type = s.vehicle_type""",
    "o_day": f"SELECT gps_date, vehicle_type, CASE vehicle_type WHEN 1 THEN 'bus' ELSE 'tram' END AS mode, count(*) AS expected_hours, count(*) FILTER (row_count > 0) AS present_hours, coalesce(string_agg(CASE WHEN row_count = 0 THEN hour({local('hour_s')})::VARCHAR END, ',' ORDER BY hour_s), '') AS missing_hours, min(first_gps_s) AS first_observed_s, max(last_gps_s) AS last_observed_s, sum(row_count)::BIGINT AS gps_row_count, max(vehicle_count) AS max_vehicle_count, avg(coverage_ratio) AS mean_hourly_coverage_ratio, min(coverage_ratio) AS min_hourly_coverage_ratio, max(max_gap_seconds) AS max_gap_seconds, count(*) FILTER (row_count > 0) / count(*)::DOUBLE AS completeness_ratio, count(*) FILTER (row_count > 0) = count(*) AS is_complete_day FROM o_hourly GROUP BY 1, 2",
    "o_status": f"""SELECT *, least(completeness_ratio, coalesce(service_coverage_ratio, 1.0)) AS health_ratio, CASE WHEN least(completeness_ratio, coalesce(service_coverage_ratio, 1.0)) >= 0.9 THEN 'good' WHEN least(completeness_ratio, coalesce(service_coverage_ratio, 1.0)) >= 0.7 THEN 'usable' WHEN least(completeness_ratio, coalesce(service_coverage_ratio, 1.0)) > 0 THEN 'patchy' ELSE 'missing' END AS health_label
  FROM (SELECT d.gps_date AS service_date, d.mode, d.completeness_ratio, d.is_complete_day, d.gps_row_count, coalesce(p.n, 0) AS pings_total, coalesce(t.n, 0) AS trips_observed, coalesce(t.c, 0) AS trips_complete, coalesce(t.p, 0) AS trips_partial, coalesce(t.b, 0) AS trips_broken, coalesce(t.b / t.n::DOUBLE, 0.0) AS broken_rate, coalesce(c.e, 0)::BIGINT AS expected_trips, coalesce(c.o, 0)::BIGINT AS observed_trips, c.o / c.e::DOUBLE AS service_coverage_ratio, coalesce(c.em, 0.0) AS expected_service_minutes, coalesce(c.om, 0.0) AS observed_service_minutes, coalesce(c.v, 0) AS schedule_versions_active, coalesce(a.n, 0) AS stop_arrivals_count
    FROM o_day d LEFT JOIN (SELECT gps_date, vehicle_type, count(*) AS n FROM o_ping GROUP BY 1, 2) p ON p.gps_date = d.gps_date AND p.vehicle_type = d.vehicle_type LEFT JOIN (SELECT gps_date, mode, count(*) AS n, count(*) FILTER (trip_quality = 'complete') AS c, count(*) FILTER (trip_quality = 'partial') AS p, count(*) FILTER (trip_quality = 'broken') AS b FROM o_trip GROUP BY 1, 2) t ON t.gps_date = d.gps_date AND t.mode = d.mode
    LEFT JOIN (SELECT {local('hour_s')}::DATE AS day, mode, sum(expected_trip_count) AS e, sum(observed_trip_count) AS o, sum(expected_service_minutes) AS em, sum(observed_service_minutes) AS om, count(DISTINCT schedule_version_id) AS v FROM o_coverage WHERE is_settled_hour GROUP BY 1, 2) c ON c.day = d.gps_date AND c.mode = d.mode LEFT JOIN (SELECT gps_date, mode, count(*) AS n FROM o_arrival GROUP BY 1, 2) a ON a.gps_date = d.gps_date AND a.mode = d.mode) x""",
    "o_observed": "SELECT service_date, min(schedule_day_type) AS schedule_day_type FROM o_serving GROUP BY 1",
    "o_windows": f"""SELECT 'day' AS window_type, '{END}' AS window_key, DATE '{END}' AS service_date, (SELECT schedule_day_type FROM o_observed WHERE service_date = DATE '{END}') AS schedule_day_type, 1 AS date_rank
  UNION ALL SELECT 'month', '{END[:7]}', service_date, schedule_day_type, (row_number() OVER (ORDER BY service_date DESC))::INT FROM o_observed WHERE service_date <= DATE '{END}' AND strftime(service_date, '%Y-%m') = '{END[:7]}'
  UNION ALL SELECT * FROM (SELECT kind, '{END}', service_date, schedule_day_type, (row_number() OVER (PARTITION BY kind ORDER BY service_date DESC))::INT AS r FROM (SELECT *, CASE WHEN schedule_day_type IN ('saturday', 'sunday_holiday') THEN 'weekend' WHEN schedule_day_type IN ('monday', 'tuesday', 'wednesday', 'thursday', 'friday', 'weekday') THEN 'weekdays' END AS kind FROM o_observed WHERE service_date BETWEEN DATE '{END}' - 420 AND DATE '{END}') a WHERE kind IS NOT NULL) b WHERE r <= 60""",
    "o_complete": "SELECT * FROM o_serving WHERE trip_quality = 'complete' AND mode IN ('bus', 'tram')",
    "o_base": f"SELECT a.*, w.window_type, w.window_key, EXISTS (SELECT 1 FROM o_versions v WHERE v.schedule_version_id = a.schedule_version_id AND DATE '{END}' BETWEEN v.valid_from_date AND coalesce(v.valid_to_date, DATE '9999-12-31')) AS is_anchor FROM o_complete a JOIN o_windows w ON w.service_date = a.service_date",
    "o_fan": "SELECT *, 'mode' AS entity_type, mode AS entity_id FROM o_base UNION ALL SELECT *, 'line', line FROM o_base WHERE window_type IN ('day', 'month') OR is_anchor UNION ALL SELECT *, 'stop_group', stop_group_id FROM o_base UNION ALL SELECT *, 'stop_post', stop_id FROM o_base",
    "o_ranked_trips": "SELECT DISTINCT gtfs_snapshot_id, trip_id, processing_date, service_date FROM o_universe WHERE is_zone1_public_ranking_trip",
    "o_entity": f"""SELECT entity_type, entity_id, mode, universe_type, window_type, window_key, min(service_date) AS source_start_date, count(DISTINCT service_date) AS source_day_count, min(trip_headsign) AS route_label, count(DISTINCT line) AS line_count, count(DISTINCT stop_group_id) AS stop_group_count, count(DISTINCT stop_id) AS stop_post_count, count(DISTINCT gtfs_snapshot_id || '|' || trip_id || '|' || vehicle_number) AS trip_count, {_BLOCK}, {_HIST.replace(' d ', ' delay_seconds ').replace('(d ', '(delay_seconds ')} AS delay_histogram, quantile_cont(delay_seconds, 0.9) - quantile_cont(delay_seconds, 0.5) AS delay_spread
  FROM (SELECT *, 'all_observed' AS universe_type FROM o_fan UNION ALL SELECT f.*, 'zone1_public' FROM o_fan f WHERE entity_type <> 'mode' AND EXISTS (SELECT 1 FROM o_ranked_trips u WHERE u.gtfs_snapshot_id = f.gtfs_snapshot_id AND u.trip_id = f.trip_id AND u.processing_date = f.gps_date AND u.service_date = f.service_date)) x GROUP BY 1, 2, 3, 4, 5, 6""",
    "o_pattern_calls": "SELECT e.gtfs_snapshot_id, e.gps_date, e.service_date, e.trip_id, e.vehicle_number, e.stop_sequence, e.stop_group_id, e.stop_id, row_number() OVER (PARTITION BY e.gtfs_snapshot_id, e.gps_date, e.service_date, e.trip_id, e.vehicle_number ORDER BY e.stop_sequence) AS call_position FROM o_event e WHERE e.is_passenger_stop",
    "o_eligible": f"SELECT p.*, w.window_type, w.window_key FROM o_pattern p JOIN o_windows w ON w.service_date = p.service_date WHERE w.window_type IN ('day', 'month') OR EXISTS (SELECT 1 FROM o_versions v WHERE v.schedule_version_id = p.schedule_version_id AND DATE '{END}' BETWEEN v.valid_from_date AND coalesce(v.valid_to_date, DATE '9999-12-31'))",
}


def ping_table(spark, d):
    return published(spark, d, "stg_gps_pings", lambda: G.pings(_f(spark, d)("raw_gps")))


@query("SELECT * FROM o_ping")
def stg_gps_pings(spark, d):
    return G.pings(_f(spark, d)("raw_gps"))


@query(f"SELECT vehicle_type, gps_date, hour({local('time_s')})::INT AS local_hour, count(*) AS n FROM o_ping GROUP BY 1, 2, 3")
def gps_hourly_counts(spark, d):
    from tramline.functions.local import local_hour

    return ping_table(spark, d).groupBy("vehicle_type", "gps_date", local_hour(F.col("time_s")).alias("local_hour")).agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT d.gps_date, v.vehicle_type, h.h::INT AS missing_hour FROM (SELECT DISTINCT gps_date FROM o_ping) d CROSS JOIN (SELECT unnest([1, 2])::BIGINT AS vehicle_type) v CROSS JOIN (SELECT unnest(range(24)) AS h) h WHERE NOT EXISTS (SELECT 1 FROM o_ping p WHERE p.gps_date = d.gps_date AND p.vehicle_type = v.vehicle_type AND hour({local('p.time_s')}) = h.h)")
def gps_missing_hours(spark, d):
    """The hours 0 to 23 of each date and vehicle type without a partition."""
    from tramline.functions.local import local_hour

    p = ping_table(spark, d)
    there = p.select("gps_date", "vehicle_type", local_hour(F.col("time_s")).alias("missing_hour")).distinct()
    spine = p.select("gps_date").distinct().select("gps_date", F.explode(F.array(F.lit(1), F.lit(2)).cast("array<bigint>")).alias("vehicle_type")).select("*", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("missing_hour"))
    return spine.join(there, ["gps_date", "vehicle_type", "missing_hour"], "left_anti")


def _hours(spark, d):
    p = ping_table(spark, d)
    return G.hourly(p, p.select("gps_date").distinct())


@query("SELECT * FROM o_hourly")
def gps_hourly_completeness(spark, d):
    return _hours(spark, d)


@query("SELECT * FROM o_day")
def day_completeness(spark, d):
    return G.daily(_hours(spark, d)).withColumn("missing_hours", F.array_join(F.transform("missing_hours", lambda x: x.cast("string")), ","))


def coverage_table(spark, d):
    modes = S.routes(_f(spark, d)).select(S.SNAP, F.col("route_id").alias("line"), "mode")
    return published(spark, d, "agg_service_coverage", lambda: X.coverage(history(spark, d), modes, versions(spark, d), trip_table(spark, d), NOW))


@query("SELECT * FROM o_status")
def pipeline_status(spark, d):
    return G.pipeline_status(G.daily(_hours(spark, d)), ping_table(spark, d), trip_table(spark, d), coverage_table(spark, d), arrival_table(spark, d))


@query("""SELECT *, least(coalesce(completeness_ratio, 1.0), coalesce(service_coverage_ratio, 1.0)) AS health_ratio, CASE WHEN completeness_ratio IS NULL AND service_coverage_ratio IS NULL THEN 'no data' WHEN least(coalesce(completeness_ratio, 1.0), coalesce(service_coverage_ratio, 1.0)) >= 0.9 THEN 'good' WHEN least(coalesce(completeness_ratio, 1.0), coalesce(service_coverage_ratio, 1.0)) >= 0.7 THEN 'usable' WHEN least(coalesce(completeness_ratio, 1.0), coalesce(service_coverage_ratio, 1.0)) > 0 THEN 'patchy' ELSE 'missing' END AS health_label
  FROM (SELECT mode, count(*) AS day_count, min(service_date) AS first_date, max(service_date) AS last_date, sum(completeness_ratio * stop_arrivals_count) / nullif(sum(stop_arrivals_count), 0) AS completeness_ratio, sum(observed_service_minutes) / nullif(sum(expected_service_minutes), 0) AS service_coverage_ratio, sum(trips_complete)::BIGINT AS trips_complete, sum(trips_broken)::BIGINT AS trips_broken
    FROM (SELECT *, row_number() OVER (PARTITION BY mode ORDER BY service_date DESC) AS r FROM o_status WHERE service_date >= DATE '2024-04-05' - 30) a WHERE r <= 8 GROUP BY 1) b""")
def pipeline_status_recent(spark, d):
    return G.recent_status(pipeline_status(spark, d), F.lit("2024-04-05").cast("date"))


def _windows(spark, d):
    return M.window_dates(M.observed_dates(serving_table(spark, d)), until())


def _base(spark, d):
    return M.in_windows(M.window_arrivals(serving_table(spark, d)), _windows(spark, d), versions(spark, d), until())


@query("SELECT * FROM o_observed")
def serving_observed_date(spark, d):
    return M.observed_dates(serving_table(spark, d))


@query("SELECT * FROM o_windows")
def serving_window_date(spark, d):
    return _windows(spark, d)


@query("SELECT service_date, gps_date, schedule_version_id, mode, line, route_short_name, direction_id, trip_headsign, stop_group_id, stop_id, stop_name, stop_post_code, stop_sequence, schedule_day_type, hour_bracket_s, delay_seconds, dense_rank() OVER (ORDER BY gtfs_snapshot_id, trip_id, vehicle_number) % 1 AS zero FROM o_complete")
def serving_window_arrival(spark, d):
    return M.window_arrivals(serving_table(spark, d)).drop("trip_key", "universe_trip_key").withColumn("zero", F.lit(0).cast("long"))


def universe_table(spark, d):
    return published(spark, d, "trip_universe", lambda: S.trip_universe(S.stop_profiles(_f(spark, d), _history(spark, d))))


def entity_table(spark, d):
    windows = lambda: published(spark, d, "window_dates", lambda: _windows(spark, d))
    return published(spark, d, "entity_windows", lambda: M.entity_windows(flagged_serving(spark, d), windows(), versions(spark, d), until()))


@query("SELECT * FROM o_entity")
def entity_window_summary(spark, d):
    return entity_table(spark, d).withColumn("delay_histogram", told("delay_histogram"))


def _slice(kind: str):
    @query(f"SELECT * EXCLUDE (entity_type) FROM o_entity WHERE entity_type = '{kind}'")
    def run(spark, d):
        return entity_table(spark, d).where(F.col("entity_type") == kind).drop("entity_type").withColumn("delay_histogram", told("delay_histogram"))

    return run


def _register_slices():
    from tramline.registry import ORACLES, QUERIES

    for kind in M.ENTITIES:
        _slice(kind)
        QUERIES[f"{kind}_window_summary"], ORACLES[f"{kind}_window_summary"] = QUERIES.pop("run"), ORACLES.pop("run")


_register_slices()


@query("""SELECT *, (row_number() OVER (PARTITION BY entity_type, metric, mode, window_type, window_key ORDER BY value DESC, entity_id))::INT AS position, count(*) OVER (PARTITION BY entity_type, metric, mode, window_type, window_key) AS n_entities FROM (SELECT entity_type, entity_id, mode, window_type, window_key, metric, value FROM (SELECT * FROM o_entity WHERE universe_type = 'zone1_public' AND arrivals >= CASE entity_type WHEN 'line' THEN 20 ELSE 10 END * source_day_count) e
  CROSS JOIN LATERAL (SELECT unnest(['median_delay', 'on_time_rate', 'arrivals', 'delay_spread']) AS metric, unnest([median_delay, on_time_rate, arrivals::DOUBLE, delay_spread]) AS value) m WHERE value IS NOT NULL) x""")
def entity_rankings(spark, d):
    return M.rankings(entity_table(spark, d))


@query(f"SELECT entity_type, entity_id, mode, window_type, window_key, local_hour, min(service_date) AS source_start_date, count(*) AS arrival_count, quantile_cont(delay_seconds, 0.5) AS median_delay_seconds, (local_hour + 20) % 24 AS service_hour_index, printf('%02d', local_hour) AS hour_bracket_label, count(*) >= 3 AS has_min_sample FROM (SELECT *, hour({local('hour_bracket_s')})::INT AS local_hour FROM o_fan) x GROUP BY 1, 2, 3, 4, 5, 6")
def hour_window_summary(spark, d):
    return M.hour_windows(_base(spark, d))


@query("SELECT entity_type, entity_id, mode, window_type, window_key, service_date, count(*) AS arrival_count, quantile_cont(delay_seconds, 0.5) AS median_delay_seconds FROM o_fan GROUP BY 1, 2, 3, 4, 5, 6")
def entity_window_daily(spark, d):
    return M.daily_in_windows(_base(spark, d))


@query("SELECT entity_type, entity_id, mode, service_date, count(*) AS arrival_count, quantile_cont(delay_seconds, 0.5) AS median_delay_seconds FROM (SELECT 'mode' AS entity_type, mode AS entity_id, mode, service_date, delay_seconds FROM o_complete UNION ALL SELECT 'line', line, mode, service_date, delay_seconds FROM o_complete UNION ALL SELECT 'stop_group', stop_group_id, mode, service_date, delay_seconds FROM o_complete UNION ALL SELECT 'stop_post', stop_id, mode, service_date, delay_seconds FROM o_complete) x GROUP BY 1, 2, 3, 4")
def entity_daily_summary(spark, d):
    return M.entity_days(M.window_arrivals(serving_table(spark, d)))


@query(f"""SELECT entity_type, entity_id, mode, service_date, point_rank, round((t - ({start_of('service_date')} + 14400)) / 864.0::DOUBLE, 9) AS x_percent, delay_seconds, t AS source_event_s FROM (SELECT *, (row_number() OVER (PARTITION BY entity_type, entity_id, mode, service_date ORDER BY t, trip_id, vehicle_number, seq))::INT AS point_rank FROM (SELECT 'line' AS entity_type, line AS entity_id, mode, service_date, quantile_cont(delay_seconds, 0.5) AS delay_seconds, (min(scheduled_arrival_s) + max(scheduled_arrival_s)) / 2.0::DOUBLE AS t, trip_id, vehicle_number, 0 AS seq FROM o_complete GROUP BY line, mode, service_date, trip_id, vehicle_number
  UNION ALL SELECT 'stop_group', stop_group_id, mode, service_date, delay_seconds::DOUBLE, scheduled_arrival_s::DOUBLE, trip_id, vehicle_number, stop_sequence FROM o_complete UNION ALL SELECT 'stop_post', stop_id, mode, service_date, delay_seconds::DOUBLE, scheduled_arrival_s::DOUBLE, trip_id, vehicle_number, stop_sequence FROM o_complete) x) y WHERE point_rank <= 600""")
def entity_timeline(spark, d):
    return M.timeline(serving_table(spark, d))


@query(f"""SELECT *, (row_number() OVER (PARTITION BY entity_type, entity_id, mode, window_type, window_key ORDER BY median_delay DESC, arrivals DESC, line, direction_id, trip_headsign NULLS FIRST))::INT AS display_rank, p90_delay - median_delay AS delay_spread, arrivals >= 3 AS has_min_sample FROM (SELECT entity_type, entity_id, mode, line, direction_id, trip_headsign, window_type, window_key, {_BLOCK} FROM (SELECT *, 'stop_group' AS entity_type, stop_group_id AS entity_id FROM o_base UNION ALL SELECT *, 'stop_post', stop_id FROM o_base) x GROUP BY 1, 2, 3, 4, 5, 6, 7, 8) y""")
def stop_line_window(spark, d):
    return M.stop_lines(_base(spark, d))


@query("""SELECT *, (dense_rank() OVER (PARTITION BY stop_group_id, mode, window_type, window_key ORDER BY try_cast(line AS BIGINT) NULLS FIRST, line))::INT AS line_display_rank, (row_number() OVER (PARTITION BY stop_group_id, mode, line, window_type, window_key ORDER BY arrival_count DESC, trip_headsign NULLS FIRST))::INT AS destination_display_rank FROM (SELECT stop_group_id, mode, line, trip_headsign, window_type, window_key, count(*) AS arrival_count, string_agg(DISTINCT stop_id || ':' || stop_post_code, ',' ORDER BY stop_id || ':' || stop_post_code) AS posts FROM o_base GROUP BY 1, 2, 3, 4, 5, 6) x""")
def stop_group_line_window(spark, d):
    return M.stop_group_lines(_base(spark, d)).withColumn("posts", F.array_join(F.transform("posts", lambda x: F.concat(x["stop_id"], F.lit(":"), x["stop_post_code"])), ","))


def _eligible(spark, d):
    patterns = published(spark, d, "route_patterns", lambda: X.route_patterns(execution_table(spark, d), event_table(spark, d)))
    return M.eligible_patterns(patterns, _windows(spark, d), versions(spark, d), until())


@query("""SELECT *, (row_number() OVER (PARTITION BY line, mode, window_type, window_key ORDER BY trip_count DESC, direction_id, trip_headsign NULLS FIRST, route_pattern_id))::INT AS course_rank FROM (SELECT line, mode, direction_id, trip_headsign, route_pattern_id, window_type, window_key, min(pattern_status) AS pattern_status, arg_max(origin_stop_name, service_date::VARCHAR || gtfs_snapshot_id || trip_id) FILTER (origin_stop_name IS NOT NULL) AS origin_stop_name, arg_max(destination_stop_name, service_date::VARCHAR || gtfs_snapshot_id || trip_id) FILTER (destination_stop_name IS NOT NULL) AS destination_stop_name, min(stop_call_count) AS stop_call_count, string_agg(DISTINCT service_date::VARCHAR, ',' ORDER BY service_date::VARCHAR) AS observed_service_dates, count(*) AS trip_count FROM o_eligible GROUP BY 1, 2, 3, 4, 5, 6, 7) x""")
def line_course_window(spark, d):
    return M.courses(_eligible(spark, d)).withColumn("observed_service_dates", F.array_join(F.transform("observed_service_dates", lambda x: x.cast("string")), ","))


@query("""SELECT e.line, e.mode, e.direction_id, e.trip_headsign, e.route_pattern_id, e.window_type, e.window_key, c.call_position::INT AS call_position, min(c.stop_sequence) AS stop_sequence, min(c.stop_group_id) AS stop_group_id, min(c.stop_id) AS stop_id, count(*) AS trip_count, count(a.delay_seconds) AS arrival_count, avg(a.delay_seconds) AS mean_delay_seconds, quantile_cont(a.delay_seconds, 0.5) AS median_delay_seconds, quantile_cont(a.delay_seconds, 0.9) AS p90_delay_seconds, count(*) FILTER (a.delay_seconds <= -60) AS early_count, count(*) FILTER (a.delay_seconds >= 180) AS late_count, count(a.delay_seconds) >= 3 AS has_min_sample, count(*) FILTER (a.delay_seconds >= 180) / nullif(count(a.delay_seconds), 0)::DOUBLE AS late_rate
  FROM o_eligible e JOIN o_pattern_calls c ON c.gtfs_snapshot_id = e.gtfs_snapshot_id AND c.gps_date = e.gps_date AND c.service_date = e.service_date AND c.trip_id = e.trip_id AND c.vehicle_number = e.vehicle_number LEFT JOIN o_complete a ON a.gtfs_snapshot_id = e.gtfs_snapshot_id AND a.gps_date = e.gps_date AND a.service_date = e.service_date AND a.trip_id = e.trip_id AND a.vehicle_number = e.vehicle_number AND a.stop_sequence = c.stop_sequence AND a.stop_id = c.stop_id WHERE e.pattern_status = 'classified' GROUP BY 1, 2, 3, 4, 5, 6, 7, 8""")
def line_course_stop_window(spark, d):
    return M.course_stops(_eligible(spark, d), M.window_arrivals(serving_table(spark, d)))


@query(f"""SELECT *, (row_number() OVER (PARTITION BY service_date, mode, line ORDER BY clean_count + partial_count + broken_count DESC, direction_id, trip_headsign NULLS FIRST, schedule_version_id))::INT AS display_rank FROM (SELECT service_date, mode, line, schedule_version_id, direction_id, trip_headsign, count(*) FILTER (o = 'clean') AS clean_count, count(*) FILTER (o = 'partial') AS partial_count, count(*) FILTER (o = 'broken') AS broken_count, string_agg(trip_id || '/' || vehicle_number || '/' || o || '/' || l, ',' ORDER BY r) FILTER (r <= 160) AS outcomes FROM (SELECT *, CASE trip_quality WHEN 'complete' THEN 'clean' WHEN 'broken' THEN 'broken' ELSE 'partial' END AS o, strftime({local('scheduled_start_s')}, '%H:%M') AS l, row_number() OVER (PARTITION BY service_date, mode, line, schedule_version_id, direction_id, trip_headsign ORDER BY scheduled_start_s, trip_id, vehicle_number) AS r FROM o_execution) x GROUP BY 1, 2, 3, 4, 5, 6) y""")
def line_reliability(spark, d):
    text = F.transform("outcomes", lambda x: F.concat_ws("/", x["trip_id"], x["vehicle_number"], x["outcome"], x["label"]))
    return M.reliability(execution_table(spark, d)).withColumn("outcomes", F.array_join(text, ","))


_LAND = "CASE WHEN trip_quality = 'complete' THEN (row_number() OVER (PARTITION BY service_date, mode, trip_quality ORDER BY {}, trip_id, vehicle_number))::INT END"
_MINE = "(row_number() OVER (PARTITION BY service_date, mode, line ORDER BY {}, trip_id, vehicle_number))::INT"


@query(f"""SELECT gtfs_snapshot_id, service_date, trip_id, vehicle_number, mode, line, coalesce(trip_headsign, destination_stop_name, route_short_name) AS route_label, end_delay_seconds, delay_profile, erratic_score, {_MINE.format('scheduled_start_s')} AS departure_rank, {_MINE.format('end_delay_seconds DESC, scheduled_start_s')} AS line_end_delay_rank, {_MINE.format('erratic_score DESC, scheduled_start_s')} AS line_erratic_rank, {_LAND.format('abs(end_delay_seconds) DESC, end_delay_seconds DESC, scheduled_start_s')} AS landing_worst_rank, {_LAND.format('abs(end_delay_seconds), scheduled_start_s')} AS landing_best_rank, {_LAND.format('erratic_score DESC, end_delay_seconds DESC')} AS landing_erratic_rank
  FROM (SELECT t.*, coalesce(p.profile, '') AS delay_profile, coalesce(p.jump, 0)::BIGINT AS erratic_score FROM o_execution t LEFT JOIN (SELECT gtfs_snapshot_id, service_date, trip_id, vehicle_number, string_agg(delay_seconds::VARCHAR, ',' ORDER BY stop_sequence) AS profile, max(abs(delay_seconds - before)) AS jump FROM (SELECT *, lag(delay_seconds) OVER (PARTITION BY gtfs_snapshot_id, service_date, trip_id, vehicle_number ORDER BY stop_sequence) AS before FROM o_event WHERE observation_status = 'observed' AND delay_seconds IS NOT NULL) e GROUP BY 1, 2, 3, 4) p USING (gtfs_snapshot_id, service_date, trip_id, vehicle_number)) x""")
def trip_daily(spark, d):
    return M.trip_days(execution_table(spark, d), event_table(spark, d)).withColumn("delay_profile", F.array_join(F.transform("delay_profile", lambda x: x.cast("string")), ","))


@query(f"""SELECT scope_type, scope_id, service_date, mode, line, trip_id, vehicle_number, stop_id, stop_post_code, scheduled_arrival_s, strftime({local('scheduled_arrival_s')}, '%H:%M') AS time_label, delay_seconds, r AS delay_rank FROM (SELECT *, (row_number() OVER (PARTITION BY scope_type, scope_id, service_date, mode ORDER BY delay_seconds DESC, scheduled_arrival_s, trip_id, vehicle_number, stop_sequence))::INT AS r FROM (SELECT *, 'line' AS scope_type, line AS scope_id FROM o_complete UNION ALL SELECT *, 'stop_group', stop_group_id FROM o_complete UNION ALL SELECT *, 'stop_post', stop_id FROM o_complete) x) y WHERE r <= 20""")
def worst_delay_events(spark, d):
    return M.worst_events(serving_table(spark, d))


@query("SELECT service_date, mode, line, count(*) AS trip_count, (row_number() OVER (PARTITION BY service_date, mode ORDER BY try_cast(line AS BIGINT) NULLS FIRST, line))::INT AS line_display_rank FROM o_execution WHERE trip_quality = 'complete' GROUP BY 1, 2, 3")
def trip_line_daily(spark, d):
    return M.trip_lines(execution_table(spark, d))


@query("SELECT service_date, mode, count(*) AS trip_count, count(*) FILTER (end_delay_seconds > -60 AND end_delay_seconds < 180) / count(*)::DOUBLE AS on_time_rate, quantile_cont(end_delay_seconds, 0.5) AS median_delay_seconds FROM o_execution WHERE trip_quality = 'complete' GROUP BY 1, 2")
def trip_mode_daily(spark, d):
    return M.trip_modes(execution_table(spark, d))


@query("SELECT service_date, mode, line, direction_id, trip_headsign, min(origin_stop_name) AS origin_stop_name, min(destination_stop_name) AS destination_stop_name, count(*) AS trip_count, (row_number() OVER (PARTITION BY service_date, mode, line ORDER BY count(*) DESC, direction_id, trip_headsign NULLS FIRST))::INT AS display_rank FROM o_execution WHERE trip_quality = 'complete' GROUP BY 1, 2, 3, 4, 5")
def line_trip_group_daily(spark, d):
    return M.trip_groups(execution_table(spark, d))


@query("""SELECT service_date, lag(service_date) OVER (ORDER BY service_date) AS previous_service_date, lead(service_date) OVER (ORDER BY service_date) AS next_service_date, coalesce(service_date = (SELECT max(service_date) FROM (SELECT service_date FROM o_status GROUP BY 1 HAVING count(DISTINCT mode) = 2 AND bool_and(is_complete_day)) w), false) AS is_latest, (row_number() OVER (ORDER BY service_date DESC))::INT AS service_date_rank_desc FROM o_observed""")
def dim_serving_date(spark, d):
    return M.serving_days(M.observed_dates(serving_table(spark, d)), pipeline_status(spark, d))


@query("SELECT * FROM o_windows WHERE window_type IN ('day', 'month') UNION ALL SELECT window_type, 'kept', service_date, schedule_day_type, date_rank FROM o_windows WHERE window_type NOT IN ('day', 'month')")
def partial_window_rebuild(spark, d):
    w = _windows(spark, d)
    return M.without_windows(w.withColumn("window_key", F.lit("kept")), w, ["day", "month"])


@query("SELECT count(*) AS total_count, count(*) FILTER (is_public_service_segment) AS public_service_count, count(*) FILTER (is_short_turn_part_trip) AS short_turn_part_trip_count, count(*) FILTER (non_zone1_stop_count = 0) AS zone1_only_count, count(*) FILTER (is_zone1_public_ranking_trip) AS ranking_trip_count FROM o_universe WHERE processing_date = DATE '2024-04-10'")
def ranking_universe_evidence(spark, d):
    return M.universe_evidence(universe_table(spark, d), F.lit("2024-04-10").cast("date"))

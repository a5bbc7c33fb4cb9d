"""Registered queries over the facts, each with SQL written from the rules and not from the code."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.plans import facts as X
from tramline.plans import schedule as S
from tramline.queries_schedule import _f, _history, at, local, start_of
from tramline.registry import PARTS, query
from tramline.sources.published import published

#: The instant at which coverage is looked at.
NOW = 1713600000
_RANK = "CASE {}trip_quality WHEN 'complete' THEN 3 WHEN 'partial' THEN 2 WHEN 'broken' THEN 1 ELSE 0 END"
PARTS |= {
    "o_best": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY gps_date, service_date, trip_id, vehicle_number ORDER BY {_RANK.format('')} DESC, gps_date DESC, end_s + end_delay_seconds DESC, gtfs_snapshot_id DESC) AS place FROM matcher_trips) x WHERE place = 1 AND {at('service_date', 'end_s')} < {start_of('gps_date + 1')}""",
    "o_ends": """SELECT m.processing_date AS gps_date, m.service_date, m.gtfs_snapshot_id, m.trip_id, arg_min(m.stop_id, CASE WHEN is_passenger_stop THEN 0 ELSE 1000 END + stop_sequence) AS origin_stop_id, arg_min(s.stop_name, CASE WHEN is_passenger_stop THEN 0 ELSE 1000 END + stop_sequence) AS origin_stop_name,
  arg_min(m.stop_id, CASE WHEN is_passenger_stop THEN 0 ELSE 1000 END - stop_sequence) AS destination_stop_id, arg_min(s.stop_name, CASE WHEN is_passenger_stop THEN 0 ELSE 1000 END - stop_sequence) AS destination_stop_name FROM matcher_semantics m JOIN o_stops s ON s.gtfs_snapshot_id = m.gtfs_snapshot_id AND s.stop_id = m.stop_id GROUP BY 1, 2, 3, 4""",
    "o_dates": "SELECT d AS service_date, CASE WHEN isodow(d) > 5 THEN 'weekend' ELSE 'weekday' END AS day_type, strftime(d, '%m-%d') IN ('01-01', '01-06', '05-01', '05-03', '08-15', '11-01', '11-11', '12-25', '12-26') OR d - DATE '2024-03-31' IN (0, 1, 49, 60) AS is_holiday FROM (SELECT unnest(range(min(service_date), max(service_date) + 1, INTERVAL 1 DAY))::DATE AS d FROM o_cal) x",
    "o_enriched": f"""SELECT b.gtfs_snapshot_id, b.gps_date, b.service_date, b.trip_id, b.vehicle_number, h.line, r.route_short_name, r.mode, h.direction_id, h.trip_headsign, d.day_type, h.schedule_day_type, v.schedule_version_id, e.origin_stop_id, e.origin_stop_name, e.destination_stop_id, e.destination_stop_name, {at('b.service_date', 'b.start_s')} AS scheduled_start_s, {at('b.service_date', 'b.end_s')} AS scheduled_end_s,
  {at('b.service_date', 'b.start_s')} + b.start_delay_seconds AS actual_start_s, {at('b.service_date', 'b.end_s')} + b.end_delay_seconds AS actual_end_s, b.start_delay_seconds, b.end_delay_seconds, b.trip_quality, b.service_observation_class, b.has_non_monotonic_stop_progression
  FROM o_best b JOIN o_history h ON h.gtfs_snapshot_id = b.gtfs_snapshot_id AND h.processing_date = b.gps_date AND h.service_date = b.service_date AND h.trip_id = b.trip_id JOIN o_routes r ON r.gtfs_snapshot_id = h.gtfs_snapshot_id AND r.route_id = h.line JOIN o_dates d ON d.service_date = b.service_date
  JOIN o_versions v ON v.line = h.line AND v.direction_id = h.direction_id AND v.schedule_day_type = h.schedule_day_type AND b.gps_date BETWEEN v.valid_from_date AND coalesce(v.valid_to_date, DATE '9999-12-31') JOIN o_ends e ON e.gtfs_snapshot_id = b.gtfs_snapshot_id AND e.gps_date = b.gps_date AND e.service_date = b.service_date AND e.trip_id = b.trip_id""",
    "o_trip": "SELECT * FROM o_enriched e WHERE NOT EXISTS (SELECT 1 FROM o_enriched l WHERE l.service_date = e.service_date AND l.trip_id = e.trip_id AND l.gps_date > e.gps_date)",
    "o_arrival": f"""SELECT x.gtfs_snapshot_id, x.gps_date, x.service_date, x.trip_id, x.vehicle_number, x.line, x.route_short_name, x.mode, x.direction_id, x.trip_headsign, x.schedule_day_type, x.schedule_version_id, x.trip_quality, x.stop_sequence, m.stop_id, s.stop_group_id, s.stop_post_code, s.stop_name, g.stop_group_name, m.stop_service_class, m.stop_execution_class, d.is_holiday, x.scheduled_arrival_s, x.delay_seconds, x.scheduled_arrival_s + x.delay_seconds AS actual_arrival_s, x.scheduled_arrival_s - x.scheduled_arrival_s % 3600 AS hour_bracket_s
  FROM (SELECT t.*, a.stop_sequence, a.delay_seconds, {at('a.service_date', 'a.scheduled_s')} AS scheduled_arrival_s, row_number() OVER (PARTITION BY a.service_date, a.trip_id, a.vehicle_number, a.stop_sequence ORDER BY {_RANK.format('a.')} DESC, a.gps_date DESC, a.scheduled_s + a.delay_seconds DESC, a.gtfs_snapshot_id DESC) AS place
    FROM matcher_arrivals a JOIN o_trip t ON t.gtfs_snapshot_id = a.gtfs_snapshot_id AND t.gps_date = a.gps_date AND t.service_date = a.service_date AND t.trip_id = a.trip_id AND t.vehicle_number = a.vehicle_number WHERE NOT t.has_non_monotonic_stop_progression) x
  JOIN matcher_semantics m ON m.gtfs_snapshot_id = x.gtfs_snapshot_id AND m.processing_date = x.gps_date AND m.service_date = x.service_date AND m.trip_id = x.trip_id AND m.stop_sequence = x.stop_sequence JOIN o_stops s ON s.gtfs_snapshot_id = m.gtfs_snapshot_id AND s.stop_id = m.stop_id
  JOIN o_group_states g ON g.gtfs_snapshot_id = s.gtfs_snapshot_id AND g.stop_group_id = s.stop_group_id JOIN o_dates d ON d.service_date = x.service_date WHERE x.place = 1""",
    "o_event": """SELECT e.* EXCLUDE (status, seen, service_observation_class, stop_service_class), CASE WHEN status IS NOT NULL THEN status = 'observed' ELSE seen END AS is_observed, coalesce(status = 'uncertain', false) OR trip_quality = 'broken' OR service_observation_class = 'matching_failure' AS is_match_uncertain,
  CASE WHEN stop_execution_class IN ('technical_prefix', 'technical_suffix', 'technical_trip') OR stop_service_class = 'not_in_passenger_service' THEN 'not_in_passenger_service' WHEN stop_execution_class = 'unknown' OR NOT are_passenger_boundaries_settled THEN 'uncertain' WHEN status IS NOT NULL THEN status WHEN seen THEN 'observed' WHEN trip_quality = 'broken' OR service_observation_class = 'matching_failure' THEN 'uncertain' WHEN stop_service_class = 'request' THEN 'skipped_optional' ELSE 'missed' END AS observation_status
  FROM (SELECT t.gtfs_snapshot_id, t.gps_date, t.service_date, t.trip_id, t.vehicle_number, m.stop_sequence, m.stop_id, s.stop_group_id, s.stop_post_code, s.stop_name, t.line, t.mode, t.direction_id, t.trip_headsign, t.schedule_version_id, t.trip_quality, m.stop_execution_class, m.is_passenger_stop, m.are_passenger_boundaries_settled, a.delay_seconds, a.observation_status AS status, f.trip_id IS NOT NULL AS seen, t.service_observation_class, m.stop_service_class
    FROM o_trip t JOIN matcher_semantics m ON m.gtfs_snapshot_id = t.gtfs_snapshot_id AND m.processing_date = t.gps_date AND m.service_date = t.service_date AND m.trip_id = t.trip_id JOIN o_stops s ON s.gtfs_snapshot_id = m.gtfs_snapshot_id AND s.stop_id = m.stop_id
    LEFT JOIN matcher_arrivals a ON a.gtfs_snapshot_id = t.gtfs_snapshot_id AND a.gps_date = t.gps_date AND a.service_date = t.service_date AND a.trip_id = t.trip_id AND a.vehicle_number = t.vehicle_number AND a.stop_sequence = m.stop_sequence
    LEFT JOIN o_arrival f ON f.gtfs_snapshot_id = t.gtfs_snapshot_id AND f.service_date = t.service_date AND f.trip_id = t.trip_id AND f.vehicle_number = t.vehicle_number AND f.stop_sequence = m.stop_sequence) e""",
    "o_planned": f"""SELECT h.*, r.mode, v.schedule_version_id, {at('service_date', 'trip_start_s')} AS s, {at('service_date', 'trip_end_s')} AS e FROM o_history h JOIN o_routes r ON r.gtfs_snapshot_id = h.gtfs_snapshot_id AND r.route_id = h.line AND r.mode IN ('bus', 'tram') JOIN o_versions v ON v.line = h.line AND v.direction_id = h.direction_id AND v.schedule_day_type = h.schedule_day_type AND h.processing_date BETWEEN v.valid_from_date AND coalesce(v.valid_to_date, DATE '9999-12-31')
  WHERE h.is_public_service_segment AND h.processing_date = {local(at('service_date', 'trip_start_s'))}::DATE""",
    "o_coverage": f"""SELECT p.service_date, p.line, p.mode, p.direction_id, p.trip_headsign, p.schedule_day_type, p.schedule_version_id, p.hour_s, p.n AS expected_trip_count, p.minutes AS expected_service_minutes, p.latest AS latest_scheduled_end_s, coalesce(o.n, 0) AS observed_trip_count, coalesce(o.complete, 0) AS complete_trip_count, coalesce(o.part, 0) AS partial_trip_count, coalesce(o.cut, 0) AS truncated_trip_count, coalesce(o.minutes, 0.0) AS observed_service_minutes, least(1.0, coalesce(o.n, 0) / p.n::DOUBLE) AS service_coverage_ratio, p.latest < {NOW - 5400} AS is_settled_hour
  FROM (SELECT service_date, line, mode, direction_id, trip_headsign, schedule_day_type, schedule_version_id, s - s % 3600 AS hour_s, count(DISTINCT trip_id) AS n, sum(e - s) / 60.0::DOUBLE AS minutes, max(e) AS latest FROM o_planned GROUP BY 1, 2, 3, 4, 5, 6, 7, 8) p
  LEFT JOIN (SELECT service_date, line, mode, direction_id, trip_headsign, schedule_day_type, schedule_version_id, scheduled_start_s - scheduled_start_s % 3600 AS hour_s, count(DISTINCT trip_id) AS n, count(DISTINCT trip_id) FILTER (trip_quality = 'complete') AS complete, count(DISTINCT trip_id) FILTER (trip_quality = 'partial') AS part, count(DISTINCT trip_id) FILTER (service_observation_class = 'truncated') AS cut, sum(greatest(actual_end_s - actual_start_s, 0)) / 60.0::DOUBLE AS minutes
    FROM (SELECT *, row_number() OVER (PARTITION BY service_date, schedule_version_id, trip_id ORDER BY CASE service_observation_class WHEN 'regular' THEN 3 WHEN 'truncated' THEN 2 ELSE 1 END DESC, {_RANK.format('')} DESC, actual_start_s, actual_end_s, vehicle_number) AS place FROM o_trip WHERE service_observation_class IN ('regular', 'truncated', 'modified')) x WHERE place = 1 GROUP BY 1, 2, 3, 4, 5, 6, 7, 8) o
  ON o.service_date = p.service_date AND o.line = p.line AND o.mode = p.mode AND o.direction_id = p.direction_id AND o.trip_headsign = p.trip_headsign AND o.schedule_day_type = p.schedule_day_type AND o.schedule_version_id = p.schedule_version_id AND o.hour_s = p.hour_s""",
    "o_execution": f"SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY service_date, trip_id, vehicle_number ORDER BY {_RANK.format('')} DESC, gps_date DESC, actual_end_s DESC, gtfs_snapshot_id DESC) AS place FROM o_trip WHERE mode IN ('bus', 'tram')) x WHERE place = 1",
    "o_serving": "SELECT a.* FROM o_arrival a JOIN o_execution t ON t.gtfs_snapshot_id = a.gtfs_snapshot_id AND t.service_date = a.service_date AND t.trip_id = a.trip_id AND t.vehicle_number = a.vehicle_number",
    "o_pattern": """SELECT t.gtfs_snapshot_id, t.gps_date, t.service_date, t.trip_id, t.vehicle_number, t.line, t.mode, t.route_short_name, t.direction_id, t.trip_headsign, t.schedule_version_id, CASE WHEN e.ok THEN 'classified' ELSE 'unclassified' END AS pattern_status, CASE WHEN e.ok THEN sha256(concat_ws('|', t.mode, t.line, t.direction_id::VARCHAR, e.groups)) ELSE 'unclassified' END AS route_pattern_id, CASE WHEN e.ok THEN e.n ELSE 0 END AS stop_call_count, CASE WHEN e.ok THEN e.o END AS origin_stop_name, CASE WHEN e.ok THEN e.d END AS destination_stop_name
  FROM o_execution t LEFT JOIN (SELECT gtfs_snapshot_id, gps_date, service_date, trip_id, vehicle_number, bool_and(are_passenger_boundaries_settled) AND count(*) FILTER (stop_execution_class = 'unknown') = 0 AND count(*) FILTER (is_passenger_stop) > 0 AS ok, count(*) FILTER (is_passenger_stop) AS n, string_agg(stop_group_id, '>' ORDER BY stop_sequence) FILTER (is_passenger_stop) AS groups, arg_min(stop_name, stop_sequence) FILTER (is_passenger_stop) AS o, arg_max(stop_name, stop_sequence) FILTER (is_passenger_stop) AS d FROM o_event GROUP BY 1, 2, 3, 4, 5) e
  ON e.gtfs_snapshot_id = t.gtfs_snapshot_id AND e.gps_date = t.gps_date AND e.service_date = t.service_date AND e.trip_id = t.trip_id AND e.vehicle_number = t.vehicle_number WHERE t.trip_quality = 'complete'""",
}


def timetable(spark, d):
    """A row for each trip: days multiply it where it's read, not where it's stored."""
    return published(spark, d, "timetables", lambda: S.timetables(_f(spark, d)).drop("stops", "ordered_arrivals"), True)


def history(spark, d):
    f = _f(spark, d)
    return S.trip_schedule(f, S.processing_snapshots(f), False, timetable(spark, d))


def _fct_trip(spark, d, ranked=False):
    f, timed = _f(spark, d), timetable(spark, d)
    governed = S.processing_snapshots(f)
    return X.trips(f, timed, governed, versions(spark, d), S.ranked_days(f, governed, timed) if ranked else None)


def versions(spark, d):
    f = _f(spark, d)
    return published(spark, d, "versions", lambda: S.schedule_versions(S.service_fingerprints(f, S.processing_snapshots(f), timetable(spark, d))))


def _flagged_trips(spark, d):
    return published(spark, d, "fct_trip", lambda: X.with_executions(_fct_trip(spark, d, True)), True)


def _trips(spark, d):
    return _flagged_trips(spark, d).drop("is_ranked")


def trip_table(spark, d):
    return _trips(spark, d).drop("is_served")


def execution_table(spark, d):
    return _trips(spark, d).where("is_served").drop("is_served")


def _arrivals(spark, d):
    return published(spark, d, "fct_stop_arrival", lambda: X.arrivals(_f(spark, d), _flagged_trips(spark, d), "is_served", "is_ranked"), True)


def arrival_table(spark, d):
    return _arrivals(spark, d).drop("is_served", "is_ranked")


def flagged_serving(spark, d):
    """serving_table(), and whether an arrival's trip is of the ranking universe."""
    return _arrivals(spark, d).where("is_served").drop("is_served")


def serving_table(spark, d):
    return flagged_serving(spark, d).drop("is_ranked")


def event_table(spark, d):
    return published(spark, d, "fct_expected_stop_event", lambda: X.expected_events(_f(spark, d), trip_table(spark, d), arrival_table(spark, d)), True)


@query("SELECT * FROM o_trip")
def fct_trip(spark, d):
    return _fct_trip(spark, d)


@query("SELECT * FROM o_arrival")
def fct_stop_arrival(spark, d):
    return X.arrivals(_f(spark, d), trip_table(spark, d))


@query("SELECT * FROM o_event")
def fct_expected_stop_event(spark, d):
    return X.expected_events(_f(spark, d), trip_table(spark, d), arrival_table(spark, d))


@query("SELECT * FROM o_coverage")
def service_coverage(spark, d):
    modes = S.routes(_f(spark, d)).select(S.SNAP, F.col("route_id").alias("line"), "mode")
    return X.coverage(history(spark, d), modes, versions(spark, d), trip_table(spark, d), NOW)


@query("SELECT * FROM o_execution")
def serving_trip_execution(spark, d):
    return X.executions(trip_table(spark, d))


@query("SELECT * FROM o_serving")
def serving_stop_arrival(spark, d):
    return X.serving_arrivals(arrival_table(spark, d), execution_table(spark, d))


@query("SELECT * FROM o_pattern")
def trip_route_pattern(spark, d):
    return X.route_patterns(execution_table(spark, d), event_table(spark, d)).drop("calls")

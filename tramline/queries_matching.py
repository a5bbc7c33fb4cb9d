"""Registered queries from positions to trips, each with SQL written from the rules and not from the code."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.plans import matching as M
from tramline.plans import schedule as S
from tramline.queries_schedule import _f, duty_chain
from tramline.queries_travel import _METRES
from tramline.registry import ORACLES, PARTS, query
from tramline.sources.published import published

PARTS["o_chain"] = ORACLES["duty_chain"][ORACLES["duty_chain"].index("\nSELECT gtfs_snapshot_id, service_date, trip_id, md5") + 1 :]
PARTS |= {
    "o_episode": f"""SELECT vehicle_number, trip_id, line, scheduled_start_s, scheduled_end_s, episode, min(state) AS state, min(time_s) AS start_s, max(time_s) AS end_s, count(*) AS pings FROM (SELECT *, sum(fresh) OVER (PARTITION BY vehicle_number, trip_id ORDER BY time_s, state ROWS UNBOUNDED PRECEDING)::BIGINT AS episode FROM (SELECT *, CASE WHEN lag(state) OVER w = state AND time_s - lag(time_s) OVER w <= 180 THEN 0 ELSE 1 END AS fresh
  FROM (SELECT c.vehicle_number, c.trip_id, c.line, c.scheduled_start_s, c.scheduled_end_s, t.time_s, CASE WHEN {_METRES.format('t.lat', 't.lon', 'c.origin_lat', 'c.origin_lon')} <= 250 THEN CASE WHEN {_METRES.format('t.lat', 't.lon', 'c.destination_lat', 'c.destination_lon')} <= 250 THEN 'both' ELSE 'origin' END WHEN {_METRES.format('t.lat', 't.lon', 'c.destination_lat', 'c.destination_lon')} <= 250 THEN 'destination' ELSE 'outside' END AS state
    FROM raw_courses c JOIN raw_track t ON t.vehicle_number = c.vehicle_number AND t.line = c.line AND t.brigade = c.brigade) x WINDOW w AS (PARTITION BY vehicle_number, trip_id ORDER BY time_s, state)) y) z GROUP BY 1, 2, 3, 4, 5, 6""",
    "o_traversal": """SELECT o.vehicle_number, o.trip_id, o.line, o.scheduled_start_s, o.scheduled_end_s, o.start_s AS origin_event_s, d.start_s AS departure_event_s, CASE WHEN t.state IN ('destination', 'both') THEN t.start_s END AS destination_event_s, CASE WHEN t.state IN ('destination', 'both') THEN 'candidate' ELSE 'partial' END AS candidate_kind
  FROM o_episode o JOIN o_episode d ON d.vehicle_number = o.vehicle_number AND d.trip_id = o.trip_id AND d.episode = o.episode + 1 AND d.state = 'outside' LEFT JOIN o_episode t ON t.vehicle_number = o.vehicle_number AND t.trip_id = o.trip_id AND t.episode = (SELECT min(z.episode) FROM o_episode z WHERE z.vehicle_number = o.vehicle_number AND z.trip_id = o.trip_id AND z.episode > o.episode + 1 AND z.state <> 'outside') WHERE o.state IN ('origin', 'both')""",
    "o_plausible": """SELECT * FROM o_traversal WHERE candidate_kind = 'candidate' AND departure_event_s - scheduled_start_s BETWEEN CASE WHEN left(line, 1) IN ('Z', 'C') THEN -1800 ELSE -900 END AND CASE WHEN left(line, 1) IN ('Z', 'C') THEN 5400 ELSE 3600 END AND (destination_event_s - departure_event_s) - (scheduled_end_s - scheduled_start_s) <= CASE WHEN left(line, 1) IN ('Z', 'C') THEN 5400 ELSE 2700 END""",
    "o_owned": "SELECT t.*, p.trip_id FROM o_plausible p JOIN raw_track t ON t.vehicle_number = p.vehicle_number AND t.time_s BETWEEN p.origin_event_s AND p.destination_event_s",
}


@query("""SELECT gtfs_snapshot_id, service_date, trip_id, stop_sequence, stop_id, kind AS stop_execution_class, settled AS are_passenger_boundaries_settled, settled AND kind = 'passenger' AS is_passenger_stop, CASE WHEN settled THEN min(stop_sequence) FILTER (kind = 'passenger') OVER t END AS first_passenger_stop_sequence, CASE WHEN settled THEN max(stop_sequence) FILTER (kind = 'passenger') OVER t END AS last_passenger_stop_sequence
  FROM (SELECT *, NOT bool_or(kind = 'unknown' AND (r = 1 OR r = n)) OVER t AS settled FROM (SELECT *, CASE WHEN is_depot_segment OR pass = 0 THEN 'technical_trip' WHEN off AND pass_before = 0 THEN 'technical_prefix' WHEN off AND pass_before = pass THEN 'technical_suffix' WHEN off THEN 'unknown' WHEN pre AND duty_chain_source = 'block_id' AND coalesce(layover_from_previous_s, 0) >= 0 THEN 'technical_prefix' WHEN suf AND duty_chain_source = 'block_id' AND coalesce(layover_to_next_s, 0) >= 0 THEN 'technical_suffix' WHEN pre OR suf THEN 'unknown' ELSE 'passenger' END AS kind
    FROM (SELECT *, r = 1 AND coalesce(stop_id = prev_end, false) AND coalesce(ahead <> stop_id AND left(ahead, 4) = left(stop_id, 4), false) AS pre, r = n AND coalesce(stop_id = next_start, false) AND coalesce(behind <> stop_id AND left(behind, 4) = left(stop_id, 4), false) AS suf
      FROM (SELECT c.gtfs_snapshot_id, c.service_date, c.trip_id, s.stop_sequence, s.stop_id, c.duty_chain_source, c.is_depot_segment, c.layover_from_previous_s, c.layover_to_next_s, p.destination_stop_id AS prev_end, f.origin_stop_id AS next_start, s.stop_service_class = 'not_in_passenger_service' AS off, row_number() OVER o AS r, count(*) OVER w AS n, count(*) FILTER (s.stop_service_class <> 'not_in_passenger_service') OVER w AS pass, count(*) FILTER (s.stop_service_class <> 'not_in_passenger_service') OVER o AS pass_before, lead(s.stop_id) OVER o AS ahead, lag(s.stop_id) OVER o AS behind
        FROM o_chain c JOIN o_times s ON s.gtfs_snapshot_id = c.gtfs_snapshot_id AND s.trip_id = c.trip_id LEFT JOIN o_chain p ON p.gtfs_snapshot_id = c.gtfs_snapshot_id AND p.service_date = c.service_date AND p.trip_id = c.previous_trip_id LEFT JOIN o_chain f ON f.gtfs_snapshot_id = c.gtfs_snapshot_id AND f.service_date = c.service_date AND f.trip_id = c.next_trip_id
        WINDOW w AS (PARTITION BY c.gtfs_snapshot_id, c.service_date, c.trip_id), o AS (PARTITION BY c.gtfs_snapshot_id, c.service_date, c.trip_id ORDER BY s.stop_sequence)) a) b) k WINDOW t AS (PARTITION BY gtfs_snapshot_id, service_date, trip_id)) q WINDOW t AS (PARTITION BY gtfs_snapshot_id, service_date, trip_id)""")
def stop_semantics(spark, d):
    chain = published(spark, d, "duty_chain", lambda: duty_chain(spark, d))
    return M.stop_semantics(chain, S.stop_times(_f(spark, d)))


def courses_table(spark, d):
    return published(spark, d, "raw_courses", lambda: _f(spark, d)("raw_courses"))


def _episodes(spark, d):
    return M.episodes(courses_table(spark, d), _f(spark, d)("raw_track"))


def _traversals(spark, d):
    return M.course_traversals(courses_table(spark, d), _f(spark, d)("raw_track"))


@query("SELECT * FROM o_episode")
def terminal_episodes(spark, d):
    return _episodes(spark, d)


@query("SELECT * FROM o_traversal")
def traversals(spark, d):
    return _traversals(spark, d)


@query("SELECT * FROM o_plausible")
def plausible_traversals(spark, d):
    return M.plausible(_traversals(spark, d))


@query("SELECT p.vehicle_number, p.trip_id, p.origin_event_s, p.destination_event_s, EXISTS (SELECT 1 FROM o_plausible q WHERE q.vehicle_number = p.vehicle_number AND (q.trip_id <> p.trip_id OR q.origin_event_s <> p.origin_event_s) AND q.origin_event_s <= p.destination_event_s AND q.destination_event_s >= p.origin_event_s) AS is_competing FROM o_plausible p")
def competing_ownership(spark, d):
    t = M.plausible(_traversals(spark, d))
    return M.competing(t, "vehicle_number", "origin_event_s", "destination_event_s", ["trip_id"]).select("vehicle_number", "trip_id", "origin_event_s", "destination_event_s", "is_competing")


def _owned(spark, d):
    t = M.plausible(_traversals(spark, d)).select("vehicle_number", "trip_id", "origin_event_s", "destination_event_s")
    return M.in_intervals(_f(spark, d)("raw_track"), t, "vehicle_number", "origin_event_s", "destination_event_s")


@query("SELECT vehicle_number, trip_id, line, brigade, time_s, lat, lon FROM o_owned")
def owned_pings(spark, d):
    return _owned(spark, d).select("vehicle_number", "trip_id", "line", "brigade", "time_s", "lat", "lon")


@query(f"""SELECT vehicle_number, trip_id, max(gap) AS max_ping_gap_seconds, round(coalesce(max(speed), 0.0), 6) AS max_speed_mps, count(*) FILTER (speed > 50 AND NOT coalesce(was > 50, false)) AS impossible_speed_event_count, count(*) FILTER (speed > 50) AS impossible_speed_segment_count FROM (SELECT *, lag(speed) OVER (PARTITION BY vehicle_number, trip_id ORDER BY time_s, lat, lon) AS was FROM (SELECT *, m / nullif(gap, 0) AS speed FROM (SELECT vehicle_number, trip_id, time_s, lat, lon, time_s - lag(time_s) OVER w AS gap, {_METRES.format('lag(lat) OVER w', 'lag(lon) OVER w', 'lat', 'lon')} AS m FROM o_owned WINDOW w AS (PARTITION BY vehicle_number, trip_id ORDER BY time_s, lat, lon)) a) b) c WHERE gap IS NOT NULL GROUP BY 1, 2""")
def ping_metrics(spark, d):
    return M.ping_metrics(_owned(spark, d), ["vehicle_number", "trip_id"])


#: Stops of a course: seven on the way, 30 m beside it.
_STOPS = "SELECT vehicle_number, trip_id, CAST(k AS BIGINT) AS stop_sequence, scheduled_start_s + k * 150 AS scheduled_s, (origin_lat * 1000000 + k * 2600) / 1000000.0E0 AS stop_lat, (21000000 + k * 2600 + 400) / 1000000.0E0 AS stop_lon FROM raw_courses CROSS JOIN (SELECT n_nationkey AS k FROM {nation} WHERE n_nationkey BETWEEN 1 AND 7) s"
PARTS["o_course_stops"] = _STOPS.replace("{nation}", "nation")
PARTS["o_own_track"] = "SELECT c.vehicle_number, c.trip_id, t.time_s, t.lat, t.lon FROM raw_courses c JOIN raw_track t ON t.vehicle_number = c.vehicle_number AND t.line = c.line AND t.brigade = c.brigade"
PARTS["o_cross"] = f"""SELECT vehicle_number, trip_id, stop_sequence, segment, crossing_s, scheduled_s, round(distance_m, 6) AS distance_m FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_number, trip_id, stop_sequence ORDER BY crossing_s, segment) AS place FROM (SELECT *, sqrt(pow(ax + u * (bx - ax), 2) + pow(ay + u * (by_ - ay), 2)) AS distance_m, time_s + floor((t2 - time_s) * CASE WHEN d0 + d1 = 0 THEN 0.5 ELSE d0 / (d0 + d1) END + 0.5)::BIGINT AS crossing_s
  FROM (SELECT *, CASE WHEN ax = bx AND ay = by_ THEN 0.0 ELSE greatest(0.0, least(1.0, -(ax * (bx - ax) + ay * (by_ - ay)) / (pow(bx - ax, 2) + pow(by_ - ay, 2)))) END AS u FROM (SELECT s.*, g.segment, g.time_s, g.t2, (g.lon - stop_lon) * cos(radians(stop_lat)) * 111320.0 AS ax, (g.lat - stop_lat) * 110540.0 AS ay, (g.lon2 - stop_lon) * cos(radians(stop_lat)) * 111320.0 AS bx, (g.lat2 - stop_lat) * 110540.0 AS by_, {_METRES.format('stop_lat', 'stop_lon', 'g.lat', 'g.lon')} AS d0, {_METRES.format('stop_lat', 'stop_lon', 'g.lat2', 'g.lon2')} AS d1
    FROM o_course_stops s JOIN (SELECT * FROM (SELECT vehicle_number, trip_id, time_s, lat, lon, lead(time_s) OVER w AS t2, lead(lat) OVER w AS lat2, lead(lon) OVER w AS lon2, (row_number() OVER w)::INT AS segment FROM o_own_track WINDOW w AS (PARTITION BY vehicle_number, trip_id ORDER BY time_s, lat, lon)) v WHERE t2 - time_s BETWEEN 1 AND 180 AND {_METRES.format('lat', 'lon', 'lat2', 'lon2')} / (t2 - time_s) <= 50) g ON g.vehicle_number = s.vehicle_number AND g.trip_id = s.trip_id) a) b) c WHERE distance_m <= 75) e WHERE place <= 64"""


def _crossings(spark, d):
    f = _f(spark, d)
    c = f("raw_courses")
    k = F.explode(F.sequence(F.lit(1).cast("long"), F.lit(7).cast("long")))
    stops = c.select("*", k.alias("stop_sequence")).select("vehicle_number", "trip_id", "stop_sequence", (F.col("scheduled_start_s") + F.col("stop_sequence") * 150).alias("scheduled_s"), ((F.col("origin_lat") * 1000000 + F.col("stop_sequence") * 2600) / 1000000.0).alias("stop_lat"), ((21000000 + F.col("stop_sequence") * 2600 + 400) / 1000000.0).alias("stop_lon"))
    track = c.select("vehicle_number", "trip_id", "line", "brigade").join(f("raw_track"), ["vehicle_number", "line", "brigade"])
    return M.crossings(stops, track.select("vehicle_number", "trip_id", "time_s", "lat", "lon"))


@query("SELECT * FROM o_cross")
def crossing_candidates(spark, d):
    return _crossings(spark, d)


@query()
def aligned_stops(spark, d):
    return M.aligned(_crossings(spark, d))


PARTS["o_jumpy"] = "SELECT gtfs_snapshot_id, gps_date, service_date, trip_id, vehicle_number, stop_sequence, delay_seconds + CASE WHEN stop_sequence > 4 AND length(trip_id) % 2 = 0 THEN 1200 ELSE 0 END AS delay_seconds FROM matcher_arrivals"


@query("""SELECT gtfs_snapshot_id, gps_date, service_date, trip_id, vehicle_number, stop_sequence, delay_seconds, regime FROM (SELECT *, first_value(regime) OVER (PARTITION BY gtfs_snapshot_id, gps_date, service_date, trip_id, vehicle_number ORDER BY size DESC, regime) AS kept FROM (SELECT *, count(*) OVER (PARTITION BY gtfs_snapshot_id, gps_date, service_date, trip_id, vehicle_number, regime) AS size FROM (SELECT *, coalesce(sum(j) OVER (PARTITION BY gtfs_snapshot_id, gps_date, service_date, trip_id, vehicle_number ORDER BY stop_sequence ROWS UNBOUNDED PRECEDING), 0)::BIGINT AS regime FROM (SELECT *, CASE WHEN abs(delay_seconds - lag(delay_seconds) OVER (PARTITION BY gtfs_snapshot_id, gps_date, service_date, trip_id, vehicle_number ORDER BY stop_sequence)) > 900 THEN 1 ELSE 0 END AS j FROM o_jumpy) a) b) c) e WHERE regime = kept""")
def coherent_delays(spark, d):
    a = _f(spark, d)("matcher_arrivals").select("gtfs_snapshot_id", "gps_date", "service_date", "trip_id", "vehicle_number", "stop_sequence", "delay_seconds")
    far = (F.col("stop_sequence") > 4) & (F.length("trip_id") % 2 == 0)
    return M.coherent(a.withColumn("delay_seconds", F.col("delay_seconds") + F.when(far, 1200).otherwise(0)), ["gtfs_snapshot_id", "gps_date", "service_date", "trip_id", "vehicle_number"])


_TRIP = "gtfs_snapshot_id, processing_date, service_date, trip_id"
PARTS["o_metrics"] = f"""SELECT m.*, e.expected AS passenger_stops_expected, e.lo AS first_required, e.hi AS last_required FROM (SELECT {_TRIP}, vehicle_number, count(*) AS passenger_stops_detected, min(stop_sequence) AS first_detected, max(stop_sequence) AS last_detected, arg_min(delay_seconds, stop_sequence) AS start_delay, arg_max(delay_seconds, stop_sequence) AS end_delay, coalesce(max(ordinal - prior), 0)::INT AS max_stop_gap, coalesce(bool_or(stop_sequence < before), false) AS non_monotonic
  FROM (SELECT *, lag(stop_sequence) OVER (PARTITION BY {_TRIP}, vehicle_number ORDER BY t, stop_sequence) AS before, lag(ordinal) OVER (PARTITION BY {_TRIP}, vehicle_number ORDER BY ordinal) AS prior FROM (SELECT a.gtfs_snapshot_id, a.processing_date, a.service_date, a.trip_id, a.vehicle_number, a.stop_sequence, a.delay_seconds, a.scheduled_s + a.delay_seconds AS t, r.ordinal FROM matcher_arrivals a JOIN (SELECT *, row_number() OVER (PARTITION BY {_TRIP} ORDER BY stop_sequence) AS ordinal FROM o_regular) r USING ({_TRIP}, stop_sequence) WHERE a.observation_status = 'observed') x) y GROUP BY {_TRIP}, vehicle_number) m
  JOIN (SELECT {_TRIP}, count(*) AS expected, min(stop_sequence) AS lo, max(stop_sequence) AS hi FROM o_regular GROUP BY {_TRIP}) e USING ({_TRIP})"""
PARTS["o_regular"] = "SELECT * FROM matcher_semantics WHERE are_passenger_boundaries_settled AND is_passenger_stop AND stop_execution_class = 'passenger' AND stop_service_class = 'regular'"


def _metrics(spark, d):
    f = _f(spark, d)
    a = f("matcher_arrivals").withColumn("actual_s", F.col("scheduled_s") + F.col("delay_seconds"))
    return M.trip_metrics(f("matcher_semantics"), a, [*_TRIP.split(", "), "vehicle_number"])


@query("SELECT * FROM o_metrics")
def trip_metrics(spark, d):
    return _metrics(spark, d)


@query("""SELECT gtfs_snapshot_id, processing_date, service_date, trip_id, vehicle_number, ratio AS detected_stop_ratio, CASE WHEN bad THEN 'broken' WHEN ratio >= 0.8 AND f AND l AND max_stop_gap <= 4 THEN 'complete' ELSE 'partial' END AS trip_quality, CASE WHEN bad THEN 'matching_failure' WHEN max_stop_gap > 4 OR stale THEN 'modified' WHEN f AND l THEN 'regular' ELSE 'truncated' END AS service_observation_class,
  concat_ws(',', CASE WHEN NOT f THEN 'missing_first_stop' END, CASE WHEN NOT l THEN 'missing_last_stop' END, CASE WHEN ratio < 0.8 THEN 'low_stop_coverage' END, CASE WHEN non_monotonic THEN 'non_monotonic_stop_progression' END, CASE WHEN max_stop_gap > 4 THEN 'large_stop_sequence_gap' END, CASE WHEN (f AND abs(start_delay) > 3600) OR (l AND abs(end_delay) > 3600) THEN 'extreme_delay' END, CASE WHEN stale THEN 'stale_stop_progression' END, CASE WHEN bad THEN 'likely_wrong_trip_assignment' END) AS quality_flags
  FROM (SELECT *, ratio < 0.3 OR non_monotonic AS bad FROM (SELECT *, passenger_stops_detected / passenger_stops_expected::DOUBLE AS ratio, first_detected <= first_required + 2 AS f, last_detected >= last_required - 2 AS l, last_detected < last_required - 2 AND end_delay >= -120 AS stale FROM o_metrics) x) y""")
def trip_quality(spark, d):
    q = M.trip_quality(_metrics(spark, d))
    return q.select(*_TRIP.split(", "), "vehicle_number", "detected_stop_ratio", "trip_quality", "service_observation_class", F.array_join("quality_flags", ",").alias("quality_flags"))


@query()
def duty_settlement(spark, d):
    """Statuses of one day's courses. Choosing chains isn't told in SQL; tests hold it against all chains."""
    from tramline.plans import duties as D

    keep = lambda name, df: published(spark, d, name, lambda: df)
    courses, track = courses_table(spark, d), _f(spark, d)("raw_track")
    found = keep("place_traversals", M.place_traversals(courses, track))
    e = D.evidence(courses, track, M.course_traversals(courses, track, found))
    return D.settled_duties(courses.withColumn("settled", F.col("n") % 29 != 0), e, keep)

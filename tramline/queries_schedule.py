"""Registered queries over the stand-in timetable, each with SQL written from the rules and not from the code."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from tramline.plans import schedule as S
from tramline.registry import PARTS, query
from tramline.sources.feeds import feed, portable

PARTS.update(portable())
#: The snapshot that single-snapshot queries look at.
ONE = "2024-03-27T05:00:00Z_000000000001"


def at(date: str, seconds: str) -> str:
    return f"(epoch(timezone('Europe/Warsaw', {date}::TIMESTAMP + INTERVAL 12 HOUR))::BIGINT - 43200 + {seconds})"


def local(instant: str) -> str:
    return f"timezone('Europe/Warsaw', to_timestamp({instant}))"


def start_of(date: str) -> str:
    return f"epoch(timezone('Europe/Warsaw', ({date})::TIMESTAMP))::BIGINT"


def post(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '.{{4}}[0-9]{{2}}') THEN substr({c}, 5, 2) WHEN regexp_matches({c}, ':[^:]+$') THEN regexp_extract({c}, ':([^:]+)$', 1) ELSE coalesce(nullif(substr({c}, 5), ''), {c}) END"


_TIME = lambda c: f"CASE WHEN regexp_full_match({c}, '[0-9]+:[0-9]+:[0-9]+') THEN split_part({c}, ':', 1)::INT * 3600 + split_part({c}, ':', 2)::INT * 60 + split_part({c}, ':', 3)::INT END"
_CLASS = """CASE regexp_extract(service_id, '(?:^|:)(Pc|Pt|Sb|Nd)[A-Za-z]*$', 1) WHEN 'Nd' THEN 'sunday_holiday' WHEN 'Sb' THEN 'saturday' WHEN 'Pt' THEN 'friday'
  WHEN 'Pc' THEN CASE dayofweek(try_cast(nullif(regexp_extract(service_id, '^([0-9]{4}-[0-9]{2}-[0-9]{2}):', 1), '') AS DATE)) WHEN 0 THEN 'sunday_holiday' WHEN 1 THEN 'monday' WHEN 2 THEN 'tuesday' WHEN 3 THEN 'wednesday' WHEN 4 THEN 'thursday' WHEN 5 THEN 'friday' WHEN 6 THEN 'saturday' ELSE 'weekday' END ELSE 'unknown' END"""
_ONE_OF = "CASE WHEN count(DISTINCT cls) FILTER (cls <> 'weekday') = 1 THEN max(cls) FILTER (cls <> 'weekday') WHEN count(DISTINCT cls) FILTER (cls <> 'weekday') > 1 THEN 'mixed' WHEN count(DISTINCT cls) = 1 THEN max(cls) ELSE 'unknown' END"
_BOX = "BETWEEN 51.0 AND 53.5 AND {} BETWEEN 19.5 AND 22.5"
PARTS |= {
    "o_cal": "SELECT service_id, date AS service_date, CASE WHEN isodow(date) IN (6, 7) THEN 'weekend' ELSE 'weekday' END AS day_type, gtfs_snapshot_id FROM raw_calendar_dates WHERE exception_type = '1'",
    "o_routes": "SELECT route_id, route_short_name, route_type, CASE route_type WHEN 0 THEN 'tram' WHEN 1 THEN 'metro' WHEN 2 THEN 'rail' WHEN 3 THEN 'bus' ELSE 'unknown' END AS mode, gtfs_snapshot_id FROM raw_routes",
    "o_shapes": f"SELECT * FROM (SELECT shape_id, try_cast(shape_pt_lat AS DOUBLE) AS lat, try_cast(shape_pt_lon AS DOUBLE) AS lon, shape_pt_sequence AS seq, gtfs_snapshot_id FROM raw_shapes) x WHERE lat {_BOX.format('lon')}",
    "o_times": f"""SELECT *, CASE WHEN pickup_type = 1 AND drop_off_type = 1 THEN 'not_in_passenger_service' WHEN pickup_type IN (2, 3) OR drop_off_type IN (2, 3) THEN 'request' ELSE 'regular' END AS stop_service_class FROM (
  SELECT trip_id, stop_id, stop_sequence, {_TIME('arrival_time')} AS arrival_s, {_TIME('departure_time')} AS departure_s, coalesce(try_cast(pickup_type AS INT), 0) AS pickup_type, coalesce(try_cast(drop_off_type AS INT), 0) AS drop_off_type, gtfs_snapshot_id, gtfs_snapshot_date FROM raw_stop_times) x""",
    "o_stops": f"""SELECT * FROM (SELECT stop_id, substr(stop_id, 1, 4) AS stop_group_id, {post('stop_id')} AS stop_post_code, stop_name, stop_code, try_cast(stop_lat AS DOUBLE) AS stop_lat, try_cast(stop_lon AS DOUBLE) AS stop_lon, zone_id,
  CASE WHEN zone_id = '1+2' THEN '1' ELSE zone_id END AS effective_zone_id, stop_name_stem, town_name, gtfs_snapshot_id FROM raw_stops) x WHERE stop_lat {_BOX.format('stop_lon')}""",
    "o_trips": "SELECT trip_id, route_id AS line, service_id, trip_headsign, direction_id, nullif(block_id, '') AS block_id, nullif(block_short_name, '') AS block_short_name, coalesce(nullif(ltrim(block_short_name, '0'), ''), '0') AS brigade, shape_id, gtfs_snapshot_id, gtfs_snapshot_date FROM raw_trips",
    "o_governed": """SELECT service_date AS processing_date, gtfs_snapshot_id, snapshot_s FROM (SELECT c.service_date, c.gtfs_snapshot_id, s.snapshot_s, row_number() OVER (PARTITION BY c.service_date ORDER BY s.snapshot_s DESC, c.gtfs_snapshot_id DESC) AS n
  FROM (SELECT DISTINCT gtfs_snapshot_id, service_date FROM o_cal) c JOIN (SELECT DISTINCT gtfs_snapshot_id, service_date FROM o_cal) p ON p.gtfs_snapshot_id = c.gtfs_snapshot_id AND p.service_date = c.service_date - 1 JOIN raw_snapshots s ON s.snapshot_id = c.gtfs_snapshot_id) x WHERE n = 1""",
    "o_one": f"SELECT unnest(range(min(service_date), max(service_date) + 1, INTERVAL 1 DAY))::DATE AS processing_date, '{ONE}' AS gtfs_snapshot_id FROM o_cal WHERE gtfs_snapshot_id = '{ONE}'",
}


def _schedule(governed: str) -> str:
    return f"""SELECT a.service_date, a.processing_date, a.gtfs_snapshot_id, a.line, a.direction_id, a.trip_id, a.service_id, a.trip_headsign, a.shape_id, k.schedule_day_type, k.schedule_service_ids, t.trip_start_s, t.trip_end_s, t.stop_count, t.passenger_stop_count, t.ordered_stop_ids, t.ordered_arrivals, t.trip_timetable_signature, t.passenger_stop_count > 0 AS is_public_service_segment
  FROM (SELECT g.processing_date, c.service_date, c.cls, t.* EXCLUDE (block_id, block_short_name, brigade, gtfs_snapshot_date) FROM {governed} g JOIN (SELECT *, {_CLASS} AS cls FROM o_cal) c ON c.gtfs_snapshot_id = g.gtfs_snapshot_id AND (c.service_date = g.processing_date OR c.service_date = g.processing_date - 1) JOIN o_trips t ON t.gtfs_snapshot_id = c.gtfs_snapshot_id AND t.service_id = c.service_id) a
  JOIN (SELECT g.processing_date, c.service_date, c.gtfs_snapshot_id, t.line, t.direction_id, {_ONE_OF} AS schedule_day_type, string_agg(DISTINCT c.service_id, ', ' ORDER BY c.service_id) AS schedule_service_ids
    FROM {governed} g JOIN (SELECT *, {_CLASS} AS cls FROM o_cal) c ON c.gtfs_snapshot_id = g.gtfs_snapshot_id AND (c.service_date = g.processing_date OR c.service_date = g.processing_date - 1) JOIN o_trips t ON t.gtfs_snapshot_id = c.gtfs_snapshot_id AND t.service_id = c.service_id GROUP BY ALL) k
    ON k.processing_date = a.processing_date AND k.service_date = a.service_date AND k.gtfs_snapshot_id = a.gtfs_snapshot_id AND k.line = a.line AND k.direction_id = a.direction_id
  JOIN (SELECT gtfs_snapshot_id, trip_id, min(least(coalesce(arrival_s, departure_s), coalesce(departure_s, arrival_s)))::BIGINT AS trip_start_s, max(greatest(coalesce(arrival_s, departure_s), coalesce(departure_s, arrival_s)))::BIGINT AS trip_end_s, count(*) AS stop_count, count(*) FILTER (stop_service_class <> 'not_in_passenger_service') AS passenger_stop_count,
    string_agg(stop_id, ' | ' ORDER BY stop_sequence) AS ordered_stop_ids, string_agg(arrival_s::VARCHAR, ' | ' ORDER BY stop_sequence) AS ordered_arrivals, string_agg(CASE WHEN arrival_s IS NOT NULL THEN printf('%06d:%s:%08d', stop_sequence, stop_id, arrival_s) END, ' | ' ORDER BY stop_sequence) AS trip_timetable_signature FROM o_times GROUP BY 1, 2) t
    ON t.gtfs_snapshot_id = a.gtfs_snapshot_id AND t.trip_id = a.trip_id"""


PARTS |= {
    "o_history": _schedule("o_governed"),
    "o_overlap": f"SELECT * FROM ({_schedule('o_one')}) x WHERE {at('service_date', 'trip_end_s')} >= {start_of('processing_date')} AND {at('service_date', 'trip_start_s')} < {start_of('processing_date + 1')}",
    "o_prints": f"SELECT processing_date, gtfs_snapshot_id, line, direction_id, schedule_day_type, md5(coalesce(string_agg(trip_timetable_signature, chr(10) ORDER BY {at('service_date', 'trip_start_s')}, {at('service_date', 'trip_end_s')}, trip_timetable_signature), '')) AS timetable_fingerprint, count(*) AS scheduled_trip_count FROM o_history GROUP BY 1, 2, 3, 4, 5",
    "o_versions": """SELECT md5(concat_ws('|', line, direction_id::VARCHAR, schedule_day_type, timetable_fingerprint, valid_from_date::VARCHAR)) AS schedule_version_id, line, direction_id, schedule_day_type, timetable_fingerprint, valid_from_date,
  (lead(valid_from_date) OVER (PARTITION BY line, direction_id, schedule_day_type ORDER BY valid_from_date) - 1) AS valid_to_date, first_gtfs_snapshot_id, last_gtfs_snapshot_id, last_processing_date, max_scheduled_trip_count
  FROM (SELECT line, direction_id, schedule_day_type, timetable_fingerprint, run, min(processing_date) AS valid_from_date, arg_min(gtfs_snapshot_id, processing_date) AS first_gtfs_snapshot_id, arg_max(gtfs_snapshot_id, processing_date) AS last_gtfs_snapshot_id, max(processing_date) AS last_processing_date, max(scheduled_trip_count) AS max_scheduled_trip_count
    FROM (SELECT *, count(*) FILTER (fresh) OVER (PARTITION BY line, direction_id, schedule_day_type ORDER BY processing_date ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, lag(timetable_fingerprint) OVER (PARTITION BY line, direction_id, schedule_day_type ORDER BY processing_date) IS DISTINCT FROM timetable_fingerprint AS fresh FROM o_prints) a) b GROUP BY 1, 2, 3, 4, 5) c""",
    "o_governing": "SELECT snapshot_id AS gtfs_snapshot_id, snapshot_s, " + local("snapshot_s") + "::DATE + 1 AS valid_from_date FROM raw_snapshots",
    "o_group_states": """SELECT s.stop_group_id, s.gtfs_snapshot_id, string_agg(DISTINCT s.stop_name, ' | ' ORDER BY s.stop_name) AS stop_group_names, string_agg(DISTINCT zone_id, ' | ' ORDER BY zone_id) AS zone_ids, string_agg(DISTINCT effective_zone_id, ' | ' ORDER BY effective_zone_id) AS effective_zone_ids, string_agg(DISTINCT town_name, ' | ' ORDER BY town_name) AS town_names,
  round(avg(stop_lat), 6) AS centroid_lat, round(avg(stop_lon), 6) AS centroid_lon, count(*) AS stop_post_count, min(n.stop_name) AS stop_group_name FROM o_stops s JOIN (SELECT stop_group_id, gtfs_snapshot_id, stop_name, row_number() OVER (PARTITION BY stop_group_id, gtfs_snapshot_id ORDER BY count(*) DESC, stop_name) AS r FROM o_stops GROUP BY 1, 2, 3) n ON n.r = 1 AND n.stop_group_id = s.stop_group_id AND n.gtfs_snapshot_id = s.gtfs_snapshot_id GROUP BY 1, 2""",
    "o_profile": """SELECT h.service_date, h.processing_date, h.gtfs_snapshot_id, h.trip_id, h.line, r.mode, h.direction_id, h.schedule_day_type, h.is_public_service_segment, z.origin_stop_id, z.destination_stop_id, h.stop_count, z.ordered_stop_ids, z.non_zone1_stop_count, z.zone_ids FROM o_history h JOIN o_routes r ON r.gtfs_snapshot_id = h.gtfs_snapshot_id AND r.route_id = h.line AND r.mode IN ('bus', 'tram')
  JOIN (SELECT t.gtfs_snapshot_id, t.trip_id, arg_min(t.stop_id, stop_sequence) AS origin_stop_id, arg_max(t.stop_id, stop_sequence) AS destination_stop_id, string_agg(t.stop_id, '|' ORDER BY stop_sequence) AS ordered_stop_ids, count(*) FILTER (coalesce(effective_zone_id, '') <> '1') AS non_zone1_stop_count, string_agg(DISTINCT coalesce(effective_zone_id, ''), ',' ORDER BY coalesce(effective_zone_id, '')) AS zone_ids
    FROM o_times t LEFT JOIN o_stops s ON s.gtfs_snapshot_id = t.gtfs_snapshot_id AND s.stop_id = t.stop_id GROUP BY 1, 2) z ON z.gtfs_snapshot_id = h.gtfs_snapshot_id AND z.trip_id = h.trip_id""",
    "o_lists": "SELECT DISTINCT processing_date, gtfs_snapshot_id, line, direction_id, schedule_day_type, stop_count, ordered_stop_ids FROM o_profile WHERE is_public_service_segment",
    "o_inner": "SELECT DISTINCT p.processing_date, p.gtfs_snapshot_id, p.line, p.direction_id, p.schedule_day_type, p.ordered_stop_ids FROM o_profile p WHERE EXISTS (SELECT 1 FROM o_lists l WHERE l.processing_date = p.processing_date AND l.gtfs_snapshot_id = p.gtfs_snapshot_id AND l.line = p.line AND l.direction_id = p.direction_id AND l.schedule_day_type = p.schedule_day_type AND l.stop_count > p.stop_count AND strpos('|' || l.ordered_stop_ids || '|', '|' || p.ordered_stop_ids || '|') > 0)",
    "o_universe": """SELECT p.*, coalesce(e.n, 0) AS terminal_pair_trip_count, coalesce(e.r, 999999)::INT AS terminal_pair_rank, i.line IS NOT NULL AND coalesce(e.r, 999999) > 1 AS is_short_turn_part_trip, is_public_service_segment AND NOT (i.line IS NOT NULL AND coalesce(e.r, 999999) > 1) AND non_zone1_stop_count = 0 AND NOT starts_with(upper(p.line), 'C') AS is_zone1_public_ranking_trip
  FROM o_profile p LEFT JOIN (SELECT processing_date, gtfs_snapshot_id, line, direction_id, schedule_day_type, origin_stop_id, destination_stop_id, count(*) AS n, row_number() OVER (PARTITION BY processing_date, gtfs_snapshot_id, line, direction_id, schedule_day_type ORDER BY count(*) DESC, origin_stop_id, destination_stop_id) AS r FROM o_profile WHERE is_public_service_segment GROUP BY 1, 2, 3, 4, 5, 6, 7) e
  USING (processing_date, gtfs_snapshot_id, line, direction_id, schedule_day_type, origin_stop_id, destination_stop_id) LEFT JOIN o_inner i USING (processing_date, gtfs_snapshot_id, line, direction_id, schedule_day_type, ordered_stop_ids)""",
}


def _scd_sql(states: str, key: str, attributes: str) -> str:
    shown = ", ".join(f"coalesce({a}::VARCHAR, '~')" for a in attributes.split(", "))
    return f"""SELECT * EXCLUDE (run) FROM (SELECT {key}, {attributes}, attribute_hash, run, min(valid_from_date) AS valid_from_date, (lead(min(valid_from_date)) OVER (PARTITION BY {key} ORDER BY min(valid_from_date)) - 1) AS valid_to_date, arg_min(gtfs_snapshot_id, snapshot_s) AS first_gtfs_snapshot_id, arg_max(gtfs_snapshot_id, snapshot_s) AS last_gtfs_snapshot_id
  FROM (SELECT *, count(*) FILTER (fresh) OVER (PARTITION BY {key} ORDER BY snapshot_s ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, lag(attribute_hash) OVER (PARTITION BY {key} ORDER BY snapshot_s) IS DISTINCT FROM attribute_hash AS fresh
    FROM (SELECT e.{key}, g.gtfs_snapshot_id, g.snapshot_s, g.valid_from_date, {attributes}, CASE WHEN s.{key} IS NULL THEN '__missing__' ELSE md5(concat_ws('|', {shown})) END AS attribute_hash FROM (SELECT DISTINCT {key} FROM {states}) e CROSS JOIN o_governing g LEFT JOIN {states} s ON s.{key} = e.{key} AND s.gtfs_snapshot_id = g.gtfs_snapshot_id) a) b) c GROUP BY {key}, {attributes}, attribute_hash, run) z WHERE attribute_hash <> '__missing__'"""


def _f(spark, d):
    return partial(feed, spark, d)


@query("SELECT * FROM o_cal")
def stg_calendar_dates(spark, d):
    return S.calendar_dates(_f(spark, d))


@query("SELECT * FROM o_routes")
def stg_routes(spark, d):
    return S.routes(_f(spark, d))


@query("SELECT * FROM o_shapes")
def stg_shapes(spark, d):
    return S.shapes(_f(spark, d))


@query("SELECT * FROM o_times")
def stg_stop_times(spark, d):
    return S.stop_times(_f(spark, d))


@query("SELECT * FROM o_stops")
def stg_stops(spark, d):
    return S.stops(_f(spark, d))


@query("SELECT * FROM o_trips")
def stg_trips(spark, d):
    return S.trips(_f(spark, d))


@query(f"SELECT trip_id, stop_sequence, stop_service_class FROM o_times WHERE gtfs_snapshot_date = DATE '2024-03-27' AND gtfs_snapshot_id = '{ONE}'")
def snapshot_pruning(spark, d):
    """One snapshot's stop times by literal dates."""
    return S.of_snapshots(S.stop_times(_f(spark, d)), [ONE]).select("trip_id", "stop_sequence", "stop_service_class")


@query("SELECT gtfs_snapshot_id, shape_id, string_agg(lat::VARCHAR, ',' ORDER BY seq) AS lat, string_agg(lon::VARCHAR, ',' ORDER BY seq) AS lon, count(*)::INT AS points FROM o_shapes GROUP BY 1, 2")
def shape_polylines(spark, d):
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return S.polylines(_f(spark, d)).select(S.SNAP, "shape_id", text("lat"), text("lon"), "points")


@query("SELECT geometry, min(gtfs_snapshot_id || '/' || shape_id) AS canonical, count(*) AS copies FROM (SELECT gtfs_snapshot_id, shape_id, md5(string_agg(lat::VARCHAR || ',' || lon::VARCHAR, ';' ORDER BY seq)) AS geometry FROM o_shapes GROUP BY 1, 2) x GROUP BY 1")
def merged_shapes(spark, d):
    """Shapes of all snapshots under one name where their geometry is equal."""
    p = S.polylines(_f(spark, d))
    geometry = F.md5(F.array_join(F.zip_with("lat", "lon", lambda a, b: F.concat(a.cast("string"), F.lit(","), b.cast("string"))), ";"))
    return p.groupBy(geometry.alias("geometry")).agg(F.min(F.concat(F.col(S.SNAP), F.lit("/"), F.col("shape_id"))).alias("canonical"), F.count(F.lit(1)).alias("copies"))


@query("SELECT * FROM o_governed")
def processing_snapshot(spark, d):
    return S.processing_snapshots(_f(spark, d))


def _history(spark, d, overlapping=False):
    f = _f(spark, d)
    return S.trip_schedule(f, S.processing_snapshots(f), overlapping)


@query("SELECT * FROM o_history")
def trip_schedule_history(spark, d):
    return _history(spark, d).drop("stops")


@query("SELECT * FROM o_overlap")
def trip_schedule(spark, d):
    """One snapshot's trips on each of its dates, those that run within the local day."""
    f = _f(spark, d)
    c = S.calendar_dates(f).where(F.col(S.SNAP) == ONE).agg(F.min("service_date").alias("a"), F.max("service_date").alias("z"))
    return S.trip_schedule(f, c.select(F.explode(F.sequence("a", "z")).alias("processing_date"), F.lit(ONE).alias(S.SNAP)), True).drop("stops")


@query(rf"""SELECT gtfs_snapshot_id, service_date, trip_id, md5(concat_ws('|', gtfs_snapshot_id, service_date::VARCHAR, src, sid)) AS duty_chain_id, src AS duty_chain_source, (row_number() OVER w)::INT AS trip_order, line, direction_id, origin_stop_id, o_name AS origin_stop_name, destination_stop_id, d_name AS destination_stop_name,
  regexp_matches(coalesce(o_name, ''), '(?i)(^R-[0-9]+\s+Zajezdnia|^Zajezdnia|\sZajezdnia)') AND passenger_stop_count = 0 AS is_depot_pull_out, regexp_matches(coalesce(d_name, ''), '(?i)(^R-[0-9]+\s+Zajezdnia|^Zajezdnia|\sZajezdnia)') AND passenger_stop_count = 0 AS is_depot_pull_in, passenger_stop_count = 0 AS is_depot_segment,
  lag(trip_id) OVER w AS previous_trip_id, lead(trip_id) OVER w AS next_trip_id, trip_start_s - lag(trip_end_s) OVER w AS layover_from_previous_s, lead(trip_start_s) OVER w - trip_end_s AS layover_to_next_s, coalesce(lag(line) OVER w <> line, false) AS line_changed_from_previous, coalesce(trip_start_s < lag(trip_end_s) OVER w, false) AS overlaps_previous_trip,
  coalesce(trip_start_s < lag(trip_end_s) OVER w, false) OR trip_end_s < trip_start_s OR stop_count < 2 AS is_malformed_duty_segment
  FROM (SELECT h.*, o.stop_name AS o_name, e.stop_name AS d_name, x.origin_stop_id, x.destination_stop_id, coalesce(t.block_id, h.line || ':' || t.brigade) AS sid, CASE WHEN t.block_id IS NULL THEN 'line_brigade' ELSE 'block_id' END AS src FROM (SELECT DISTINCT * EXCLUDE (processing_date, schedule_day_type, schedule_service_ids) FROM o_history) h JOIN o_trips t ON t.gtfs_snapshot_id = h.gtfs_snapshot_id AND t.trip_id = h.trip_id
    JOIN (SELECT gtfs_snapshot_id, trip_id, arg_min(stop_id, stop_sequence) AS origin_stop_id, arg_max(stop_id, stop_sequence) AS destination_stop_id FROM o_times GROUP BY 1, 2) x ON x.gtfs_snapshot_id = h.gtfs_snapshot_id AND x.trip_id = h.trip_id LEFT JOIN o_stops o ON o.gtfs_snapshot_id = h.gtfs_snapshot_id AND o.stop_id = x.origin_stop_id LEFT JOIN o_stops e ON e.gtfs_snapshot_id = h.gtfs_snapshot_id AND e.stop_id = x.destination_stop_id) y
  WINDOW w AS (PARTITION BY gtfs_snapshot_id, service_date, src, sid ORDER BY trip_start_s, trip_end_s, trip_id)""")
def duty_chain(spark, d):
    f = _f(spark, d)
    return S.duty_chains(f, S.trip_schedule(f, S.processing_snapshots(f), False))


@query("SELECT *, false AS is_date_marker FROM o_prints UNION ALL SELECT processing_date, gtfs_snapshot_id, NULL, NULL, NULL, NULL, NULL, true FROM o_governed")
def schedule_fingerprint_daily(spark, d):
    return S.with_markers(S.fingerprints(_history(spark, d)), S.processing_snapshots(_f(spark, d)))


@query("SELECT coalesce(g.processing_date, l.processing_date) AS processing_date, g.gtfs_snapshot_id FROM o_governed g FULL JOIN (SELECT CASE WHEN day(processing_date) % 9 = 1 THEN processing_date + 400 ELSE processing_date END AS processing_date, CASE WHEN day(processing_date) % 7 = 3 THEN 'old' ELSE gtfs_snapshot_id END AS gtfs_snapshot_id FROM o_governed) l ON l.processing_date = g.processing_date WHERE g.gtfs_snapshot_id IS DISTINCT FROM l.gtfs_snapshot_id")
def schedule_ledger_difference(spark, d):
    """Against a ledger in which some dates are missing, some stale and some surplus."""
    g = S.processing_snapshots(_f(spark, d))
    day = F.dayofmonth("processing_date")
    ledger = g.select(F.when(day % 9 == 1, F.date_add("processing_date", 400)).otherwise(F.col("processing_date")).alias("processing_date"), F.when(day % 7 == 3, "old").otherwise(F.col(S.SNAP)).alias(S.SNAP), F.lit(True).alias("is_date_marker"))
    return S.ledger_difference(g, ledger)


@query("SELECT * FROM o_versions")
def schedule_version(spark, d):
    return S.schedule_versions(S.fingerprints(_history(spark, d)))


PARTS["o_lines"] = "SELECT route_id AS line, route_short_name, mode, mode IN ('bus', 'tram') AS has_live_gps, gtfs_snapshot_id FROM o_routes"


@query(_scd_sql("o_lines", "line", "route_short_name, mode, has_live_gps"))
def dim_line(spark, d):
    f = _f(spark, d)
    return S.scd(f, S.line_states(f), "line", ["route_short_name", "mode", "has_live_gps"])


_POST = "stop_group_id, stop_post_code, stop_name, zone_id, effective_zone_id, town_name, stop_lat, stop_lon"


@query(_scd_sql("o_stops", "stop_id", _POST))
def dim_stop_post(spark, d):
    f = _f(spark, d)
    return S.scd(f, S.stops(f).select("stop_id", S.SNAP, *_POST.split(", ")), "stop_id", _POST.split(", "))


_GROUP = "stop_group_name, stop_group_names, zone_ids, effective_zone_ids, town_names, centroid_lat, centroid_lon, stop_post_count"


@query(_scd_sql("o_group_states", "stop_group_id", _GROUP))
def dim_stop_group(spark, d):
    f = _f(spark, d)
    return S.scd(f, S.group_states(S.stops(f)), "stop_group_id", _GROUP.split(", "))


@query(f"SELECT a.line, a.valid_from_date FROM (SELECT line, valid_from_date - CASE WHEN length(line) = 1 THEN 3 ELSE 0 END AS valid_from_date, valid_to_date, valid_from_date AS was FROM ({_scd_sql('o_lines', 'line', 'route_short_name, mode, has_live_gps')}) q) a WHERE EXISTS (SELECT 1 FROM (SELECT line, valid_from_date - CASE WHEN length(line) = 1 THEN 3 ELSE 0 END AS valid_from_date, valid_to_date FROM ({_scd_sql('o_lines', 'line', 'route_short_name, mode, has_live_gps')}) q) b WHERE b.line = a.line AND b.valid_from_date < a.valid_from_date AND coalesce(b.valid_to_date, DATE '9999-12-31') >= a.valid_from_date)")
def scd_overlaps(spark, d):
    """Overlapping ranges, found in a dimension whose ranges were moved for some entities."""
    r = dim_line(spark, d)
    return S.overlapping_ranges(r.withColumn("valid_from_date", F.date_sub("valid_from_date", F.when(F.length("line") == 1, 3).otherwise(0))), "line")


@query(f"""SELECT r.line, r.mode, r.route_short_name, r.has_live_gps, r.gtfs_snapshot_id, string_agg(DISTINCT t.trip_headsign, ' | ' ORDER BY t.trip_headsign) FILTER (t.direction_id = 0) AS direction_0_headsigns, string_agg(DISTINCT t.trip_headsign, ' | ' ORDER BY t.trip_headsign) FILTER (t.direction_id = 1) AS direction_1_headsigns
  FROM o_lines r LEFT JOIN o_trips t ON t.gtfs_snapshot_id = r.gtfs_snapshot_id AND t.line = r.line AND t.trip_headsign IS NOT NULL WHERE r.gtfs_snapshot_id = '{ONE}' GROUP BY 1, 2, 3, 4, 5""")
def dim_line_current(spark, d):
    return S.line_current(_f(spark, d), ONE)


PARTS["o_post_current"] = f"""SELECT s.*, coalesce(p.lines_served, '') AS lines_served, coalesce(p.modes_served, '') AS modes_served, coalesce(p.directions_served, '') AS directions_served FROM o_stops s LEFT JOIN (SELECT x.stop_id, string_agg(DISTINCT t.line, ', ' ORDER BY t.line) AS lines_served, string_agg(DISTINCT r.mode, ', ' ORDER BY r.mode) AS modes_served, string_agg(DISTINCT t.direction_id::VARCHAR, ', ' ORDER BY t.direction_id::VARCHAR) AS directions_served
  FROM o_times x JOIN o_trips t ON t.trip_id = x.trip_id AND t.gtfs_snapshot_id = x.gtfs_snapshot_id JOIN o_routes r ON r.route_id = t.line AND r.gtfs_snapshot_id = t.gtfs_snapshot_id WHERE x.gtfs_snapshot_id = '{ONE}' GROUP BY 1) p ON p.stop_id = s.stop_id WHERE s.gtfs_snapshot_id = '{ONE}'"""


@query("SELECT * FROM o_post_current")
def dim_stop_post_current(spark, d):
    return S.post_current(_f(spark, d), ONE)


@query(f"""SELECT g.*, coalesce(l.v, '') AS lines_served, coalesce(m.v, '') AS modes_served, coalesce(q.v, '') AS directions_served FROM o_group_states g
  LEFT JOIN (SELECT stop_group_id, string_agg(DISTINCT x, ', ' ORDER BY x) AS v FROM (SELECT stop_group_id, unnest(string_split(lines_served, ', ')) AS x FROM o_post_current) a WHERE x <> '' GROUP BY 1) l USING (stop_group_id)
  LEFT JOIN (SELECT stop_group_id, string_agg(DISTINCT x, ', ' ORDER BY x) AS v FROM (SELECT stop_group_id, unnest(string_split(modes_served, ', ')) AS x FROM o_post_current) a WHERE x <> '' GROUP BY 1) m USING (stop_group_id)
  LEFT JOIN (SELECT stop_group_id, string_agg(DISTINCT x, ', ' ORDER BY x) AS v FROM (SELECT stop_group_id, unnest(string_split(directions_served, ', ')) AS x FROM o_post_current) a WHERE x <> '' GROUP BY 1) q USING (stop_group_id) WHERE g.gtfs_snapshot_id = '{ONE}'""")
def dim_stop_group_current(spark, d):
    return S.group_current(_f(spark, d), ONE)


@query("""SELECT d AS service_date, CASE WHEN isodow(d) > 5 THEN 'weekend' ELSE 'weekday' END AS day_type, strftime(d, '%m-%d') IN ('01-01', '01-06', '05-01', '05-03', '08-15', '11-01', '11-11', '12-25', '12-26') OR (year(d) >= 2025 AND strftime(d, '%m-%d') = '12-24') OR d - DATE '2024-03-31' IN (0, 1, 49, 60) AS is_holiday,
  dayname(d) AS weekday_name, (dayofweek(d) + 1)::INT AS day_of_week, weekofyear(d)::INT AS iso_week, month(d)::INT AS month, year(d)::INT AS year FROM (SELECT unnest(range(min(service_date), max(service_date) + 1, INTERVAL 1 DAY))::DATE AS d FROM o_cal) x""")
def dim_date(spark, d):
    return S.dates(_f(spark, d))


@query(f"""SELECT p.processing_date AS service_date, coalesce(k.a, 'unknown') AS schedule_day_type, coalesce(k.b, 'unknown') AS schedule_day_types, coalesce(k.c, '') AS schedule_service_ids FROM o_one p LEFT JOIN (SELECT service_date, {_ONE_OF} AS a, string_agg(DISTINCT cls, ', ' ORDER BY cls) AS b, string_agg(DISTINCT service_id, ', ' ORDER BY service_id) AS c FROM (SELECT *, {_CLASS} AS cls FROM o_cal WHERE gtfs_snapshot_id = '{ONE}') x GROUP BY 1) k ON k.service_date = p.processing_date""")
def dim_schedule_date(spark, d):
    return S.schedule_dates(_f(spark, d), ONE)


@query("SELECT * FROM o_profile")
def trip_stop_profile(spark, d):
    return S.stop_profiles(_f(spark, d), _history(spark, d)).withColumn("zone_ids", F.array_join("zone_ids", ","))


@query("SELECT * FROM o_universe")
def trip_universe(spark, d):
    return S.trip_universe(S.stop_profiles(_f(spark, d), _history(spark, d))).withColumn("zone_ids", F.array_join("zone_ids", ","))

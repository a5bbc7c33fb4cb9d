"""Stand-in feeds: the raw timetable, position and matcher tables that a transit agency would deliver, derived by fixed
rules from the general tables. The rules are SQL that means the same to Spark and to other engines, so that queries and
their oracles start from the same rows; everything after that is computed apart.

Feeds hold what real ones do: several snapshots, exceptions, blank and padded numbers, malformed times, points outside
the area, trips past midnight, and days on which clocks change."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tramline.sources.published import buckets, written

#: Name to SQL; {table} stands for one of the general tables, a bare name for another feed.
FEEDS = {
    "raw_snapshots": """SELECT r_regionkey AS k, date '2024-03-20' + 7 * r_regionkey AS gtfs_snapshot_date,
  CAST(date '2024-03-20' + 7 * r_regionkey AS STRING) || 'T05:00:00Z_' || lpad(CAST(r_regionkey AS STRING), 12, '0') AS snapshot_id,
  1710910800 + r_regionkey * CAST(604800 AS BIGINT) AS snapshot_s FROM {region}""",
    "raw_days": """SELECT s.k, s.snapshot_id, s.gtfs_snapshot_date, s.gtfs_snapshot_date + n_nationkey AS day, n_nationkey AS i, n_nationkey % 7 AS w
  FROM raw_snapshots s CROSS JOIN {nation} WHERE n_nationkey < 21""",
    "raw_calendar_dates": """SELECT 'PcS' AS service_id, day AS date, '1' AS exception_type, snapshot_id AS gtfs_snapshot_id FROM raw_days WHERE w IN (0, 1, 5, 6)
  UNION ALL SELECT CAST(gtfs_snapshot_date + 5 AS STRING) || ':PcS', day, '1', snapshot_id FROM raw_days WHERE w = 5 AND k % 2 = 1
  UNION ALL SELECT CASE w WHEN 2 THEN 'PtS' WHEN 3 THEN 'SbS' ELSE 'NdS' END, day, '1', snapshot_id FROM raw_days WHERE w IN (2, 3, 4)
  UNION ALL SELECT 'EXTRA', day, '1', snapshot_id FROM raw_days WHERE w = 4 AND k = 2
  UNION ALL SELECT 'SbS', day, '2', snapshot_id FROM raw_days WHERE i % 5 = 0""",
    "raw_routes": """SELECT CASE WHEN s_suppkey % 9 = 8 THEN 'C' || CAST(s_suppkey AS STRING) ELSE CAST(s_suppkey AS STRING) END AS route_id,
  'L' || CAST(s_suppkey AS STRING) || CASE WHEN s_suppkey % 4 = 1 AND k >= 2 THEN 'x' ELSE '' END AS route_short_name,
  CASE WHEN s_suppkey = 19 THEN 7 WHEN s_suppkey % 5 IN (1, 2, 4) THEN 3 WHEN s_suppkey % 5 = 0 THEN 0 WHEN s_suppkey % 10 = 3 THEN 1 ELSE 2 END AS route_type,
  snapshot_id AS gtfs_snapshot_id FROM {supplier} CROSS JOIN raw_snapshots WHERE NOT (s_suppkey % 6 = 5 AND k = 2)""",
    "raw_trips": """SELECT 'T' || CAST(o_orderkey AS STRING) AS trip_id, CASE WHEN o_custkey % 10 = 8 THEN 'C8' ELSE CAST(o_custkey % 10 AS STRING) END AS route_id,
  CASE WHEN (o_orderkey * 7 + o_custkey) % 6 = 2 THEN 'PtS' WHEN (o_orderkey * 7 + o_custkey) % 6 = 3 THEN 'SbS' WHEN (o_orderkey * 7 + o_custkey) % 6 = 4 THEN 'NdS'
    WHEN (o_orderkey * 7 + o_custkey) % 6 = 5 AND k % 2 = 1 THEN CAST(gtfs_snapshot_date + 5 AS STRING) || ':PcS' WHEN (o_orderkey * 7 + o_custkey) % 6 = 5 AND k = 2 THEN 'EXTRA' ELSE 'PcS' END AS service_id,
  CASE WHEN o_custkey % 17 = 0 THEN NULL ELSE 'Dest ' || CAST(o_custkey % 3 AS STRING) END AS trip_headsign, CAST(floor(o_orderkey / 5) AS BIGINT) % 2 AS direction_id,
  CASE WHEN o_custkey % 4 = 0 THEN '' ELSE CAST(o_custkey % 97 AS STRING) END AS block_id, CASE WHEN o_custkey % 7 = 0 THEN '' ELSE lpad(CAST(o_custkey % 30 AS STRING), 3, '0') END AS block_short_name,
  'S' || CAST(o_custkey % 10 AS STRING) AS shape_id, snapshot_id AS gtfs_snapshot_id, gtfs_snapshot_date, o_orderkey AS n, o_custkey % 10 AS line_no, k
  FROM {orders} JOIN raw_snapshots ON o_orderkey % 5 = k""",
    "raw_calls": """SELECT l_orderkey, l_linenumber, min(l_partkey) AS p, min(l_suppkey) AS s FROM {lineitem} GROUP BY l_orderkey, l_linenumber""",
    "raw_timed": """SELECT t.trip_id, t.n, t.line_no, t.direction_id, t.gtfs_snapshot_id, t.gtfs_snapshot_date, l_linenumber, p, s, 14400 + n * 37 % 80000 + l_linenumber * 180 + p % 90 AS arr,
  CAST(1000 + line_no * 10 + l_linenumber AS STRING) || CASE WHEN p % 29 = 0 THEN ':A' ELSE lpad(CAST(1 + t.direction_id AS STRING), 2, '0') END AS stop_id
  FROM raw_calls JOIN raw_trips t ON l_orderkey = t.n""",
    "raw_stop_times": """SELECT trip_id, stop_id, l_linenumber AS stop_sequence,
  CASE WHEN p % 97 = 0 THEN '' ELSE lpad(CAST(CAST(floor(arr / 3600) AS BIGINT) AS STRING), 2, '0') || ':' || lpad(CAST(CAST(floor(arr / 60) AS BIGINT) % 60 AS STRING), 2, '0') || ':' || lpad(CAST(arr % 60 AS STRING), 2, '0') END AS arrival_time,
  lpad(CAST(CAST(floor((arr + s % 3 * 20) / 3600) AS BIGINT) AS STRING), 2, '0') || ':' || lpad(CAST(CAST(floor((arr + s % 3 * 20) / 60) AS BIGINT) % 60 AS STRING), 2, '0') || ':' || lpad(CAST((arr + s % 3 * 20) % 60 AS STRING), 2, '0') AS departure_time,
  CASE WHEN n % 23 = 0 OR (l_linenumber = 1 AND n % 11 = 0) THEN '1' WHEN p % 13 = 0 THEN '3' WHEN p % 17 = 0 THEN NULL WHEN p % 19 = 0 THEN 'x' ELSE '0' END AS pickup_type,
  CASE WHEN n % 23 = 0 OR (l_linenumber = 1 AND n % 11 = 0) THEN '1' WHEN p % 31 = 0 THEN '2' ELSE '0' END AS drop_off_type, gtfs_snapshot_id, gtfs_snapshot_date FROM raw_timed""",
    "raw_stops": """SELECT stop_id, CASE WHEN g % 30 = 1 THEN 'R-' || CAST(g % 7 AS STRING) || ' Zajezdnia ' || substr(stop_id, 1, 4) WHEN g % 9 = 4 AND post = '02' THEN 'Żółta ' || substr(stop_id, 1, 4) || ' bis' ELSE 'Stop ' || substr(stop_id, 1, 4) END AS stop_name,
  post AS stop_code, CASE WHEN g % 50 = 7 THEN '' ELSE '52.' || lpad(CAST(g % 60 * 5 AS STRING), 3, '0') END AS stop_lat, CASE WHEN g % 50 = 13 AND k = 1 THEN '25.0' ELSE '21.' || lpad(CAST(g % 80 * 5 AS STRING), 3, '0') END AS stop_lon,
  CASE WHEN g % 11 = 0 THEN '2' WHEN g % 7 = 0 THEN '1+2' WHEN g % 23 = 0 THEN NULL ELSE '1' END AS zone_id, 'Stop ' || CAST(g % 10 AS STRING) AS stop_name_stem,
  CASE WHEN g % 4 = 0 AND k >= 3 THEN 'Marki' ELSE 'Warszawa' END AS town_name, snapshot_id AS gtfs_snapshot_id
  FROM (SELECT DISTINCT stop_id, CAST(substr(stop_id, 1, 4) AS INT) AS g, substr(stop_id, 5, 2) AS post FROM raw_timed) x CROSS JOIN raw_snapshots""",
    "raw_shapes": """SELECT 'S' || CAST(x.line AS STRING) AS shape_id, CASE WHEN n_nationkey = 24 THEN '50.0' ELSE '52.' || lpad(CAST(x.line * 10 + n_nationkey AS STRING), 3, '0') END AS shape_pt_lat, '21.' || lpad(CAST(x.line * 20 + n_nationkey * 2 AS STRING), 3, '0') AS shape_pt_lon,
  n_nationkey AS shape_pt_sequence, x.snapshot_id AS gtfs_snapshot_id FROM (SELECT DISTINCT o_custkey % 10 AS line, snapshot_id FROM {orders} CROSS JOIN raw_snapshots) x CROSS JOIN {nation}""",
    "raw_gps": """SELECT CAST(user_id % 20 AS STRING) AS line, CASE WHEN event_id % 41 = 0 THEN 'b!' WHEN event_id % 7 = 0 THEN 'A' || CAST(user_id % 9 AS STRING) ELSE lpad(CAST(user_id % 12 AS STRING), 3, '0') END AS brigade,
  CASE WHEN event_id % 53 = 0 THEN 'nan?' ELSE CAST(52.0 + value / 1000 AS STRING) END AS lat, CAST(CASE WHEN event_id % 61 = 0 THEN 30.0 ELSE 21.0 + value / 2000 END AS STRING) AS lon,
  1711756800 + CAST(floor(event_id * 17.3) AS BIGINT) % 518400 - CASE WHEN event_id % 9 = 0 THEN event_id % 10 ELSE 0 END AS time_s, CASE WHEN event_id % 37 = 0 THEN 'V' ELSE '' END || CAST(user_id % 60 AS STRING) AS vehicle_number,
  1 + user_id % 2 AS vehicle_type, 1711756800 + event_id AS ingested_s, event_id FROM {events}
  UNION ALL SELECT CAST(user_id % 20 AS STRING), '007', CAST(52.1 AS STRING), CAST(21.1 AS STRING), 1711756800 + CAST(floor(event_id * 17.3) AS BIGINT) % 518400, CAST(user_id % 60 AS STRING), 1 + user_id % 2, 1711756900 + event_id, event_id FROM {events} WHERE event_id % 10 = 1""",
    "raw_governed": """SELECT d.k, d.snapshot_id, d.gtfs_snapshot_date, d.day AS processing_date FROM raw_days d WHERE d.i >= 1 AND (d.k = 4 OR d.i <= 7)""",
    "matcher_runs": """SELECT g.processing_date, c.date AS service_date, t.gtfs_snapshot_id, t.trip_id, t.n, t.line_no, x.start_s, x.end_s, CAST(1000 + t.n % 211 AS STRING) AS vehicle_number,
  (t.n * 53 + CAST(substr(CAST(c.date AS STRING), 9, 2) AS INT) * 17) % 900 - 200 AS delay, (t.n * 31 + CAST(substr(CAST(c.date AS STRING), 9, 2) AS INT)) % 10 AS q
  FROM raw_governed g JOIN raw_calendar_dates c ON c.gtfs_snapshot_id = g.snapshot_id AND c.exception_type = '1' AND (c.date = g.processing_date OR c.date = g.processing_date - 1)
  JOIN raw_trips t ON t.gtfs_snapshot_id = c.gtfs_snapshot_id AND t.service_id = c.service_id
  JOIN (SELECT trip_id, min(arr) AS start_s, max(arr) AS end_s FROM raw_timed GROUP BY trip_id) x ON x.trip_id = t.trip_id
  WHERE (c.date = g.processing_date AND x.end_s < 86400) OR (c.date = g.processing_date - 1 AND x.end_s >= 86400)""",
    "matcher_trips": """SELECT processing_date, processing_date AS gps_date, service_date, gtfs_snapshot_id, trip_id, vehicle_number, start_s, end_s, delay AS start_delay_seconds, delay + q * 7 AS end_delay_seconds,
  CASE WHEN q < 6 THEN 'complete' WHEN q < 9 THEN 'partial' ELSE 'broken' END AS trip_quality, CASE WHEN q < 5 THEN 'regular' WHEN q = 5 THEN 'truncated' WHEN q = 6 THEN 'modified' WHEN q < 9 THEN 'regular' ELSE 'matching_failure' END AS service_observation_class,
  q = 8 AS has_non_monotonic_stop_progression FROM matcher_runs
  UNION ALL SELECT processing_date, processing_date, service_date, gtfs_snapshot_id, trip_id, vehicle_number, start_s, end_s, delay + 5, delay + 9, CASE WHEN n % 2 = 0 THEN 'partial' ELSE 'broken' END, 'regular', false FROM matcher_runs WHERE n % 20 < 2""",
    "matcher_arrivals": """SELECT r.processing_date, r.processing_date AS gps_date, r.service_date, r.gtfs_snapshot_id, r.trip_id, r.vehicle_number, c.l_linenumber AS stop_sequence, c.stop_id, c.arr AS scheduled_s, r.delay + c.l_linenumber * 13 % 60 - 30 AS delay_seconds,
  CASE WHEN r.q < 6 THEN 'complete' WHEN r.q < 9 THEN 'partial' ELSE 'broken' END AS trip_quality, CASE WHEN (r.n + c.l_linenumber) % 10 = 9 THEN 'uncertain' ELSE 'observed' END AS observation_status
  FROM matcher_runs r JOIN raw_timed c ON c.trip_id = r.trip_id WHERE (r.n * 3 + c.l_linenumber * 7) % 10 < 8""",
    "matcher_semantics": """SELECT DISTINCT r.processing_date, r.service_date, r.gtfs_snapshot_id, r.trip_id, c.l_linenumber AS stop_sequence, c.stop_id, c.arr AS scheduled_s,
  CASE WHEN c.n % 23 = 0 OR (c.l_linenumber = 1 AND c.n % 11 = 0) THEN 'not_in_passenger_service' WHEN c.p % 13 = 0 OR c.p % 31 = 0 THEN 'request' ELSE 'regular' END AS stop_service_class,
  CASE WHEN c.n % 23 = 0 THEN 'technical_trip' WHEN c.l_linenumber = 1 AND c.n % 11 = 0 THEN 'technical_prefix' WHEN c.n % 29 = 0 AND c.l_linenumber = 2 THEN 'unknown' ELSE 'passenger' END AS stop_execution_class,
  NOT (c.n % 23 = 0 OR (c.l_linenumber = 1 AND c.n % 11 = 0)) AS is_passenger_stop, c.n % 29 <> 0 AS are_passenger_boundaries_settled FROM matcher_runs r JOIN raw_timed c ON c.trip_id = r.trip_id""",
    # one day's courses of vehicles and their pings: whole rides, rides that never arrive, that start outside, that turn back, and with a pause
    "raw_courses": """SELECT trip_id, n, CAST(line_no AS STRING) AS line, CAST(n % 3 AS STRING) AS brigade, vehicle_number, 1712700000 + start_s AS scheduled_start_s, 1712700000 + start_s + 1320 AS scheduled_end_s,
  (52100000 + line_no * 10000) / 1000000.0E0 AS origin_lat, 21000000 / 1000000.0E0 AS origin_lon, (52120000 + line_no * 10000) / 1000000.0E0 AS destination_lat, 21020000 / 1000000.0E0 AS destination_lon, delay FROM matcher_runs WHERE processing_date = date '2024-04-10' AND service_date = date '2024-04-10'""",
    "raw_track": """SELECT c.vehicle_number, c.line, c.brigade, c.scheduled_start_s + c.delay + x.k * 60 + CASE WHEN CAST(floor(c.n / 5) AS BIGINT) % 5 = 4 AND x.k > 1 THEN 400 ELSE 0 END AS time_s, (c.origin_lat * 1000000 + x.p * 20) / 1000000.0E0 AS lat, (21000000 + x.p * 20) / 1000000.0E0 AS lon
  FROM raw_courses c JOIN (SELECT n_nationkey AS k, m, CASE WHEN m = 1 THEN least(600, greatest(0, n_nationkey - 2) * 55) WHEN m = 2 THEN 300 + least(700, n_nationkey * 40) WHEN m = 3 AND n_nationkey > 6 AND n_nationkey < 12 THEN 0 WHEN n_nationkey < 3 THEN 0 ELSE least(1000, (n_nationkey - 2) * 55) END AS p FROM {nation} CROSS JOIN (SELECT r_regionkey AS m FROM {region}) r) x ON x.m = CAST(floor(c.n / 5) AS BIGINT) % 5""",
    "raw_minutes": """SELECT CASE WHEN t.m = 0 THEN 'bus' ELSE 'tram' END AS mode, 1711756800 + event_id * 60 AS at_s, 6 AS attempts, CASE WHEN CAST(floor(event_id / 40) AS BIGINT) % 9 = 4 AND event_id % 4 <> 1 THEN 2 ELSE 6 END AS successes,
  CAST(floor((90 + (event_id * 7 + t.m * 13) % 21) * CASE WHEN CAST(floor(event_id / 25) AS BIGINT) % 17 = 3 + t.m THEN 0.25 WHEN event_id % 1440 < 240 THEN 0.15 ELSE 1.0 END) AS BIGINT) AS vehicles FROM {events} CROSS JOIN (SELECT r_regionkey AS m FROM {region} WHERE r_regionkey < 2) t WHERE event_id % 211 >= 5""",
}


#: The same rows for Spark, in an order of joins that deals trips out by trip_id once: calls and bounds meet their trip
#: first, the few days multiply it by broadcast, and what is made of a trip stays where the trip is.
PLANNED = {
    "raw_calls": "SELECT l_orderkey, l_linenumber, min(l_partkey) AS p, min(l_suppkey) AS s FROM (SELECT /*+ REPARTITION(l_orderkey) */ l_orderkey, l_linenumber, l_partkey, l_suppkey FROM {lineitem}) GROUP BY l_orderkey, l_linenumber",
    "raw_timed": """SELECT t.trip_id, t.n, t.line_no, t.direction_id, t.gtfs_snapshot_id, t.gtfs_snapshot_date, l_linenumber, p, s, 14400 + n * 37 % 80000 + l_linenumber * 180 + p % 90 AS arr,
  CAST(1000 + line_no * 10 + l_linenumber AS STRING) || CASE WHEN p % 29 = 0 THEN ':A' ELSE lpad(CAST(1 + t.direction_id AS STRING), 2, '0') END AS stop_id
  FROM (SELECT call_trip, l_linenumber, min(l_partkey) AS p, min(l_suppkey) AS s FROM (SELECT /*+ REPARTITION(call_trip) */ 'T' || CAST(l_orderkey AS STRING) AS call_trip, l_linenumber, l_partkey, l_suppkey FROM {lineitem}) GROUP BY call_trip, l_linenumber) JOIN raw_trips t ON call_trip = t.trip_id""",
    "raw_running": "SELECT g.processing_date, c.date AS service_date, c.gtfs_snapshot_id, c.service_id FROM raw_governed g JOIN raw_calendar_dates c ON c.gtfs_snapshot_id = g.snapshot_id AND c.exception_type = '1' AND (c.date = g.processing_date OR c.date = g.processing_date - 1)",
    "matcher_runs": """SELECT /*+ BROADCAST(c) */ c.processing_date, c.service_date, t.gtfs_snapshot_id, t.trip_id, t.n, t.line_no, x.start_s, x.end_s, CAST(1000 + t.n % 211 AS STRING) AS vehicle_number,
  (t.n * 53 + CAST(substr(CAST(c.service_date AS STRING), 9, 2) AS INT) * 17) % 900 - 200 AS delay, (t.n * 31 + CAST(substr(CAST(c.service_date AS STRING), 9, 2) AS INT)) % 10 AS q
  FROM raw_trips t JOIN (SELECT trip_id, min(arr) AS start_s, max(arr) AS end_s FROM raw_timed GROUP BY trip_id) x ON x.trip_id = t.trip_id JOIN raw_running c ON t.gtfs_snapshot_id = c.gtfs_snapshot_id AND t.service_id = c.service_id
  WHERE (c.service_date = c.processing_date AND x.end_s < 86400) OR (c.service_date = c.processing_date - 1 AND x.end_s >= 86400)""",
    "matcher_trips": """SELECT processing_date, processing_date AS gps_date, service_date, gtfs_snapshot_id, trip_id, vehicle_number, start_s, end_s, CASE WHEN again THEN delay + 5 ELSE delay END AS start_delay_seconds, CASE WHEN again THEN delay + 9 ELSE delay + q * 7 END AS end_delay_seconds,
  CASE WHEN again AND n % 2 = 0 THEN 'partial' WHEN again THEN 'broken' WHEN q < 6 THEN 'complete' WHEN q < 9 THEN 'partial' ELSE 'broken' END AS trip_quality, CASE WHEN again OR q < 5 THEN 'regular' WHEN q = 5 THEN 'truncated' WHEN q = 6 THEN 'modified' WHEN q < 9 THEN 'regular' ELSE 'matching_failure' END AS service_observation_class,
  NOT again AND q = 8 AS has_non_monotonic_stop_progression FROM matcher_runs LATERAL VIEW explode(CASE WHEN n % 20 < 2 THEN array(false, true) ELSE array(false) END) e AS again""",
    # one day's courses meet the calls of their own trips, whose bounds follow from the order's key and its lines
    "raw_ridden": """SELECT /*+ BROADCAST(c) */ t.trip_id, t.n, t.line_no FROM raw_trips t JOIN raw_running c ON t.gtfs_snapshot_id = c.gtfs_snapshot_id AND t.service_id = c.service_id WHERE c.processing_date = date '2024-04-10' AND c.service_date = date '2024-04-10'""",
    "raw_courses": """SELECT trip_id, n, CAST(line_no AS STRING) AS line, CAST(n % 3 AS STRING) AS brigade, CAST(1000 + n % 211 AS STRING) AS vehicle_number, 1712700000 + start_s AS scheduled_start_s, 1712700000 + start_s + 1320 AS scheduled_end_s,
  (52100000 + line_no * 10000) / 1000000.0E0 AS origin_lat, 21000000 / 1000000.0E0 AS origin_lon, (52120000 + line_no * 10000) / 1000000.0E0 AS destination_lat, 21020000 / 1000000.0E0 AS destination_lon, (n * 53 + 10 * 17) % 900 - 200 AS delay
  FROM (SELECT r.*, 14400 + n * 37 % 80000 + a AS start_s, 14400 + n * 37 % 80000 + z AS end_s FROM raw_ridden r JOIN (SELECT l_orderkey, min(l_linenumber * 180 + p % 90) AS a, max(l_linenumber * 180 + p % 90) AS z
    FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS p FROM {lineitem} LEFT SEMI JOIN raw_ridden ON l_orderkey = n GROUP BY l_orderkey, l_linenumber) GROUP BY l_orderkey) x ON x.l_orderkey = r.n) WHERE end_s < 86400""",
    # what matcher_semantics says of a trip's calls, the same in each of its runs
    "matcher_calls": """SELECT DISTINCT gtfs_snapshot_id, trip_id, l_linenumber AS stop_sequence, stop_id, CASE WHEN n % 23 = 0 OR (l_linenumber = 1 AND n % 11 = 0) THEN 'not_in_passenger_service' WHEN p % 13 = 0 OR p % 31 = 0 THEN 'request' ELSE 'regular' END AS stop_service_class,
  CASE WHEN n % 23 = 0 THEN 'technical_trip' WHEN l_linenumber = 1 AND n % 11 = 0 THEN 'technical_prefix' WHEN n % 29 = 0 AND l_linenumber = 2 THEN 'unknown' ELSE 'passenger' END AS stop_execution_class,
  NOT (n % 23 = 0 OR (l_linenumber = 1 AND n % 11 = 0)) AS is_passenger_stop, n % 29 <> 0 AS are_passenger_boundaries_settled FROM (SELECT /*+ REPARTITION(trip_id) */ gtfs_snapshot_id, trip_id, n, l_linenumber, p, stop_id, arr FROM raw_timed)""",
}
#: Feeds that many others read: written once for each application.
STORED = ("raw_timed", "raw_running", "raw_courses")


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A feed as a frame."""
    sql, order, n_buckets = FEEDS | PLANNED, [], buckets(spark, sf_dir)
    if n_buckets:  # calls are dealt out as they are stored, and stored ones lie by trip
        sql["raw_timed"] = sql["raw_timed"].replace("REPARTITION(call_trip)", f"REPARTITION({n_buckets}, call_trip)")
        sql["matcher_calls"] = sql["matcher_calls"].replace("/*+ REPARTITION(trip_id) */ ", "")

    def need(n: str) -> None:
        if n != name and n in STORED:
            sql[n] = f"SELECT * FROM {stored(spark, sf_dir, n)}"
        for other in re.findall(r"\b(?:raw|matcher)_[a-z_]+\b", "" if n != name and n in STORED else sql[n]):
            if other in sql and other not in order:
                need(other)
        if n not in order:
            order.append(n)

    need(name)
    tables = {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in ("region", "nation", "supplier", "orders", "lineitem", "events", "part", "customer")}
    parts = ", ".join(f"{n} AS ({re.sub(r"\{([a-z]+)\}", lambda m: tables[m[1]], sql[n])})" for n in order)
    return spark.sql(f"WITH {parts} SELECT * FROM {name}")


def stored(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A feed that many others read, as SQL names it."""
    return written(spark, sf_dir, name, lambda: feed(spark, sf_dir, name), name == "raw_timed")


def portable() -> dict[str, str]:
    """The feeds' SQL for an engine that knows the general tables by name."""
    return {n: re.sub(r"\{([a-z]+)\}", r"\1", s) for n, s in FEEDS.items()}

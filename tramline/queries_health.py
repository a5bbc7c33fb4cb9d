"""Registered queries on feed health, data quality and lookups, each with SQL written from the rules."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tramline.plans import feed_health as H
from tramline.plans import quality as Q
from tramline.plans import schedule as S
from tramline.queries_facts import arrival_table, event_table, execution_table, trip_table
from tramline.queries_marts import END, entity_table, pipeline_status, serving_table
from tramline.queries_matching import M as _M  # noqa: F401  (registers the parts used below)
from tramline.queries_schedule import ONE, _f, duty_chain, local
from tramline.registry import PARTS, query
from tramline.sources.published import published

NOW = 1711800000
_CLS = "CASE isodow({0}) WHEN 7 THEN 'sunday' WHEN 6 THEN 'saturday' ELSE 'weekday' END"
PARTS |= {
    "o_minute": f"SELECT *, {local('at_s')}::DATE AS day, strftime({local('at_s')}, '%H:%M') AS clock FROM raw_minutes",
    "o_comparable": f"SELECT day, other FROM (SELECT a.day, b.day AS other, row_number() OVER (PARTITION BY a.day ORDER BY b.day DESC) AS r FROM (SELECT DISTINCT day FROM o_minute) a JOIN (SELECT DISTINCT day FROM o_minute) b ON {_CLS.format('a.day')} = {_CLS.format('b.day')} AND a.day - b.day BETWEEN 1 AND 28) x WHERE r <= 4",
    "o_values": "SELECT c.day, v.mode, v.clock, v.v, quantile_cont(v.v, 0.5) OVER (PARTITION BY c.day, v.mode, v.clock) AS typical, count(*) OVER (PARTITION BY c.day, v.mode, v.clock) AS n FROM o_comparable c JOIN (SELECT mode, day, clock, quantile_cont(vehicles, 0.5) AS v FROM o_minute WHERE successes >= attempts * 0.5 GROUP BY 1, 2, 3) v ON v.day = c.other",
    "o_baseline": "SELECT m.*, coalesce(b.samples, 0)::INT AS samples, b.usual, b.low, b.high FROM o_minute m LEFT JOIN (SELECT day, mode, clock, max(n) AS samples, round(quantile_cont(v, 0.5) FILTER (v >= 0.5 * typical), 1) AS usual, round(min(v) FILTER (v >= 0.5 * typical), 1) AS low, round(max(v) FILTER (v >= 0.5 * typical), 1) AS high FROM o_values WHERE n >= 3 GROUP BY 1, 2, 3) b ON b.day = m.day AND b.mode = m.mode AND b.clock = m.clock",
    "o_judged": "SELECT *, CASE WHEN attempts = 0 OR successes / attempts::DOUBLE < 0.5 THEN 'api_failures' WHEN coalesce(usual, 0) < 20 THEN NULL WHEN vehicles = 0 THEN 'no_accepted' WHEN vehicles < 0.5 * usual THEN 'low_fleet' END AS bad_reason FROM o_baseline",
    "o_long": "SELECT mode, bad, min(at_s) AS start_s FROM (SELECT mode, at_s, bad_reason IS NOT NULL AS bad, at_s // 60 - row_number() OVER (PARTITION BY mode, bad_reason IS NOT NULL ORDER BY at_s) AS run FROM o_judged) x GROUP BY mode, bad, run HAVING count(*) >= 15",
    "o_incident": "SELECT b.mode, b.start_s, (SELECT min(g.start_s) FROM o_long g WHERE g.mode = b.mode AND NOT g.bad AND g.start_s > b.start_s) AS end_s FROM o_long b WHERE b.bad AND NOT EXISTS (SELECT 1 FROM o_long p WHERE p.mode = b.mode AND p.bad AND p.start_s < b.start_s AND NOT EXISTS (SELECT 1 FROM o_long g WHERE g.mode = b.mode AND NOT g.bad AND g.start_s > p.start_s AND g.start_s < b.start_s))",
    "o_hour": "SELECT h.*, CASE WHEN EXISTS (SELECT 1 FROM o_incident i WHERE i.mode = h.mode AND i.start_s < h.hour_s + 3600 AND coalesce(i.end_s, h.last_s + 60) > h.hour_s) THEN 'degraded' WHEN monitored_minutes < 60 THEN 'monitoring_gap' WHEN baseline_samples = 0 THEN 'warming_up' ELSE 'healthy' END AS status FROM (SELECT mode, at_s - at_s % 3600 AS hour_s, count(*) AS monitored_minutes, max(samples) AS baseline_samples, sum(vehicles)::BIGINT AS vehicle_minutes, max(max(at_s)) OVER (PARTITION BY mode) AS last_s FROM o_baseline GROUP BY 1, 2) h",
}


def _based(spark, d):
    return published(spark, d, "health_baseline", lambda: H.baseline(_f(spark, d)("raw_minutes")))


def _incidents(spark, d):
    return H.incidents(H.judged(_based(spark, d)).withColumn("is_bad", F.col("bad_reason").isNotNull()))


@query("SELECT vehicle_type, ingested_s - ingested_s % 60 AS minute_s, count(*) AS parsed, count(*) FILTER (time_s BETWEEN ingested_s - 300 AND ingested_s + 60) AS accepted, count(*) FILTER (time_s < ingested_s - 300) AS dropped_stale, count(*) FILTER (time_s > ingested_s + 60) AS dropped_future FROM raw_gps GROUP BY 1, 2")
def ping_freshness(spark, d):
    return H.freshness(_f(spark, d)("raw_gps"))


_NAIVE = "TIMESTAMP '2024-10-27 00:00:00' + to_seconds(event_id * 37 % 21600)"


@query(f"SELECT event_id, arg_min(x, abs(x - received)) AS at_s FROM (SELECT event_id, received, unnest([a, b]) AS x, naive FROM (SELECT event_id, {_NAIVE} AS naive, 1729980000 + event_id * 37 % 21600 + event_id % 2 * 3600 AS received, epoch({_NAIVE})::BIGINT - 3600 AS a, epoch({_NAIVE})::BIGINT - 7200 AS b FROM events) y) z WHERE timezone('Europe/Warsaw', to_timestamp(x)) = naive GROUP BY 1")
def ambiguous_local_time(spark, d):
    """Wall-clock times of the night on which clocks go back, each with its receipt."""
    from tramline.sources.tables import table

    off = F.pmod(F.col("event_id") * 37, F.lit(21600))
    naive = F.timestamp_add("SECOND", off, F.lit("2024-10-27 00:00:00").cast("timestamp_ntz"))
    return table(spark, d, "events").select("event_id", H.local_instant(naive, 1729980000 + off + F.col("event_id") % 2 * 3600).alias("at_s"))


@query("SELECT mode, at_s, samples, usual, low, high FROM o_baseline")
def fleet_baseline(spark, d):
    return H.baseline(_f(spark, d)("raw_minutes")).select("mode", "at_s", "samples", "usual", "low", "high")


@query("SELECT mode, at_s, bad_reason FROM o_judged")
def bad_minutes(spark, d):
    return H.judged(_based(spark, d)).select("mode", "at_s", "bad_reason")


@query("SELECT * FROM o_incident")
def minute_incidents(spark, d):
    return _incidents(spark, d)


@query("SELECT * EXCLUDE (last_s) FROM o_hour")
def hour_health(spark, d):
    return H.hour_status(_based(spark, d), _incidents(spark, d))


@query(f"""SELECT *, CASE WHEN degraded_hours > 0 THEN 'degraded' WHEN monitoring_gap_hours > 0 THEN 'monitoring_gap' WHEN warming_up_hours > 0 THEN 'warming_up' WHEN healthy_hours > 0 THEN 'healthy' ELSE 'not_monitored' END AS status FROM (SELECT {local('hour_s')}::DATE AS gps_date, mode, count(*) AS evaluated_hours, sum(monitored_minutes)::BIGINT AS monitored_minutes, count(*) FILTER (status = 'degraded') AS degraded_hours, count(*) FILTER (status = 'monitoring_gap') AS monitoring_gap_hours, count(*) FILTER (status = 'warming_up') AS warming_up_hours, count(*) FILTER (status = 'healthy') AS healthy_hours, count(*) FILTER (baseline_samples >= 3) AS hours_with_comparable_history FROM o_hour GROUP BY 1, 2) x""")
def day_health(spark, d):
    return H.day_status(hour_health(spark, d))


@query("SELECT mode, transition, at_s, sha256(concat_ws('|', mode, transition, at_s::VARCHAR)) AS event_id FROM (SELECT mode, 'degraded' AS transition, start_s AS at_s FROM o_incident UNION SELECT mode, 'recovered', end_s FROM o_incident WHERE end_s IS NOT NULL) x")
def alert_outbox(spark, d):
    i = _incidents(spark, d)
    return H.outbox(i.unionByName(i))


@query(f"SELECT service_date, {_CLS.format('service_date')} AS class, blocks, quantile_cont(blocks, 0.5) OVER (PARTITION BY {_CLS.format('service_date')}) AS usual, blocks / quantile_cont(blocks, 0.5) OVER (PARTITION BY {_CLS.format('service_date')}) AS scale FROM (SELECT service_date, count(DISTINCT duty_chain_id) AS blocks FROM o_chain GROUP BY 1) x")
def planned_scale(spark, d):
    return H.planned_scale(published(spark, d, "duty_chain", lambda: duty_chain(spark, d)))


@query(f"SELECT mode, last_s, failed, vehicles, usual, CASE WHEN {NOW} - last_s > 180 THEN 'silent' WHEN failed >= 3 THEN 'failing' WHEN vehicles < 0.5 * usual THEN 'thin' ELSE 'normal' END AS state FROM (SELECT mode, max(at_s) AS last_s, count(*) FILTER (successes < attempts * 0.5) AS failed, arg_max(vehicles, at_s) AS vehicles, max(usual) FILTER (r = 1) AS usual FROM (SELECT *, row_number() OVER (PARTITION BY mode ORDER BY at_s DESC) AS r FROM o_baseline WHERE at_s <= {NOW}) x WHERE r <= 3 GROUP BY 1) y")
def live_mode_state(spark, d):
    return H.mode_state(_based(spark, d), NOW)


# --- data quality ---


@query("""SELECT 'null_line' AS issue, count(*) FILTER (line IS NULL) AS n FROM o_trip UNION ALL SELECT 'null_version', count(*) FILTER (schedule_version_id IS NULL) FROM o_trip UNION ALL SELECT 'unknown_quality', count(*) FILTER (trip_quality NOT IN ('complete', 'partial', 'broken')) FROM o_trip UNION ALL SELECT 'ends_before_start', count(*) FILTER (scheduled_end_s < scheduled_start_s) FROM o_trip UNION ALL SELECT 'no_headsign', count(*) FILTER (trip_headsign IS NULL) FROM o_trip
  UNION ALL SELECT 'extreme_delay', count(*) FILTER (abs(end_delay_seconds) > 600) FROM o_trip UNION ALL SELECT 'duplicate_key', (SELECT count(*) FROM (SELECT 1 FROM o_trip GROUP BY service_date, trip_id HAVING count(*) > 1) x)""")
def trip_contract(spark, d):
    """Violations of the trips' contract, by issue; some rules are set so that these rows break them."""
    rules = {"null_line": "line IS NULL", "null_version": "schedule_version_id IS NULL", "unknown_quality": "trip_quality NOT IN ('complete', 'partial', 'broken')", "ends_before_start": "scheduled_end_s < scheduled_start_s", "no_headsign": "trip_headsign IS NULL", "extreme_delay": "abs(end_delay_seconds) > 600"}
    return Q.violations(trip_table(spark, d), rules, {"duplicate_key": ["service_date", "trip_id"]})


@query("SELECT 'event_without_trip' AS issue, count(*) AS n FROM (SELECT DISTINCT trip_id, service_date, gps_date, vehicle_number FROM o_event) e WHERE NOT EXISTS (SELECT 1 FROM o_execution t WHERE t.trip_id = e.trip_id AND t.service_date = e.service_date AND t.gps_date = e.gps_date AND t.vehicle_number = e.vehicle_number) UNION ALL SELECT 'trip_without_event', count(*) FROM o_trip t WHERE NOT EXISTS (SELECT 1 FROM o_arrival e WHERE t.trip_id = e.trip_id AND t.service_date = e.service_date AND t.gps_date = e.gps_date AND t.vehicle_number = e.vehicle_number)")
def trip_event_relations(spark, d):
    """Orphans both ways: events against bus and tram executions, trips against arrivals."""
    keys = ["trip_id", "service_date", "gps_date", "vehicle_number"]
    return Q.orphans(event_table(spark, d), execution_table(spark, d), keys, "event_without_trip").unionByName(Q.orphans(trip_table(spark, d), arrival_table(spark, d), keys, "trip_without_event", distinct=False))


@query("SELECT 'ratio_out_of_range' AS issue, count(*) FILTER (completeness_ratio NOT BETWEEN 0 AND 1) AS n FROM o_status UNION ALL SELECT 'complete_but_ratio', count(*) FILTER (is_complete_day AND completeness_ratio <> 1) FROM o_status UNION ALL SELECT 'no_coverage', count(*) FILTER (service_coverage_ratio IS NULL) FROM o_status UNION ALL SELECT 'incomplete_gps_day', count(*) FILTER (NOT is_complete_day) FROM o_status UNION ALL SELECT 'duplicate_day_mode', (SELECT count(*) FROM (SELECT 1 FROM o_status GROUP BY service_date, mode HAVING count(*) > 1) x)")
def status_invariants(spark, d):
    rules = {"ratio_out_of_range": "completeness_ratio NOT BETWEEN 0 AND 1", "complete_but_ratio": "is_complete_day AND completeness_ratio <> 1", "no_coverage": "service_coverage_ratio IS NULL", "incomplete_gps_day": "NOT is_complete_day"}
    return Q.violations(pipeline_status(spark, d), rules, {"duplicate_day_mode": ["service_date", "mode"]})


@query("SELECT 'only_left' AS side, service_date FROM (SELECT DISTINCT service_date FROM o_trip EXCEPT SELECT DISTINCT gps_date FROM o_ping) a UNION ALL SELECT 'only_right', gps_date FROM (SELECT DISTINCT gps_date FROM o_ping EXCEPT SELECT DISTINCT service_date FROM o_trip) b")
def date_alignment(spark, d):
    from tramline.queries_marts import ping_table

    return Q.set_difference(trip_table(spark, d).select("service_date"), ping_table(spark, d).select(F.col("gps_date").alias("service_date")))


# --- lookups ---


@query("SELECT service_date, mode, line, trip_id, vehicle_number, end_delay_seconds, place FROM (SELECT *, (row_number() OVER (PARTITION BY mode, service_date ORDER BY abs(end_delay_seconds) DESC, trip_id, vehicle_number))::INT AS place FROM o_execution WHERE trip_quality = 'complete') x WHERE place <= 8")
def landing_worst(spark, d):
    w = Window.partitionBy("mode", "service_date").orderBy(F.abs("end_delay_seconds").desc(), "trip_id", "vehicle_number")
    return execution_table(spark, d).where("trip_quality = 'complete'").withColumn("place", F.row_number().over(w)).where("place <= 8").select("service_date", "mode", "line", "trip_id", "vehicle_number", "end_delay_seconds", "place")


@query(f"SELECT d.n::INT AS isodow, m.mode, count(a.delay_seconds) AS arrivals, quantile_cont(a.delay_seconds, 0.5) AS median_delay FROM (SELECT unnest(range(1, 8)) AS n) d CROSS JOIN (SELECT DISTINCT mode FROM o_complete) m LEFT JOIN o_complete a ON isodow(a.service_date) = d.n AND a.mode = m.mode AND a.service_date <= DATE '{END}' GROUP BY 1, 2")
def week_bars(spark, d):
    a = serving_table(spark, d).where((F.col("trip_quality") == "complete") & F.col("mode").isin("bus", "tram"))
    per = a.where(F.col("service_date") <= END).groupBy((F.weekday("service_date") + 1).alias("isodow"), "mode").agg(F.count("delay_seconds").alias("arrivals"), F.percentile("delay_seconds", 0.5).alias("median_delay"))
    spine = a.select("mode").distinct().select("mode", F.explode(F.sequence(F.lit(1), F.lit(7))).alias("isodow"))
    return spine.join(per, ["isodow", "mode"], "left").fillna(0, ["arrivals"])


@query("SELECT line, mode, n, posts FROM (SELECT line, min(mode) AS mode, count(*) AS n, string_agg(DISTINCT stop_id, ',' ORDER BY stop_id) AS posts FROM o_complete GROUP BY 1) x")
def posts_by_line(spark, d):
    a = serving_table(spark, d).where((F.col("trip_quality") == "complete") & F.col("mode").isin("bus", "tram"))
    return a.groupBy("line").agg(F.min("mode").alias("mode"), F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("stop_id")), ",").alias("posts"))


@query(f"SELECT stop_group_id, stop_group_name, lower(strip_accents(replace(replace(stop_group_name, 'ł', 'l'), 'Ł', 'L'))) AS search_key, stop_post_count, CASE WHEN lower(strip_accents(replace(replace(stop_group_name, 'ł', 'l'), 'Ł', 'L'))) = 'zolta 1004' THEN 0 WHEN lower(strip_accents(replace(replace(stop_group_name, 'ł', 'l'), 'Ł', 'L'))) LIKE 'zo%' THEN 1 ELSE 2 END AS place FROM o_group_states WHERE gtfs_snapshot_id = '{ONE}' AND lower(strip_accents(replace(replace(stop_group_name, 'ł', 'l'), 'Ł', 'L'))) LIKE '%o%1%'")
def stop_suggest(spark, d):
    """Stop groups whose accent-free name holds what is typed, exact ones first, then those that start with it."""
    from tramline.functions.columns import search_key

    g = S.group_states(S.stops(_f(spark, d))).where(F.col(S.SNAP) == ONE).withColumn("search_key", search_key(F.col("stop_group_name")))
    place = F.when(F.col("search_key") == "zolta 1004", 0).when(F.col("search_key").like("zo%"), 1).otherwise(2)
    return g.where(F.col("search_key").like("%o%1%")).select("stop_group_id", "stop_group_name", "search_key", "stop_post_count", place.alias("place"))


@query("SELECT e.entity_id AS line, e.mode, e.window_type, e.median_delay, r.position FROM o_entity e JOIN (SELECT entity_id, mode, window_type, window_key, row_number() OVER (PARTITION BY mode, window_type, window_key ORDER BY median_delay DESC, entity_id)::INT AS position FROM o_entity WHERE entity_type = 'line' AND universe_type = 'all_observed') r ON r.entity_id = e.entity_id AND r.mode = e.mode AND r.window_type = e.window_type AND r.window_key = e.window_key WHERE e.entity_type = 'line' AND e.universe_type = 'all_observed' AND r.position BETWEEN 1 AND 8")
def overview_lines(spark, d):
    """The eight latest lines of each mode and window."""
    w = Window.partitionBy("mode", "window_type", "window_key").orderBy(F.desc("median_delay"), "entity_id")
    e = entity_table(spark, d).where("entity_type = 'line' AND universe_type = 'all_observed'").withColumn("position", F.row_number().over(w)).where("position <= 8")
    return e.select(F.col("entity_id").alias("line"), "mode", "window_type", "median_delay", "position")


@query("SELECT service_date, trip_id, vehicle_number, gps_date, trip_quality FROM (SELECT *, row_number() OVER (PARTITION BY service_date, trip_id ORDER BY CASE trip_quality WHEN 'complete' THEN 0 ELSE 1 END, actual_end_s DESC, vehicle_number) AS r FROM o_execution) x WHERE r = 1")
def trip_detail(spark, d):
    """The execution that a trip's page shows: a complete one first, then the one that ended last."""
    w = Window.partitionBy("service_date", "trip_id").orderBy(F.when(F.col("trip_quality") == "complete", 0).otherwise(1), F.desc("actual_end_s"), "vehicle_number")
    return execution_table(spark, d).withColumn("r", F.row_number().over(w)).where("r = 1").select("service_date", "trip_id", "vehicle_number", "gps_date", "trip_quality")


@query("SELECT service_date, trip_id, vehicle_number, stop_sequence, stop_name, observation_status FROM o_event WHERE observation_status <> 'not_in_passenger_service'")
def trip_stops(spark, d):
    return event_table(spark, d).where("observation_status <> 'not_in_passenger_service'").select("service_date", "trip_id", "vehicle_number", "stop_sequence", "stop_name", "observation_status")

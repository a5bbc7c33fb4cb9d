"""Registered queries on travel times, each with SQL written from the rules and not from the code."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.plans import schedule as S
from tramline.plans import travel as T
from tramline.queries_facts import arrival_table, event_table, trip_table
from tramline.queries_schedule import ONE, _f, local, start_of
from tramline.registry import PARTS, query
from tramline.sources.published import published

#: Slots are fitted on the dates before this one and judged on it and after.
SPLIT = "2024-04-10"
_HB = "CASE WHEN {0} < 6 THEN 0 WHEN {0} < 10 THEN 1 WHEN {0} < 14 THEN 2 WHEN {0} < 19 THEN 3 ELSE 4 END"
_BAND = "CASE WHEN {0} % 24 >= 23 OR {0} % 24 < 5 THEN 'night' WHEN {1} AND {0} % 24 IN (7, 8, 15, 16, 17) THEN 'peak' ELSE 'other' END"
_METRES = "2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin((radians({2}) - radians({0})) / 2), 2) + cos(radians({0})) * cos(radians({2})) * pow(sin((radians({3}) - radians({1})) / 2), 2))))"
PARTS |= {
    "o_seg": f"""SELECT service_date, trip_id, vehicle_number, mode, line, direction_id, a_stop, stop_id AS b_stop, stop_sequence AS b_seq, pos, is_holiday, round({_METRES.format('a_lat', 'a_lon', 'stop_lat', 'stop_lon')}, 3) AS dist_m, a_s - {start_of('service_date')} AS a_sched_sod, scheduled_arrival_s - a_s AS sched_s, actual_arrival_s - a_t AS actual_s
  FROM (SELECT a.*, s.stop_lat, s.stop_lon, lag(a.stop_id) OVER w AS a_stop, lag(a.stop_sequence) OVER w AS a_seq, lag(a.actual_arrival_s) OVER w AS a_t, lag(a.scheduled_arrival_s) OVER w AS a_s, lag(s.stop_lat) OVER w AS a_lat, lag(s.stop_lon) OVER w AS a_lon, a.stop_sequence - min(a.stop_sequence) OVER (PARTITION BY a.service_date, a.trip_id, a.vehicle_number) AS pos
    FROM o_arrival a JOIN o_stops s ON s.gtfs_snapshot_id = a.gtfs_snapshot_id AND s.stop_id = a.stop_id WHERE a.trip_quality = 'complete' WINDOW w AS (PARTITION BY a.service_date, a.trip_id, a.vehicle_number ORDER BY a.stop_sequence)) x WHERE stop_sequence = a_seq + 1 AND actual_arrival_s > a_t""",
    "o_feat": f"""SELECT *, a_stop || '>' || b_stop AS seg, substr(a_stop, 1, 4) || '>' || substr(b_stop, 1, 4) AS grp, CASE WHEN is_holiday OR isodow(service_date) = 7 THEN 2 WHEN isodow(service_date) = 6 THEN 1 ELSE 0 END AS daytype, (a_sched_sod // 3600)::INT AS hr, {_HB.format('(a_sched_sod // 3600)')} AS hb, (least(greatest(sched_s, 0), 900) // 30)::INT AS sched_b, mode = 'tram' AS is_tram, (((service_date - DATE '2000-01-03') // 7) % 4)::INT AS fold FROM o_seg""",
}


def _lookup(source: str, where: str = "true", target: str = "true") -> str:
    """The chain of levels as one statement: `source` rows that fulfil `where` are fitted, those of `target` predicted."""
    s = f"(SELECT * FROM {source} WHERE {where})"
    return f"""SELECT s.*, coalesce(b.p0, f.fb) + coalesce(x1.adj1, 0) + coalesce(x2.adj2, 0) + coalesce(x3.adj3, 0) AS pred, coalesce(x1.n1, 0) AS n1, coalesce(x2.n2, 0) AS n2, coalesce(x3.n3, 0) AS n3 FROM (SELECT * FROM {source} WHERE {target}) s
  LEFT JOIN (SELECT is_tram, daytype, hr, sched_b, avg(actual_s) AS p0 FROM {s} q GROUP BY 1, 2, 3, 4) b USING (is_tram, daytype, hr, sched_b) LEFT JOIN (SELECT is_tram, avg(actual_s) AS fb FROM {s} q GROUP BY 1) f USING (is_tram)
  LEFT JOIN ({_level1(s)}) x1 USING (grp, daytype, hr) LEFT JOIN ({_level2(s)}) x2 USING (seg) LEFT JOIN ({_level3(s)}) x3 USING (seg, daytype, hr)"""


def _rest(s: str) -> str:
    return f"SELECT r.*, actual_s - avg(actual_s) OVER (PARTITION BY is_tram, daytype, hr, sched_b) AS d0 FROM {s} r"


def _level1(s: str) -> str:
    return f"SELECT grp, daytype, hr, sum(d0) / (count(*) + 20) AS adj1, count(*) AS n1 FROM ({_rest(s)}) a GROUP BY 1, 2, 3"


def _rest1(s: str) -> str:
    return f"SELECT a.*, d0 - sum(d0) OVER (PARTITION BY grp, daytype, hr) / (count(*) OVER (PARTITION BY grp, daytype, hr) + 20) AS d1 FROM ({_rest(s)}) a"


def _level2(s: str) -> str:
    return f"SELECT seg, sum(d1) / (count(*) + 20) AS adj2, count(*) AS n2 FROM ({_rest1(s)}) b GROUP BY 1"


def _level3(s: str) -> str:
    return f"SELECT seg, daytype, hr, sum(d2) / (count(*) + 20) AS adj3, count(*) AS n3 FROM (SELECT b.*, d1 - sum(d1) OVER (PARTITION BY seg) / (count(*) OVER (PARTITION BY seg) + 20) AS d2 FROM ({_rest1(s)}) b) c GROUP BY 1, 2, 3"


def _eps(pm: float) -> str:
    return f"quantile_cont(CASE WHEN NOT is_last THEN delay END, {pm / 1000})"


_ES = ", ".join(f"{_eps(pm)} AS e{i}" for i, pm in enumerate((1, 2, 3, 5, 7, 10, 15, 20)))
_DQ = "quantile_cont(delay, 0.1) AS dq10, quantile_cont(delay, 0.5) AS dq50, quantile_cont(delay, 0.9) AS dq90"


def _slots(source: str) -> str:
    return f"""SELECT 'line_stop_hour' AS level, line, direction_id, stop_id, daytype, hr, NULL::INT AS hb, NULL::BOOLEAN AS is_tram, NULL::BOOLEAN AS is_origin, NULL::INT AS rel_b, count(*) AS n, {_DQ}, {_ES} FROM {source} GROUP BY line, direction_id, stop_id, daytype, hr HAVING count(*) >= 150
  UNION ALL SELECT 'line_stop_band', line, direction_id, stop_id, daytype, NULL, hb, NULL, NULL, NULL, count(*), {_DQ}, {_ES} FROM {source} GROUP BY line, direction_id, stop_id, daytype, hb HAVING count(*) >= 150
  UNION ALL SELECT 'line_stop', line, direction_id, stop_id, NULL, NULL, NULL, NULL, NULL, NULL, count(*), {_DQ}, {_ES} FROM {source} GROUP BY line, direction_id, stop_id HAVING count(*) >= 150
  UNION ALL SELECT 'generic', NULL, NULL, NULL, daytype, NULL, hb, is_tram, is_origin, rel_b, count(*), {_DQ}, {_ES} FROM {source} GROUP BY is_tram, is_origin, rel_b, daytype, hb"""


def _picked(c: str) -> str:
    return f"coalesce(s0.{c}, s1.{c}, s2.{c}, s3.{c})"


_SLOT_JOINS = """LEFT JOIN o_fit s0 ON s0.level = 'line_stop_hour' AND s0.line = c.line AND s0.direction_id = c.direction_id AND s0.stop_id = c.stop_id AND s0.daytype = c.daytype AND s0.hr = c.hr LEFT JOIN o_fit s1 ON s1.level = 'line_stop_band' AND s1.line = c.line AND s1.direction_id = c.direction_id AND s1.stop_id = c.stop_id AND s1.daytype = c.daytype AND s1.hb = c.hb
  LEFT JOIN o_fit s2 ON s2.level = 'line_stop' AND s2.line = c.line AND s2.direction_id = c.direction_id AND s2.stop_id = c.stop_id LEFT JOIN o_fit s3 ON s3.level = 'generic' AND s3.is_tram = c.is_tram AND s3.is_origin = c.is_origin AND s3.rel_b = c.rel_b AND s3.daytype = c.daytype AND s3.hb = c.hb"""
PARTS |= {
    "o_pred": _lookup("o_feat"),
    "o_keyed": f"""SELECT service_date, trip_id, vehicle_number, stop_sequence, line, direction_id, stop_id, is_tram, delay_seconds AS delay, sod, (sod // 3600)::INT AS hr, {_HB.format('(sod // 3600)')} AS hb, CASE WHEN is_holiday OR isodow(service_date) = 7 THEN 2 WHEN isodow(service_date) = 6 THEN 1 ELSE 0 END AS daytype, stop_sequence = lo AS is_origin, stop_sequence = hi AS is_last, CASE WHEN hi = lo THEN 0 ELSE least(9, floor(10 * (stop_sequence - lo) / (hi - lo)::DOUBLE))::INT END AS rel_b
  FROM (SELECT *, mode = 'tram' AS is_tram, scheduled_arrival_s - {start_of('service_date')} AS sod, min(stop_sequence) OVER (PARTITION BY service_date, trip_id, vehicle_number) AS lo, max(stop_sequence) OVER (PARTITION BY service_date, trip_id, vehicle_number) AS hi FROM o_arrival WHERE trip_quality = 'complete') x""",
    "o_fit": _slots(f"(SELECT * FROM o_keyed WHERE service_date < DATE '{SPLIT}')"),
    "o_run": f"""SELECT service_date, trip_id, vehicle_number, run, is_tram, sum(actual_s) AS actual, sum(pred) AS pred, ((arg_min(a_sched_sod, b_seq) // 3600) % 24)::INT AS hour, isodow(service_date) <= 5 AS weekday FROM (SELECT *, b_seq - row_number() OVER (PARTITION BY service_date, trip_id, vehicle_number ORDER BY b_seq) AS run FROM o_pred) x GROUP BY 1, 2, 3, 4, 5""",
    "o_change": f"""SELECT *, CASE WHEN isodow(service_date) > 5 THEN 'weekend' ELSE 'weekday' END AS period, CASE WHEN coalesce({local('s')}::DATE = {local('p_s')}::DATE AND hour({local('s')}) BETWEEN 6 AND 21 AND hour({local('p_s')}) BETWEEN 6 AND 21, false) THEN 'daytime' ELSE 'outside' END AS time_window, coalesce(is_observed AND p_obs AND delay_seconds IS NOT NULL AND p_delay IS NOT NULL, false) AS ends_ok, coalesce(t >= p_t AND s >= p_s, false) AS time_ok, coalesce(abs((delay_seconds - p_delay) - ((t - p_t) - (s - p_s))) <= 1, false) AS delta_ok
  FROM (SELECT e.*, a.scheduled_arrival_s AS s, a.actual_arrival_s AS t, lag(e.stop_id) OVER w AS p_stop, lag(e.stop_sequence) OVER w AS p_seq, lag(e.is_observed) OVER w AS p_obs, lag(e.delay_seconds) OVER w AS p_delay, lag(a.scheduled_arrival_s) OVER w AS p_s, lag(a.actual_arrival_s) OVER w AS p_t FROM o_event e LEFT JOIN o_arrival a ON a.gtfs_snapshot_id = e.gtfs_snapshot_id AND a.service_date = e.service_date AND a.trip_id = e.trip_id AND a.vehicle_number = e.vehicle_number AND a.stop_sequence = e.stop_sequence
    WHERE e.trip_quality = 'complete' AND e.mode IN ('bus', 'tram') WINDOW w AS (PARTITION BY e.gtfs_snapshot_id, e.service_date, e.trip_id, e.vehicle_number ORDER BY e.stop_sequence)) x WHERE p_seq IS NOT NULL""",
    "o_segstat": """SELECT period, time_window, gtfs_snapshot_id, line, mode, direction_id, p_stop AS from_stop_id, stop_id AS to_stop_id, p_seq AS from_stop_sequence, stop_sequence AS to_stop_sequence, count(*) AS observation_count, count(DISTINCT service_date) AS observed_days, sum(delay_seconds - p_delay)::BIGINT AS sum_delta_seconds, sum(greatest(delay_seconds - p_delay, 0))::BIGINT AS sum_gain_seconds, sum(greatest(p_delay - delay_seconds, 0))::BIGINT AS sum_recovery_seconds,
  count(*) FILTER (delay_seconds > p_delay) AS gain_count, count(*) FILTER (delay_seconds < p_delay) AS recovery_count, count(*) FILTER (delay_seconds = p_delay) AS unchanged_count, avg(p_delay) AS mean_from_delay_seconds, avg(delay_seconds) AS mean_to_delay_seconds FROM o_change WHERE ends_ok AND time_ok AND delta_ok GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9, 10""",
}


def feature_table(spark, d):
    return published(spark, d, "segment_features", lambda: T.features(T.segments(arrival_table(spark, d), S.stops(_f(spark, d)))))


@query("SELECT * FROM o_seg")
def observed_segments(spark, d):
    return T.segments(arrival_table(spark, d), S.stops(_f(spark, d)))


@query("SELECT service_date, trip_id, vehicle_number, b_seq, seg, grp, daytype, hr, hb, sched_b, is_tram, fold FROM o_feat")
def segment_features(spark, d):
    return feature_table(spark, d).select("service_date", "trip_id", "vehicle_number", "b_seq", "seg", "grp", "daytype", "hr", "hb", "sched_b", "is_tram", "fold")


@query(f"""SELECT trip_id, a_stop, stop_id AS b_stop, stop_sequence AS b_seq, arrival_s - a_s AS sched_s FROM (SELECT trip_id, stop_id, stop_sequence, arrival_s, lag(stop_id) OVER w AS a_stop, lag(arrival_s) OVER w AS a_s FROM o_times WHERE gtfs_snapshot_id = '{ONE}' WINDOW w AS (PARTITION BY trip_id ORDER BY stop_sequence)) x WHERE a_stop IS NOT NULL""")
def scheduled_segments(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("trip_id").orderBy("stop_sequence")
    t = S.of_snapshots(S.stop_times(_f(spark, d)), [ONE]).withColumn("a", F.lag(F.struct("stop_id", "arrival_s")).over(w)).where("a IS NOT NULL")
    return t.select("trip_id", F.col("a.stop_id").alias("a_stop"), F.col("stop_id").alias("b_stop"), F.col("stop_sequence").alias("b_seq"), (F.col("arrival_s") - F.col("a.arrival_s")).alias("sched_s"))


@query("SELECT seg, hb, service_date, sum(actual_s)::DOUBLE AS s, count(*) AS n FROM o_feat GROUP BY 1, 2, 3")
def recent_daily(spark, d):
    return feature_table(spark, d).groupBy("seg", "hb", "service_date").agg(F.sum("actual_s").cast("double").alias("s"), F.count(F.lit(1)).alias("n"))


@query("""SELECT r.service_date, r.trip_id, r.vehicle_number, r.b_seq, round(a.m - l.m, 6) AS shift_seg, round(b.m - k.m, 6) AS shift_seghb, coalesce(a.n, 0)::BIGINT AS recent_n_seg, coalesce(b.n, 0)::BIGINT AS recent_n_seghb FROM o_feat r
  LEFT JOIN (SELECT e.d, f.seg, avg(f.actual_s) AS m, count(*) AS n FROM (SELECT DISTINCT service_date - 5 AS d FROM o_feat) e JOIN o_feat f ON f.service_date > e.d - 7 AND f.service_date <= e.d GROUP BY 1, 2) a ON a.d = r.service_date - 5 AND a.seg = r.seg
  LEFT JOIN (SELECT e.d, f.seg, f.hb, avg(f.actual_s) AS m, count(*) AS n FROM (SELECT DISTINCT service_date - 5 AS d FROM o_feat) e JOIN o_feat f ON f.service_date > e.d - 7 AND f.service_date <= e.d GROUP BY 1, 2, 3) b ON b.d = r.service_date - 5 AND b.seg = r.seg AND b.hb = r.hb
  LEFT JOIN (SELECT seg, avg(actual_s) AS m FROM o_feat GROUP BY 1) l ON l.seg = r.seg LEFT JOIN (SELECT seg, hb, avg(actual_s) AS m FROM o_feat GROUP BY 1, 2) k ON k.seg = r.seg AND k.hb = r.hb""")
def recent_conditions(spark, d):
    r = T.recent(feature_table(spark, d))
    return r.select("service_date", "trip_id", "vehicle_number", "b_seq", F.round("shift_seg", 6).alias("shift_seg"), F.round("shift_seghb", 6).alias("shift_seghb"), "recent_n_seg", "recent_n_seghb")


@query("SELECT service_date, trip_id, vehicle_number, b_seq, round(pred, 6) AS pred, n1, n2, n3 FROM o_pred")
def segment_lookup(spark, d):
    f = feature_table(spark, d)
    return T.apply(f, T.fit(f)).select("service_date", "trip_id", "vehicle_number", "b_seq", F.round("pred", 6).alias("pred"), "n1", "n2", "n3")


@query("SELECT fold, count(*) AS n, count(pred) AS predicted, round(avg(abs(pred - actual_s)), 6) AS mae, round(avg(abs(sched_s - actual_s)), 6) AS timetable_mae FROM (" + " UNION ALL ".join(_lookup("o_feat", f"fold <> {k}", f"fold = {k}") for k in range(4)) + ") x GROUP BY 1")
def out_of_fold_error(spark, d):
    """Held-out error of the lookup by fold, beside that of the timetable."""
    f = T.out_of_fold(feature_table(spark, d))
    mae = lambda c: F.round(F.avg(F.abs(F.col(c) - F.col("actual_s"))), 6)
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.count("pred").alias("predicted"), mae("pred").alias("mae"), mae("sched_s").alias("timetable_mae"))


@query("SELECT service_date, trip_id, vehicle_number, count(*) AS n FROM o_seg WHERE ('0x' || substr(md5(concat_ws('|', service_date::VARCHAR, trip_id, vehicle_number)), 1, 15))::BIGINT % 1000 < 250 GROUP BY 1, 2, 3")
def sampled_trips(spark, d):
    return T.sampled(feature_table(spark, d), 250).groupBy("service_date", "trip_id", "vehicle_number").agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT g.is_tram, g.weekday, g.hour, g.min_ride_s, round(coalesce(h.lo, b.lo, m.lo, 0.85), 6) AS low_ratio, round(coalesce(h.hi, b.hi, m.hi, 1.15), 6) AS high_ratio
  FROM (SELECT *, {_BAND.format('hour', 'weekday')} AS band FROM (SELECT unnest([true, false]) AS is_tram) a CROSS JOIN (SELECT unnest([true, false]) AS weekday) w CROSS JOIN (SELECT unnest(range(24))::INT AS hour) h CROSS JOIN (SELECT unnest([-1.0, 180, 360, 600, 900, 1500, 2400, 3600])::DOUBLE AS min_ride_s) e) g
  LEFT JOIN (SELECT is_tram, weekday, hour, edge, quantile_cont(r, 0.1) AS lo, quantile_cont(r, 0.9) AS hi FROM o_ratio GROUP BY 1, 2, 3, 4 HAVING count(*) >= 150) h ON h.is_tram = g.is_tram AND h.weekday = g.weekday AND h.hour = g.hour AND h.edge = g.min_ride_s
  LEFT JOIN (SELECT is_tram, band, edge, quantile_cont(r, 0.1) AS lo, quantile_cont(r, 0.9) AS hi FROM o_ratio GROUP BY 1, 2, 3) b ON b.is_tram = g.is_tram AND b.band = g.band AND b.edge = g.min_ride_s LEFT JOIN (SELECT is_tram, edge, quantile_cont(r, 0.1) AS lo, quantile_cont(r, 0.9) AS hi FROM o_ratio GROUP BY 1, 2) m ON m.is_tram = g.is_tram AND m.edge = g.min_ride_s""".replace("o_ratio", f"(SELECT *, actual / pred AS r, {_BAND.format('hour', 'weekday')} AS band, CASE WHEN pred <= 180 THEN -1 WHEN pred <= 360 THEN 180 WHEN pred <= 600 THEN 360 WHEN pred <= 900 THEN 600 WHEN pred <= 1500 THEN 900 WHEN pred <= 2400 THEN 1500 WHEN pred <= 3600 THEN 2400 ELSE 3600 END::DOUBLE AS edge FROM o_run WHERE pred > 0) o"))
def ride_ranges(spark, d):
    f = feature_table(spark, d)
    r = T.ride_ranges(T.runs(T.apply(f, T.fit(f))))
    return r.withColumns({"low_ratio": F.round("low_ratio", 6), "high_ratio": F.round("high_ratio", 6)})


def keyed_table(spark, d):
    return published(spark, d, "keyed_arrivals", lambda: T.keyed_arrivals(arrival_table(spark, d)))


def _fitted(spark, d):
    return published(spark, d, "stop_slots", lambda: T.stop_slots(keyed_table(spark, d).where(F.col("service_date") < SPLIT)))


@query(_slots("o_keyed"))
def stop_slots(spark, d):
    return T.stop_slots(keyed_table(spark, d))


_MISS = ", ".join(f"avg(CASE WHEN delay < least(e{i} + 30, 0) - 30 THEN 1 ELSE 0 END) AS m{i}" for i in range(8))
_PICK = " ".join(f"WHEN m{i} <= 0.01 THEN {i}" for i in reversed(range(8)))


@query(f"""SELECT is_tram, band, CASE {_PICK} ELSE 0 END AS eps_index FROM (SELECT is_tram, band, {_MISS} FROM (SELECT c.is_tram, c.delay, {_BAND.format('c.hr', 'isodow(c.service_date) <= 5')} AS band, {', '.join(f'{_picked(f"e{i}")} AS e{i}' for i in range(8))} FROM o_keyed c {_SLOT_JOINS} WHERE c.service_date >= DATE '{SPLIT}' AND NOT c.is_last) x GROUP BY 1, 2) y""")
def stop_margins(spark, d):
    return T.stop_eps(keyed_table(spark, d).where(F.col("service_date") >= SPLIT), _fitted(spark, d))


PARTS["o_usual"] = f"SELECT * FROM (SELECT c.*, c.delay - {_picked('dq50')} AS x FROM o_keyed c {_SLOT_JOINS} WHERE c.service_date >= DATE '{SPLIT}') q WHERE x IS NOT NULL"
PARTS["o_pairs"] = "SELECT i.is_tram, CASE WHEN j.sod - i.sod <= 300 THEN 5 WHEN j.sod - i.sod <= 600 THEN 10 WHEN j.sod - i.sod <= 1200 THEN 20 WHEN j.sod - i.sod <= 1800 THEN 30 WHEN j.sod - i.sod <= 2700 THEN 45 WHEN j.sod - i.sod <= 3600 THEN 60 ELSE 90 END AS horizon_min, i.x, j.x AS y FROM o_usual i JOIN o_usual j ON j.service_date = i.service_date AND j.trip_id = i.trip_id AND j.vehicle_number = i.vehicle_number AND j.stop_sequence > i.stop_sequence WHERE j.sod - i.sod BETWEEN 1 AND 5400"
PARTS["o_resid"] = "SELECT p.is_tram, p.horizon_min, s.alpha, CASE WHEN x >= 600 THEN 600 WHEN x >= 300 THEN 300 WHEN x >= 120 THEN 120 WHEN x >= -120 THEN -120 ELSE -86400 END AS excess_s, y - alpha * x AS r FROM o_pairs p JOIN (SELECT is_tram, horizon_min, covar_pop(x, y) / nullif(var_pop(x), 0) AS alpha FROM o_pairs GROUP BY 1, 2) s ON s.is_tram = p.is_tram AND s.horizon_min = p.horizon_min WHERE alpha IS NOT NULL"


@query("""SELECT p.is_tram, p.horizon_min, e.excess_s, coalesce(b.n, 0) AS n, round(p.alpha, 6) AS alpha, round(CASE WHEN b.n >= 1000 THEN b.lo ELSE p.lo END, 4) AS low_s, round(CASE WHEN b.n >= 1000 THEN b.mid ELSE p.mid END, 4) AS mid_s, round(CASE WHEN b.n >= 1000 THEN b.hi ELSE p.hi END, 4) AS high_s FROM (SELECT is_tram, horizon_min, min(alpha) AS alpha, quantile_cont(r, 0.1) AS lo, quantile_cont(r, 0.5) AS mid, quantile_cont(r, 0.9) AS hi FROM o_resid GROUP BY 1, 2) p
  CROSS JOIN (SELECT unnest([-86400, -120, 120, 300, 600]) AS excess_s) e LEFT JOIN (SELECT is_tram, horizon_min, excess_s, count(*) AS n, quantile_cont(r, 0.1) AS lo, quantile_cont(r, 0.5) AS mid, quantile_cont(r, 0.9) AS hi FROM o_resid GROUP BY 1, 2, 3) b ON b.is_tram = p.is_tram AND b.horizon_min = p.horizon_min AND b.excess_s = e.excess_s""")
def live_persistence_minutes(spark, d):
    return T.persistence(keyed_table(spark, d).where(F.col("service_date") >= SPLIT), _fitted(spark, d))


@query("""SELECT mode = 'tram' AS is_tram, count(*) AS n, quantile_cont(turn, 0.1) AS low_s, quantile_cont(turn, 0.5) AS mid_s, quantile_cont(turn, 0.9) AS high_s FROM (SELECT mode, b_start - scheduled_end_s AS layover, end_delay_seconds, b_delay + b_start - scheduled_end_s - end_delay_seconds AS turn FROM (SELECT *, lead(scheduled_start_s) OVER w AS b_start, lead(start_delay_seconds) OVER w AS b_delay FROM o_trip WHERE trip_quality IN ('complete', 'partial') AND mode IN ('bus', 'tram') WINDOW w AS (PARTITION BY service_date, vehicle_number ORDER BY scheduled_start_s, trip_id)) x) y WHERE layover BETWEEN 0 AND 3600 AND layover - end_delay_seconds < 120 GROUP BY 1""")
def live_turnaround(spark, d):
    return T.turnaround(trip_table(spark, d))


@query(f"""SELECT service_date, trip_id, vehicle_number, stop_sequence, usual, leave_by, ride, floor(max(coalesce(mean + ride, sod + usual)) OVER (PARTITION BY service_date, trip_id, vehicle_number ORDER BY stop_sequence ROWS UNBOUNDED PRECEDING) + 0.5)::BIGINT AS expected_sod FROM (SELECT *, avg(CASE WHEN leave_by IS NOT NULL THEN sod + greatest(usual, leave_by) - ride END) OVER (PARTITION BY service_date, trip_id, vehicle_number ORDER BY stop_sequence ROWS UNBOUNDED PRECEDING) AS mean
  FROM (SELECT c.*, round({_picked('dq50')}) AS usual, CASE WHEN NOT c.is_last THEN floor(round(least({_picked('e3')} + 30, 0), 6))::BIGINT END AS leave_by, c.sod - first_value(c.sod) OVER (PARTITION BY c.service_date, c.trip_id, c.vehicle_number ORDER BY c.stop_sequence) AS ride FROM o_keyed c {_SLOT_JOINS}) x) y""")
def expected_stop_times(spark, d):
    return T.expected_times(keyed_table(spark, d), _fitted(spark, d))


@query(f"""SELECT a.stop_id AS from_stop_id, b.stop_id AS to_stop_id, round(1.3 * m)::INT AS distance_m, (greatest(30, ceil(1.3 * m / 1.2)) + CASE WHEN a.stop_id LIKE '%:A' OR b.stop_id LIKE '%:A' THEN 60 ELSE 0 END)::INT AS walk_s FROM o_stops a JOIN o_stops b ON a.gtfs_snapshot_id = b.gtfs_snapshot_id AND a.stop_id <> b.stop_id CROSS JOIN LATERAL (SELECT {_METRES.format('a.stop_lat', 'a.stop_lon', 'b.stop_lat', 'b.stop_lon')} AS m) x WHERE a.gtfs_snapshot_id = '{ONE}' AND m <= 700 / 1.3::DOUBLE""")
def footpaths(spark, d):
    p = S.stops(_f(spark, d)).where(F.col(S.SNAP) == ONE).select(F.col("stop_id").alias("id"), F.col("stop_lat").alias("lat"), F.col("stop_lon").alias("lon"), F.col("stop_id").endswith(":A").alias("station"))
    return T.footpaths(p)


def _changes(spark, d):
    return T.segment_changes(event_table(spark, d), arrival_table(spark, d))


@query("SELECT * FROM o_segstat")
def segment_delay_changes(spark, d):
    return T.segment_statistics(_changes(spark, d))


@query("SELECT service_date, period, count(*) AS candidate_pairs, count(*) FILTER (ends_ok AND time_ok AND delta_ok) AS usable_pairs, count(*) FILTER (NOT ends_ok) AS missing_endpoint_count, count(*) FILTER (NOT time_ok) AS invalid_time_count, count(*) FILTER (NOT delta_ok) AS inconsistent_delta_count, count(*) FILTER (time_window = 'daytime' AND ends_ok AND time_ok AND delta_ok) AS daytime_usable_pairs FROM o_change GROUP BY 1, 2")
def segment_pair_coverage(spark, d):
    return T.pair_coverage(_changes(spark, d))


@query("SELECT period, mode, from_stop_id, to_stop_id, sum(observation_count)::BIGINT AS observations, count(*) AS parts, sum(sum_delta_seconds) / sum(observation_count)::DOUBLE AS mean_change, sum(mean_to_delay_seconds * observation_count) / sum(observation_count) AS mean_to_delay, max(observed_days) AS lower_days, sum(observed_days)::BIGINT AS upper_days FROM o_segstat GROUP BY 1, 2, 3, 4")
def pooled_segments(spark, d):
    return T.pooled(T.segment_statistics(_changes(spark, d)))

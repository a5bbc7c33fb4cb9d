"""Registered transit queries over the driver's tables, and the same in DuckDB's SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tramline.functions import columns as C
from tramline.operators import relational as R
from tramline.registry import ORACLES, QUERIES, query  # noqa: F401
from tramline.sources.tables import arrivals, calls, pings, table
from tramline.streaming import health

_ARR = "a AS (SELECT event_id, ts, user_id % 20 AS line, event_type AS stop, CASE WHEN user_id % 2 = 0 THEN 'bus' ELSE 'tram' END AS mode, user_id AS vehicle, ts::DATE AS service_date, hour(ts) AS hour, CASE WHEN event_id % 50 <> 7 THEN round(value * 6 - 150)::INT END AS delay FROM events)"
_PING = "p AS (SELECT event_id, user_id AS vehicle, CASE WHEN user_id % 2 = 0 THEN 'bus' ELSE 'tram' END AS mode, ts AS gps_time, ts + to_seconds(event_id) AS ingested_at, 52.0 + value / 1000 AS lat, 21.0 + value / 2000 AS lon FROM events)"
_CALL = "c AS (SELECT trip, seq, stop, ride, actual FROM (SELECT l_orderkey AS trip, l_linenumber AS seq, l_suppkey AS stop, l_quantity AS ride, l_shipdate AS actual, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_suppkey, l_partkey, l_extendedprice, l_discount, l_tax, l_quantity, l_shipdate) AS n FROM lineitem) WHERE n = 1)"
_BLOCK = "count(*) AS arrivals, avg(delay) AS mean_delay, quantile_cont(delay, 0.5) AS median_delay, quantile_cont(delay, 0.9) AS p90_delay, count(*) FILTER (delay <= -60) AS early_count, count(*) FILTER (delay > -60 AND delay < 180) AS on_time_count, count(*) FILTER (delay >= 180) AS late_count, count(*) FILTER (delay <= -60) / count(*)::DOUBLE AS early_rate, count(*) FILTER (delay > -60 AND delay < 180) / count(*)::DOUBLE AS on_time_rate, count(*) FILTER (delay >= 180) / count(*)::DOUBLE AS late_rate"


@query(f"WITH {_ARR} SELECT service_date, mode, {_BLOCK} FROM a GROUP BY 1, 2")
def delay_summary_daily(spark, d):
    return arrivals(spark, d).groupBy("service_date", "mode").agg(*C.delay_block(F.col("delay")))



@query(f"WITH {_ARR} SELECT mode, bucket_label, n FROM (SELECT mode, unnest(['early_over_5m', 'early_2_to_5m', 'early_1_to_2m', 'on_time_early_30_60s', 'on_time_early_0_30s', 'on_time_late_0_30s', 'on_time_late_30_60s', 'on_time_late_1_to_3m', 'late_3_to_5m', 'late_5_to_10m', 'late_10_to_20m', 'late_over_20m']) AS bucket_label, unnest([count(*) FILTER (delay < -300), count(*) FILTER (delay BETWEEN -300 AND -121), count(*) FILTER (delay BETWEEN -120 AND -60), count(*) FILTER (delay BETWEEN -59 AND -31), count(*) FILTER (delay BETWEEN -30 AND -1), count(*) FILTER (delay BETWEEN 0 AND 30), count(*) FILTER (delay BETWEEN 31 AND 60), count(*) FILTER (delay BETWEEN 61 AND 179), count(*) FILTER (delay BETWEEN 180 AND 300), count(*) FILTER (delay BETWEEN 301 AND 600), count(*) FILTER (delay BETWEEN 601 AND 1200), count(*) FILTER (delay > 1200)]) AS n FROM a GROUP BY 1)")
def delay_histogram(spark, d):
    return arrivals(spark, d).groupBy("mode").agg(C.delay_histogram(F.col("delay")).alias("h")).select("mode", F.inline("h")).select("mode", "bucket_label", "n")


@query(f"WITH {_PING} SELECT vehicle, bucket, event_id FROM (SELECT vehicle, floor(epoch(gps_time))::BIGINT // 36000 AS bucket, event_id, row_number() OVER (PARTITION BY vehicle, floor(epoch(gps_time))::BIGINT // 36000 ORDER BY ingested_at DESC, event_id DESC) AS n FROM p) WHERE n = 1")
def latest_ping_dedup(spark, d):
    bucket = F.floor(F.unix_seconds(F.col("gps_time").cast("timestamp")) / 36000).cast("long")
    return R.latest(pings(spark, d).withColumn("bucket", bucket), ["vehicle", "bucket"], [F.desc("ingested_at"), F.desc("event_id")]).select("vehicle", "bucket", "event_id")


@query(f"WITH {_PING}, s AS (SELECT m.mode, h.hour FROM (SELECT DISTINCT mode FROM p) m, (SELECT unnest(range(min(date_trunc('hour', gps_time)), max(date_trunc('hour', gps_time)) + INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour FROM p) h), g AS (SELECT mode, date_trunc('hour', gps_time) AS hour, count(*) AS rows_n, count(DISTINCT vehicle) AS vehicles, count(DISTINCT floor(epoch(gps_time))::BIGINT // 10) AS buckets FROM p GROUP BY 1, 2) SELECT s.mode, s.hour, coalesce(rows_n, 0) AS rows_n, coalesce(vehicles, 0) AS vehicles, coalesce(buckets, 0) AS buckets FROM s LEFT JOIN g ON s.mode = g.mode AND s.hour = g.hour")
def hourly_completeness(spark, d):
    p = pings(spark, d).withColumn("at", F.col("gps_time").cast("timestamp")).withColumn("hour", F.date_trunc("hour", "at"))
    ends = p.agg(F.min("hour").alias("lo"), F.max("hour").alias("hi"))
    spine = p.select("mode").distinct().join(F.broadcast(ends.select(F.explode(F.expr("sequence(lo, hi, interval 1 hour)")).alias("hour"))), how="cross")
    per = p.groupBy("mode", "hour").agg(F.count(F.lit(1)).alias("rows_n"), F.countDistinct("vehicle").alias("vehicles"), F.countDistinct(F.floor(F.unix_seconds("at") / 10)).alias("buckets"))
    return R.dense(per, spine, ["mode", "hour"], {"rows_n": 0, "vehicles": 0, "buckets": 0}).withColumn("hour", F.col("hour").cast("timestamp_ntz"))


@query(f"WITH {_PING}, g AS (SELECT *, floor(epoch(gps_time)) - floor(epoch(lag(gps_time) OVER (PARTITION BY vehicle ORDER BY gps_time, event_id))) AS gap FROM p) SELECT vehicle, count(*) AS pings_n, max(gap)::BIGINT AS max_gap_s FROM g GROUP BY 1")
def ping_gaps(spark, d):
    at = F.unix_seconds(F.col("gps_time").cast("timestamp"))
    gap = at - F.lag(at).over(Window.partitionBy("vehicle").orderBy("gps_time", "event_id"))
    return pings(spark, d).withColumn("gap", gap).groupBy("vehicle").agg(F.count(F.lit(1)).alias("pings_n"), F.max("gap").alias("max_gap_s"))


@query(f"WITH {_PING}, g AS (SELECT *, lead(gps_time) OVER w AS t2, lead(lat) OVER w AS lat2, lead(lon) OVER w AS lon2 FROM p WINDOW w AS (PARTITION BY vehicle ORDER BY gps_time, event_id)), m AS (SELECT vehicle, event_id, (floor(epoch(t2)) - floor(epoch(gps_time)))::BIGINT AS seconds, 2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin((radians(lat2) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(lat2)) * pow(sin((radians(lon2) - radians(lon)) / 2), 2)))) AS metres FROM g WHERE t2 IS NOT NULL) SELECT vehicle, event_id, seconds, round(metres, 3) AS metres FROM m WHERE seconds BETWEEN 1 AND 36000 AND metres / seconds <= 50")
def gps_segments(spark, d):
    w = Window.partitionBy("vehicle").orderBy("gps_time", "event_id")
    at = F.unix_seconds(F.col("gps_time").cast("timestamp"))
    p = pings(spark, d).select("vehicle", "event_id", (F.lead(at).over(w) - at).alias("seconds"), C.haversine(F.col("lat"), F.col("lon"), F.lead("lat").over(w), F.lead("lon").over(w)).alias("metres"))
    return p.where("seconds BETWEEN 1 AND 36000 AND metres / seconds <= 50").withColumn("metres", F.round("metres", 3))


@query(f"WITH {_ARR}, s AS (SELECT *, CASE WHEN lag(stop) OVER w IS DISTINCT FROM stop OR floor(epoch(ts)) - floor(epoch(lag(ts) OVER w)) > 86400 THEN 1 ELSE 0 END AS f FROM a WINDOW w AS (PARTITION BY vehicle ORDER BY ts, event_id)), i AS (SELECT *, sum(f) OVER (PARTITION BY vehicle ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM s) SELECT vehicle, island::BIGINT AS island, min(stop) AS state, count(*) AS n, min(ts) AS started, max(ts) AS ended FROM i GROUP BY 1, 2")
def state_episodes(spark, d):
    w = Window.partitionBy("vehicle").orderBy("ts", "event_id")
    at = F.unix_seconds(F.col("ts").cast("timestamp"))
    a = arrivals(spark, d).withColumn("was", F.lag("stop").over(w)).withColumn("gap", at - F.lag(at).over(w))
    runs = R.islands(a, ["vehicle"], ["ts", "event_id"], ~F.col("was").eqNullSafe(F.col("stop")) | (F.col("gap") > 86400))
    return runs.groupBy("vehicle", "island").agg(F.min("stop").alias("state"), F.count(F.lit(1)).alias("n"), F.min("ts").alias("started"), F.max("ts").alias("ended"))


@query(f"WITH {_ARR}, f AS (SELECT 'mode' AS entity_type, mode AS entity_id, delay FROM a UNION ALL SELECT 'line', line::VARCHAR, delay FROM a UNION ALL SELECT 'stop', stop, delay FROM a UNION ALL SELECT 'vehicle', vehicle::VARCHAR, delay FROM a) SELECT entity_type, entity_id, {_BLOCK} FROM f GROUP BY 1, 2")
def entity_fan_out(spark, d):
    a = R.fan_out(arrivals(spark, d), {"mode": F.col("mode"), "line": F.col("line"), "stop": F.col("stop"), "vehicle": F.col("vehicle")})
    return a.groupBy("entity_type", "entity_id").agg(*C.delay_block(F.col("delay")))



@query(f"WITH {_ARR}, o AS (SELECT DISTINCT service_date FROM a) SELECT service_date, lag(service_date) OVER (ORDER BY service_date) AS previous, lead(service_date) OVER (ORDER BY service_date) AS next, row_number() OVER (ORDER BY service_date DESC) AS recency FROM o")
def serving_dates(spark, d):
    o, w = arrivals(spark, d).select("service_date").distinct(), Window.orderBy("service_date")
    return o.select("service_date", F.lag("service_date").over(w).alias("previous"), F.lead("service_date").over(w).alias("next"), F.row_number().over(Window.orderBy(F.desc("service_date"))).alias("recency"))


@query(f"WITH {_ARR}, g AS (SELECT mode, hour, quantile_cont(delay, 0.5) AS median_delay, count(*) AS n FROM a GROUP BY 1, 2), s AS (SELECT m.mode, h.hour FROM (SELECT DISTINCT mode FROM a) m, (SELECT unnest(range(24)) AS hour) h) SELECT s.mode, s.hour::INT AS hour, (s.hour + 20) % 24 AS service_hour, coalesce(n, 0) AS n, CASE WHEN n >= 3 THEN median_delay END AS median_delay FROM s LEFT JOIN g ON s.mode = g.mode AND s.hour = g.hour")
def hour_window(spark, d):
    a = arrivals(spark, d)
    per = a.groupBy("mode", "hour").agg(F.percentile("delay", 0.5).alias("median_delay"), F.count(F.lit(1)).alias("n"))
    spine = a.select("mode").distinct().select("mode", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"))
    out = R.dense(per, spine, ["mode", "hour"], {"n": 0})
    return out.select("mode", "hour", ((F.col("hour") + 20) % 24).alias("service_hour"), "n", F.when(F.col("n") >= 3, F.col("median_delay")).alias("median_delay"))



@query("SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, o_orderdate DESC, o_orderkey) AS n FROM orders) WHERE n = 1")
def best_execution(spark, d):
    rank = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return R.latest(table(spark, d, "orders"), ["o_custkey"], [rank.asc(), F.desc("o_orderdate"), F.asc("o_orderkey")]).select("o_custkey", "o_orderkey", "o_orderstatus")


_SNAP = "s AS (SELECT c_nationkey, date_trunc('month', o_orderdate)::DATE AS month, CASE WHEN count(*) % 3 = 0 THEN 'x' ELSE 'y' END AS state FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"


def _snapshots(spark, d):
    j = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy("c_nationkey", F.trunc("o_orderdate", "month").alias("month")).agg(F.when(F.count(F.lit(1)) % 3 == 0, "x").otherwise("y").alias("state"))


@query(f"WITH {_SNAP}, l AS (SELECT *, CASE WHEN lag(state) OVER w IS DISTINCT FROM state THEN 1 ELSE 0 END AS f FROM s WINDOW w AS (PARTITION BY c_nationkey ORDER BY month)), i AS (SELECT *, sum(f) OVER (PARTITION BY c_nationkey ORDER BY month ROWS UNBOUNDED PRECEDING) AS island FROM l), v AS (SELECT c_nationkey, island, min(month) AS valid_from, min(state) AS state FROM i GROUP BY 1, 2) SELECT c_nationkey, state, valid_from, (lead(valid_from) OVER (PARTITION BY c_nationkey ORDER BY valid_from) - 1) AS valid_to FROM v")
def schedule_versions(spark, d):
    return R.versions(_snapshots(spark, d), ["c_nationkey"], "month", "state")


@query(f"WITH {_SNAP}, k AS (SELECT DISTINCT c_nationkey FROM s), m AS (SELECT DISTINCT month FROM s), g AS (SELECT k.c_nationkey, m.month, coalesce(s.state, '__missing__') AS state FROM k CROSS JOIN m LEFT JOIN (SELECT * FROM s WHERE state = 'x') s ON s.c_nationkey = k.c_nationkey AND s.month = m.month), l AS (SELECT *, CASE WHEN lag(state) OVER w IS DISTINCT FROM state THEN 1 ELSE 0 END AS f FROM g WINDOW w AS (PARTITION BY c_nationkey ORDER BY month)), i AS (SELECT *, sum(f) OVER (PARTITION BY c_nationkey ORDER BY month ROWS UNBOUNDED PRECEDING) AS island FROM l), v AS (SELECT c_nationkey, island, min(month) AS valid_from, min(state) AS state FROM i GROUP BY 1, 2), z AS (SELECT c_nationkey, state, valid_from, (lead(valid_from) OVER (PARTITION BY c_nationkey ORDER BY valid_from) - 1) AS valid_to FROM v) SELECT * FROM z WHERE state <> '__missing__'")
def scd2_with_absence(spark, d):
    s = _snapshots(spark, d)
    return R.scd2(s.where("state = 'x'"), s.select("month"), ["c_nationkey"], "month", "state")


@query(f"WITH {_SNAP} SELECT month, md5(string_agg(c_nationkey::VARCHAR || ':' || state, '|' ORDER BY c_nationkey)) AS fingerprint, count(*) AS entities FROM s GROUP BY 1")
def schedule_fingerprint(spark, d):
    listed = F.transform(F.array_sort(F.collect_list(F.struct("c_nationkey", "state"))), lambda x: F.concat_ws(":", x["c_nationkey"].cast("string"), x["state"]))
    return _snapshots(spark, d).groupBy("month").agg(F.md5(F.array_join(listed, "|")).alias("fingerprint"), F.count(F.lit(1)).alias("entities"))


@query("WITH q AS (SELECT o_orderkey, o_custkey, o_orderdate FROM orders), s AS (SELECT DISTINCT o_custkey % 50 AS k, date_trunc('quarter', o_orderdate) AS snap FROM orders WHERE o_orderstatus = 'P') SELECT o_orderkey, max(snap)::DATE AS snapshot FROM q LEFT JOIN s ON q.o_custkey % 50 = s.k AND s.snap <= q.o_orderdate GROUP BY 1")
def latest_snapshot_as_of(spark, d):
    """Snapshots are few: one sorted array for each key meets the rows, so that no window sorts them by date."""
    o = table(spark, d, "orders")
    snaps = o.where("o_orderstatus = 'P'").groupBy((F.col("o_custkey") % 50).alias("k")).agg(F.array_sort(F.collect_set(F.trunc("o_orderdate", "quarter"))).alias("snaps"))
    both = o.join(F.broadcast(snaps), F.col("o_custkey") % 50 == F.col("k"), "left")
    return both.select("o_orderkey", F.array_max(F.filter("snaps", lambda x: x <= F.col("o_orderdate"))).alias("snapshot"))


@query(f"WITH {_ARR}, g AS (SELECT line, service_date, avg(delay) AS m FROM a GROUP BY 1, 2) SELECT x.line, x.service_date, x.m - y.m AS change FROM g x JOIN g y ON x.line = y.line AND x.service_date = y.service_date + 1")
def day_over_day(spark, d):
    g = arrivals(spark, d).groupBy("line", "service_date").agg(F.avg("delay").alias("m"))
    y = g.select("line", F.date_add("service_date", 1).alias("service_date"), F.col("m").alias("was"))
    return g.join(y, ["line", "service_date"]).select("line", "service_date", (F.col("m") - F.col("was")).alias("change"))


@query(f"WITH {_ARR}, f AS (SELECT line, stop, hour, avg(delay) AS m FROM a GROUP BY 1, 2, 3 HAVING count(delay) >= 6), g AS (SELECT line, stop, avg(delay) AS m FROM a GROUP BY 1, 2 HAVING count(delay) >= 6), h AS (SELECT avg(delay) AS m FROM a) SELECT event_id, coalesce(f.m, g.m, h.m) AS expected, CASE WHEN f.m IS NOT NULL THEN 0 WHEN g.m IS NOT NULL THEN 1 ELSE 2 END AS level FROM a LEFT JOIN f USING (line, stop, hour) LEFT JOIN g USING (line, stop) CROSS JOIN h")
def hierarchical_fallback(spark, d):
    return R.fallback(arrivals(spark, d), "delay", [["line", "stop", "hour"], ["line", "stop"], []], 6, "expected").select("event_id", "expected", "level")


@query(f"WITH {_ARR}, b AS (SELECT line, avg(delay) AS base FROM a GROUP BY 1) SELECT line, stop, sum(delay - base) / (count(*) + 20) AS shrunk FROM a JOIN b USING (line) GROUP BY 1, 2")
def shrunken_residuals(spark, d):
    a = arrivals(spark, d)
    base = a.groupBy("line").agg(F.avg("delay").alias("base"))
    return a.join(base, "line").groupBy("line", "stop").agg((F.sum(F.col("delay") - F.col("base")) / (F.count(F.lit(1)) + 20)).alias("shrunk"))


@query(f"WITH {_ARR} SELECT line, round(covar_pop(delay, hour) / var_pop(hour), 6) AS slope, round(stddev_samp(delay), 6) AS spread FROM a GROUP BY 1")
def persistence_slope(spark, d):
    return arrivals(spark, d).groupBy("line").agg(F.round(F.covar_pop("delay", "hour") / F.var_pop("hour"), 6).alias("slope"), F.round(F.stddev_samp("delay"), 6).alias("spread"))


@query(f"WITH {_CALL}, s AS (SELECT trip, lag(seq) OVER w AS a_seq, seq AS b_seq, lag(stop) OVER w AS a_stop, stop AS b_stop, date_diff('day', lag(actual) OVER w, actual) AS days FROM c WINDOW w AS (PARTITION BY trip ORDER BY seq)) SELECT a_stop % 10 AS a_zone, b_stop % 10 AS b_zone, count(*) AS runs, avg(days) AS mean_days, count(*) FILTER (days > 0) AS gained, count(*) FILTER (days < 0) AS recovered FROM s WHERE b_seq = a_seq + 1 GROUP BY 1, 2")
def segment_statistics(spark, d):
    w = Window.partitionBy("trip").orderBy("seq")
    s = calls(spark, d).select(F.lag("seq").over(w).alias("a_seq"), F.col("seq").alias("b_seq"), F.lag("stop").over(w).alias("a"), F.col("stop").alias("b"), F.date_diff("actual", F.lag("actual").over(w)).alias("days")).where("b_seq = a_seq + 1")
    return s.groupBy((F.col("a") % 10).alias("a_zone"), (F.col("b") % 10).alias("b_zone")).agg(F.count(F.lit(1)).alias("runs"), F.avg("days").alias("mean_days"), F.count_if(F.col("days") > 0).alias("gained"), F.count_if(F.col("days") < 0).alias("recovered"))


@query(f"WITH {_CALL}, s AS (SELECT trip, abs(ride - lag(ride) OVER (PARTITION BY trip ORDER BY seq)) AS step FROM c) SELECT trip, coalesce(max(step), 0) AS erratic FROM s GROUP BY 1")
def erratic_score(spark, d):
    rides = F.transform(F.array_sort(F.collect_list(F.struct("seq", "ride"))), lambda x: x["ride"])
    per = calls(spark, d).groupBy("trip").agg(rides.alias("r"))
    steps = F.zip_with(F.slice("r", 1, F.size("r") - 1), F.slice("r", 2, F.greatest(F.size("r") - 1, F.lit(0))), lambda a, b: F.abs(b - a))
    return per.select("trip", F.coalesce(F.when(F.size("r") > 1, F.array_max(steps)), F.lit(0.0)).alias("erratic"))


_PAT = f"{_CALL}, p AS (SELECT trip, string_agg((stop % 3)::VARCHAR, '|' ORDER BY seq) AS pattern, count(*) AS stops FROM c GROUP BY 1)"


def _patterns(spark, d):
    listed = F.transform(F.array_sort(F.collect_list(F.struct("seq", "stop"))), lambda x: (x["stop"] % 3).cast("string"))
    return calls(spark, d).groupBy("trip").agg(F.array_join(listed, "|").alias("pattern"), F.count(F.lit(1)).alias("stops"))


@query(f"WITH {_PAT} SELECT sha256(pattern) AS pattern_id, stops, count(*) AS trips, min(trip) AS first_trip FROM p GROUP BY pattern, stops")
def route_patterns(spark, d):
    return _patterns(spark, d).groupBy("pattern", "stops").agg(F.count(F.lit(1)).alias("trips"), F.min("trip").alias("first_trip")).select(F.sha2("pattern", 256).alias("pattern_id"), "stops", "trips", "first_trip")



@query("WITH v AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings) SELECT a.vec_id, count(*) - 1 AS neighbours FROM v a JOIN v b ON sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= 0.02 GROUP BY 1")
def grid_radius_join(spark, d):
    v = table(spark, d, "embeddings").select("vec_id", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    return R.grid_join(v, v, "x", "y", 0.02).groupBy("vec_id").agg((F.count(F.lit(1)) - 1).alias("neighbours"))


@query("SELECT p_partkey, trim(regexp_replace(lower(p_name), '\\s+', ' ', 'g')) AS search_key FROM part WHERE starts_with(trim(regexp_replace(lower(p_name), '\\s+', ' ', 'g')), 's')")
def search_prefix(spark, d):
    return table(spark, d, "part").select("p_partkey", C.search_key(F.col("p_name")).alias("search_key")).where(F.col("search_key").startswith("s"))


@query("SELECT event_type, json_extract_string(props, '$.k')::INT AS k, count(*) AS n FROM events GROUP BY 1, 2")
def json_payload(spark, d):
    return table(spark, d, "events").select("event_type", F.get_json_object("props", "$.k").cast("int").alias("k")).groupBy("event_type", "k").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH y AS (SELECT unnest(range(1990, 2051))::INT AS y), a AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM y), b AS (SELECT *, (19 * a + b - b // 4 - ((b - (b + 8) // 25 + 1) // 3) + 15) % 30 AS h FROM a), l AS (SELECT *, ((32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 + 7) % 7 AS l FROM b), m AS (SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM l) SELECT y AS year, make_date(y, (h + l - 7 * m + 114) // 31, (h + l - 7 * m + 114) % 31 + 1) AS easter FROM m""")
def easter_calendar(spark, d):
    return spark.range(1990, 2051).select(F.col("id").cast("int").alias("year")).select("year", C.easter(F.col("year")).alias("easter"))


@query("WITH x AS (SELECT l_orderkey, max(l_shipdate) AS seen, count(*) AS n FROM lineitem GROUP BY 1), o AS (SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '5%' THEN 'not_in_passenger_service' WHEN o_orderstatus = 'P' THEN 'uncertain' WHEN n IS NOT NULL THEN 'observed' WHEN o_orderpriority LIKE '4%' THEN 'skipped_optional' ELSE 'missed' END AS status FROM orders LEFT JOIN x ON l_orderkey = o_orderkey) SELECT status, count(*) AS n FROM o GROUP BY 1")
def expected_stop_status(spark, d):
    seen = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    o = table(spark, d, "orders").join(seen, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    status = F.when(F.col("o_orderpriority").startswith("5"), "not_in_passenger_service").when(F.col("o_orderstatus") == "P", "uncertain").when(F.col("n").isNotNull(), "observed").when(F.col("o_orderpriority").startswith("4"), "skipped_optional").otherwise("missed")
    return o.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_PING}, o AS (SELECT DISTINCT mode, vehicle, date_trunc('hour', gps_time) AS hh FROM p), s AS (SELECT DISTINCT mode, vehicle, hh + to_hours(i) AS hh FROM (SELECT *, unnest(range(5)) AS i FROM o)) SELECT mode, hh AS \"at\", count(*) AS fleet FROM s GROUP BY 1, 2")
def sliding_fleet(spark, d):
    return health.sliding_fleet(pings(spark, d))


@query(f"WITH {_ARR}, g AS (SELECT mode, service_date, avg(delay) AS m FROM a GROUP BY 1, 2), b AS (SELECT mode, service_date, m > 140 AS bad FROM g), l AS (SELECT *, CASE WHEN lag(bad) OVER w IS DISTINCT FROM bad THEN 1 ELSE 0 END AS f FROM b WINDOW w AS (PARTITION BY mode ORDER BY service_date)), i AS (SELECT *, sum(f) OVER (PARTITION BY mode ORDER BY service_date ROWS UNBOUNDED PRECEDING) AS island FROM l), v AS (SELECT mode, island, min(service_date) AS opened, count(*) AS points, bool_and(bad) AS bad FROM i GROUP BY 1, 2), z AS (SELECT *, lead(opened) OVER (PARTITION BY mode ORDER BY opened) AS closed FROM v) SELECT mode, opened, closed, points FROM z WHERE bad AND points >= 2")
def feed_incidents(spark, d):
    g = arrivals(spark, d).groupBy("mode", "service_date").agg((F.avg("delay") > 140).alias("bad"))
    return health.incidents(g, ["mode"], "service_date", "bad", 2)


@query(f"WITH {_PING}, g AS (SELECT vehicle, event_id, floor(epoch(lead(gps_time) OVER (PARTITION BY vehicle, gps_time::DATE ORDER BY gps_time, event_id))) - floor(epoch(gps_time)) AS wait FROM p) SELECT vehicle, avg(wait) AS mean_wait, quantile_cont(wait, [0.1, 0.5, 0.9])[3] AS p90_wait FROM g WHERE wait IS NOT NULL GROUP BY 1")
def turnaround_waits(spark, d):
    at = F.unix_seconds(F.col("gps_time").cast("timestamp"))
    w = Window.partitionBy("vehicle", F.to_date("gps_time")).orderBy("gps_time", "event_id")
    p = pings(spark, d).select("vehicle", (F.lead(at).over(w) - at).alias("wait")).where("wait IS NOT NULL")
    return p.groupBy("vehicle").agg(F.avg("wait").alias("mean_wait"), F.percentile("wait", 0.9).alias("p90_wait"))


@query(f"WITH {_ARR}, g AS (SELECT line, service_date, sum(delay) AS s, count(*) AS n FROM a GROUP BY 1, 2) SELECT line, service_date, sum(s) OVER w3 / sum(n) OVER w3 AS trailing_mean, max(n) OVER w24 AS busiest FROM g WINDOW w3 AS (PARTITION BY line ORDER BY service_date ROWS 2 PRECEDING), w24 AS (PARTITION BY line ORDER BY service_date ROWS 23 PRECEDING)")
def rolling_features(spark, d):
    g = arrivals(spark, d).groupBy("line", "service_date").agg(F.sum("delay").alias("s"), F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("line").orderBy("service_date")
    return g.select("line", "service_date", (F.sum("s").over(w.rowsBetween(-2, 0)) / F.sum("n").over(w.rowsBetween(-2, 0))).alias("trailing_mean"), F.max("n").over(w.rowsBetween(-23, 0)).alias("busiest"))


@query(f"WITH {_ARR}, g AS (SELECT line, avg(delay) AS mean_delay, count(*) AS volume FROM a GROUP BY 1) SELECT line, mean_delay, volume FROM g x WHERE NOT EXISTS (SELECT 1 FROM g y WHERE y.mean_delay <= x.mean_delay AND y.volume >= x.volume AND (y.mean_delay < x.mean_delay OR y.volume > x.volume))")
def pareto_front(spark, d):
    """Lines that no other beats in both measures: sorted by one, a running best of the other decides."""
    g = arrivals(spark, d).groupBy("line").agg(F.avg("delay").alias("mean_delay"), F.count(F.lit(1)).alias("volume"))
    best = g.groupBy("mean_delay").agg(F.max("volume").alias("volume"))
    ahead = F.max("volume").over(Window.orderBy("mean_delay").rowsBetween(Window.unboundedPreceding, -1))
    front = best.withColumn("b", ahead).where("b IS NULL OR b < volume").drop("b")
    return g.join(front, ["mean_delay", "volume"], "left_semi")


@query(f"WITH {_ARR}, o AS (SELECT line, service_date, count(*) AS n FROM a GROUP BY 1, 2), b AS (SELECT * FROM o WHERE line < 15), r AS (SELECT line, service_date, n + 1000 AS n FROM o WHERE line >= 10) SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.line = b.line AND r.service_date = b.service_date) UNION ALL SELECT * FROM r")
def late_overlay(spark, d):
    o = arrivals(spark, d).groupBy("line", "service_date").agg(F.count(F.lit(1)).alias("n"))
    return R.overlay(o.where("line < 15"), o.where("line >= 10").withColumn("n", F.col("n") + 1000), ["line", "service_date"])


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def grain_violations(spark, d):
    return R.require_unique(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT o_orderkey AS run, unnest(range(0, 3600 * (1 + o_custkey % 4), 600 * (1 + o_orderkey % 3)))::BIGINT AS departs FROM orders")
def frequency_expansion(spark, d):
    ends, step = 3600 * (1 + F.col("o_custkey") % 4), 600 * (1 + F.col("o_orderkey") % 3)
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("run"), F.explode(F.sequence(F.lit(0).cast("long"), ends - 1, step)).alias("departs"))


@query("WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey % 30 AS h, l_suppkey % 60 AS m FROM lineitem) SELECT h * 3600 + m * 60 AS seconds, count(*) AS n FROM t GROUP BY 1")
def gtfs_times(spark, d):
    text = F.format_string("%02d:%02d:00", F.col("l_partkey") % 30, F.col("l_suppkey") % 60).alias("text")
    return table(spark, d, "lineitem").select(text).groupBy(C.gtfs_seconds(F.col("text")).cast("long").alias("seconds")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT r_name, n_name, c_mktsegment, count(*) AS customers, sum(c_acctbal) AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name, c_mktsegment)")
def volume_rollup(spark, d):
    j = table(spark, d, "customer").join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.rollup("r_name", "n_name", "c_mktsegment").agg(F.count(F.lit(1)).alias("customers"), F.sum("c_acctbal").alias("balance"))


@query(f"WITH {_ARR}, w AS (SELECT line, event_id, delay, lead(delay) OVER x AS after_1, lead(delay, 2) OVER x AS after_2 FROM a WINDOW x AS (PARTITION BY line, service_date ORDER BY ts, event_id)), u AS (SELECT line, 1 AS horizon, delay, after_1 AS later FROM w UNION ALL SELECT line, 2, delay, after_2 FROM w) SELECT horizon, count(*) AS pairs, round(regr_slope(later, delay), 6) AS alpha, quantile_cont(later - delay, 0.9) AS p90_change FROM u WHERE later IS NOT NULL GROUP BY 1")
def live_persistence(spark, d):
    w = Window.partitionBy("line", "service_date").orderBy("ts", "event_id")
    u = arrivals(spark, d).withColumns({f"a{k}": F.lead("delay", k).over(w) for k in (1, 2)}).select("delay", F.inline(F.array(*[F.struct(F.lit(k).alias("horizon"), F.col(f"a{k}").alias("later")) for k in (1, 2)])))
    return u.where("later IS NOT NULL").groupBy("horizon").agg(F.count(F.lit(1)).alias("pairs"), F.round(F.regr_slope("later", "delay"), 6).alias("alpha"), F.percentile(F.col("later") - F.col("delay"), 0.9).alias("p90_change"))


from tramline import queries_facts, queries_health, queries_journeys, queries_marts, queries_matching, queries_schedule, queries_serving, queries_travel  # noqa: E402, F401

"""Travel times: observed segments, shrunken lookups, ride ranges, stop slots, live calibration, walks and maps."""

from __future__ import annotations

from itertools import pairwise

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions import local as L
from tramline.functions.columns import haversine

#: Fixed values of the model: pseudo-observations towards the parent level, days of the recent window and of its gap,
#: folds, least pairs of an hour's range, ride buckets, least arrivals of a fine slot, tolerance and misses of a margin.
SHRINK, RECENT_DAYS, RECENT_GAP, FOLDS, MIN_PAIRS = 20, 7, 5, 4, 150
RIDE_BUCKETS = (180, 360, 600, 900, 1500, 2400, 3600)
MIN_ARRIVALS, TOLERANCE, MISSES = 150, 30, 0.01
EPS_PER_MILLE = (1, 2, 3, 5, 7, 10, 15, 20)
HORIZONS_MIN = (5, 10, 20, 30, 45, 60, 90)
EXCESS_FROM = (-86400, -120, 120, 300, 600)
WALK_MAX_M, WALK_SPEED, WALK_DETOUR, WALK_MIN_S, STATION_S = 700, 1.2, 1.3, 30, 60
TRIP = ["service_date", "trip_id", "vehicle_number"]


def hour_band(hour: Column) -> Column:
    return F.when(hour < 6, 0).when(hour < 10, 1).when(hour < 14, 2).when(hour < 19, 3).otherwise(4)


def time_band(hour: Column, weekday: Column) -> Column:
    h = hour % 24
    return F.when((h >= 23) | (h < 5), "night").when(weekday & h.isin(7, 8, 15, 16, 17), "peak").otherwise("other")


def day_kind(date: Column, holiday: Column) -> Column:
    return F.when(holiday | (F.dayofweek(date) == 1), 2).when(F.dayofweek(date) == 7, 1).otherwise(0)


def segments(arrival: DataFrame, posts: DataFrame) -> DataFrame:
    """Consecutive stops of complete trips, both seen, in the order of the timetable and of time. The stop before comes
    as one struct, so that a trip is sorted once."""
    a = arrival.where("trip_quality = 'complete'").join(F.broadcast(posts.select("gtfs_snapshot_id", "stop_id", "stop_lat", "stop_lon")), ["gtfs_snapshot_id", "stop_id"])
    trip = ["trip_id", "service_date", "vehicle_number"]
    w = Window.partitionBy(*trip).orderBy("stop_sequence")
    before = F.lag(F.struct("stop_id", "stop_sequence", "actual_arrival_s", "scheduled_arrival_s", "stop_lat", "stop_lon")).over(w)
    s = a.withColumn("a", before).withColumn("first", F.min("stop_sequence").over(Window.partitionBy(*trip)))
    s = s.where((F.col("stop_sequence") == F.col("a.stop_sequence") + 1) & (F.col("actual_arrival_s") > F.col("a.actual_arrival_s")))
    return s.select(
        *TRIP, "mode", "line", "direction_id", F.col("a.stop_id").alias("a_stop"), F.col("stop_id").alias("b_stop"), F.col("stop_sequence").alias("b_seq"), (F.col("stop_sequence") - F.col("first")).alias("pos"), "is_holiday",
        F.round(haversine(F.col("a.stop_lat"), F.col("a.stop_lon"), F.col("stop_lat"), F.col("stop_lon")), 3).alias("dist_m"), (F.col("a.scheduled_arrival_s") - L.midnight(F.col("service_date"))).alias("a_sched_sod"),
        (F.col("scheduled_arrival_s") - F.col("a.scheduled_arrival_s")).alias("sched_s"), (F.col("actual_arrival_s") - F.col("a.actual_arrival_s")).alias("actual_s"),
    )


def features(seg: DataFrame) -> DataFrame:
    hour = F.floor(F.col("a_sched_sod") / 3600).cast("int")
    weeks = F.floor(F.datediff("service_date", F.lit("2000-01-03").cast("date")) / 7)
    return seg.withColumns({
        "seg": F.concat("a_stop", F.lit(">"), "b_stop"), "grp": F.concat(F.substring("a_stop", 1, 4), F.lit(">"), F.substring("b_stop", 1, 4)), "daytype": day_kind(F.col("service_date"), F.col("is_holiday")), "hr": hour, "hb": hour_band(hour),
        "sched_b": F.floor(F.least(F.greatest(F.col("sched_s"), F.lit(0)), F.lit(900)) / 30).cast("int"), "is_tram": F.col("mode") == "tram", "fold": F.pmod(weeks, F.lit(FOLDS)).cast("int"),
    })


BASE = ["is_tram", "daytype", "hr", "sched_b"]
LEVELS = (["grp", "daytype", "hr"], ["seg"], ["seg", "daytype", "hr"])


def fit(rows: DataFrame) -> list[tuple[list[str], DataFrame]]:
    """The lookup: means by mode and timetable, a mean by mode alone, and three levels of shrunken mean residuals, each
    of what the levels before leave."""
    out = [(BASE, rows.groupBy(*BASE).agg(F.avg("actual_s").alias("p0"))), (["is_tram"], rows.groupBy("is_tram").agg(F.avg("actual_s").alias("fb")))]
    for k, keys in enumerate(LEVELS, 1):
        left = _predicted(rows, out)
        out.append((keys, left.groupBy(*keys).agg((F.sum(F.col("actual_s") - F.col("pred")) / (F.count(F.lit(1)) + SHRINK)).alias(f"adj{k}"), F.count(F.lit(1)).alias(f"n{k}"))))
    return out


def _predicted(rows: DataFrame, tables) -> DataFrame:
    for keys, table in tables:
        rows = rows.join(table, keys, "left")
    pred = F.coalesce("p0", "fb")
    for k in range(1, len(tables) - 1):
        pred = pred + F.coalesce(f"adj{k}", F.lit(0.0))
    return rows.withColumn("pred", pred)


def apply(rows: DataFrame, tables) -> DataFrame:
    """The rows with `pred`, and the observations behind each level (0: the level says nothing)."""
    return _predicted(rows, tables).fillna(0, [f"n{k}" for k in range(1, len(LEVELS) + 1)])


def out_of_fold(rows: DataFrame) -> DataFrame:
    """Each row predicted from the rows of the other folds."""
    out = None
    for fold in range(FOLDS):
        part = apply(rows.where(F.col("fold") == fold), fit(rows.where(F.col("fold") != fold)))
        out = part if out is None else out.unionByName(part)
    return out


def recent(rows: DataFrame, gap: int = RECENT_GAP, days: int = RECENT_DAYS) -> DataFrame:
    """Mean segment time of the `days` that end `gap` days before a row's date, less its long-run mean. Daily sums
    go to each window that they are in, and windows meet rows by equality: no range join."""
    daily = rows.groupBy("seg", "hb", "service_date").agg(F.sum("actual_s").alias("s"), F.count(F.lit(1)).alias("n"))
    ends = F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("k")
    win = daily.select("seg", "hb", "s", "n", "service_date", ends).withColumn("win_end", F.date_add("service_date", F.col("k")))
    by_seg = win.groupBy("win_end", "seg").agg((F.sum("s") / F.sum("n")).alias("recent_seg"), F.sum("n").alias("recent_n_seg"))
    by_hb = win.groupBy("win_end", "seg", "hb").agg((F.sum("s") / F.sum("n")).alias("recent_seghb"), F.sum("n").alias("recent_n_seghb"))
    long_seg, long_hb = rows.groupBy("seg").agg(F.avg("actual_s").alias("lr_seg")), rows.groupBy("seg", "hb").agg(F.avg("actual_s").alias("lr_seghb"))
    r = rows.withColumn("win_end", F.date_sub("service_date", gap)).join(by_seg, ["win_end", "seg"], "left").join(by_hb, ["win_end", "seg", "hb"], "left").join(long_seg, "seg", "left").join(long_hb, ["seg", "hb"], "left")
    return r.withColumns({"shift_seg": F.col("recent_seg") - F.col("lr_seg"), "shift_seghb": F.col("recent_seghb") - F.col("lr_seghb")}).fillna(0, ["recent_n_seg", "recent_n_seghb"])


def sampled(rows: DataFrame, per_mille: int) -> DataFrame:
    """The trips whose hash falls into the first `per_mille` of a thousand: the same ones in every run."""
    number = F.conv(F.substring(F.md5(F.concat_ws("|", F.col("service_date").cast("string"), "trip_id", "vehicle_number")), 1, 15), 16, 10).cast("long")
    return rows.where(number % 1000 < per_mille)


def runs(predicted: DataFrame) -> DataFrame:
    """Unbroken runs of segments of a trip: observed and predicted seconds from end to end."""
    w = Window.partitionBy(*TRIP).orderBy("b_seq")
    new = F.coalesce(F.col("b_seq") != F.lag("b_seq").over(w) + 1, F.lit(True)).cast("int")
    r = predicted.withColumn("new", new).withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    hour = (F.floor(F.min_by("a_sched_sod", "b_seq") / 3600) % 24).cast("int")
    return r.groupBy(*TRIP, "run", "is_tram").agg(F.sum("actual_s").alias("actual"), F.sum("pred").alias("pred"), hour.alias("hour")).withColumn("weekday", F.dayofweek("service_date").between(2, 6))


def ride_ranges(pairs: DataFrame, least: int = MIN_PAIRS) -> DataFrame:
    """The grid of modes, weekdays, hours and ride lengths with the 10th and 90th percentile of actual over predicted,
    from the finest level that has enough: hour, band, mode, 0.85 to 1.15."""
    spark = pairs.sparkSession
    edges = [-1.0, *map(float, RIDE_BUCKETS), 1e12]
    bucket = F.lit(None).cast("double")
    for lo, hi in pairwise(edges):
        bucket = F.when((F.col("pred") > lo) & (F.col("pred") <= hi), F.lit(lo)).otherwise(bucket)
    p = pairs.where("pred > 0").withColumns({"min_ride_s": bucket, "band": time_band(F.col("hour"), F.col("weekday")), "r": F.col("actual") / F.col("pred")})
    q = lambda pre: [F.percentile("r", 0.1).alias(f"{pre}_lo"), F.percentile("r", 0.9).alias(f"{pre}_hi")]
    by_hour = p.groupBy("is_tram", "weekday", "hour", "min_ride_s").agg(*q("h"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).drop("n")
    by_band = p.groupBy("is_tram", "band", "min_ride_s").agg(*q("b"))
    by_mode = p.groupBy("is_tram", "min_ride_s").agg(*q("m"))
    flags = F.explode(F.array(F.lit(True), F.lit(False)))
    grid = spark.range(1).select(flags.alias("is_tram")).select("is_tram", flags.alias("weekday")).select("*", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour")).select("*", F.explode(F.array(*map(F.lit, edges[:-1]))).alias("min_ride_s")).withColumn("band", time_band(F.col("hour"), F.col("weekday")))
    out = grid.join(by_hour, ["is_tram", "weekday", "hour", "min_ride_s"], "left").join(by_band, ["is_tram", "band", "min_ride_s"], "left").join(by_mode, ["is_tram", "min_ride_s"], "left")
    return out.select("is_tram", "weekday", "hour", "min_ride_s", F.coalesce("h_lo", "b_lo", "m_lo", F.lit(0.85)).alias("low_ratio"), F.coalesce("h_hi", "b_hi", "m_hi", F.lit(1.15)).alias("high_ratio"))


SLOTS = {"line_stop_hour": ["line", "direction_id", "stop_id", "daytype", "hr"], "line_stop_band": ["line", "direction_id", "stop_id", "daytype", "hb"], "line_stop": ["line", "direction_id", "stop_id"], "generic": ["is_tram", "is_origin", "rel_b", "daytype", "hb"]}
SLOT_KEYS = {"line": "string", "direction_id": "bigint", "stop_id": "string", "daytype": "int", "hr": "int", "hb": "int", "is_tram": "boolean", "is_origin": "boolean", "rel_b": "int"}


def keyed_arrivals(arrival: DataFrame) -> DataFrame:
    """Arrivals of complete trips with their place along the trip, in tenths, and the keys of the slots."""
    w = Window.partitionBy(*TRIP)
    lo, hi, at = F.min("stop_sequence").over(w), F.max("stop_sequence").over(w), F.col("stop_sequence")
    sod = F.col("scheduled_arrival_s") - L.midnight(F.col("service_date"))
    a = arrival.where("trip_quality = 'complete'").withColumns({"is_origin": at == lo, "is_last": at == hi, "rel_b": F.when(hi > lo, F.least(F.lit(9), F.floor(F.try_divide(10 * (at - lo), hi - lo))).cast("int")).otherwise(0), "sod": sod})
    hour = F.floor(F.col("sod") / 3600).cast("int")
    return a.select(*TRIP, "stop_sequence", "line", "direction_id", "stop_id", (F.col("mode") == "tram").alias("is_tram"), F.col("delay_seconds").alias("delay"), "sod", hour.alias("hr"), hour_band(hour).alias("hb"), day_kind(F.col("service_date"), F.col("is_holiday")).alias("daytype"), "is_origin", "is_last", "rel_b")


def stop_slots(keyed: DataFrame, least: int = MIN_ARRIVALS) -> DataFrame:
    """Delay percentiles of each slot on four levels, finer ones only with enough arrivals. dq: all arrivals; e: those
    at which one can board, by tenths of a percent."""
    board = F.when(~F.col("is_last"), F.col("delay"))
    q = [F.percentile("delay", p).alias(n) for n, p in (("dq10", 0.1), ("dq50", 0.5), ("dq90", 0.9))] + [F.percentile(board, pm / 1000).alias(f"e{i}") for i, pm in enumerate(EPS_PER_MILLE)]
    out = None
    for level, keys in SLOTS.items():
        per = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *q)
        if level != "generic":
            per = per.where(F.col("n") >= least)
        names = [F.col(k) if k in keys else F.lit(None).cast(t).alias(k) for k, t in SLOT_KEYS.items()]
        per = per.select(F.lit(level).alias("level"), *names, "n", "dq10", "dq50", "dq90", *[f"e{i}" for i in range(len(EPS_PER_MILLE))])
        out = per if out is None else out.unionByName(per)
    return out


def with_slots(rows: DataFrame, slots: DataFrame, wanted: list[str]) -> DataFrame:
    """The rows with each of the columns from the finest slot that says something of it: a slot of last stops alone has
    no percentiles of boarding."""
    for i, (level, keys) in enumerate(SLOTS.items()):
        one = slots.where(F.col("level") == level).select(*keys, F.struct(*wanted).alias(f"s{i}"))
        rows = rows.join(one, keys, "left")
    best = {c: F.coalesce(*[F.col(f"s{i}.{c}") for i in range(len(SLOTS))]) for c in wanted}
    return rows.withColumns(best).drop(*[f"s{i}" for i in range(len(SLOTS))])


def stop_eps(keyed: DataFrame, slots: DataFrame) -> DataFrame:
    """For each mode and band the loosest margin whose misses stay under the target; 0 if none does."""
    names = [f"e{i}" for i in range(len(EPS_PER_MILLE))]
    c = with_slots(keyed.where(~F.col("is_last")), slots, names).withColumn("band", time_band(F.col("hr"), F.dayofweek("service_date").between(2, 6)))
    miss = [F.avg((F.col("delay") < F.least(F.col(e) + TOLERANCE, F.lit(0)) - TOLERANCE).cast("int")).alias(f"m{i}") for i, e in enumerate(names)]
    rates = c.groupBy("is_tram", "band").agg(*miss)
    pick = F.lit(0)
    for i in range(len(names)):
        pick = F.when(F.col(f"m{i}") <= MISSES, i).otherwise(pick)
    return rates.select("is_tram", "band", pick.alias("eps_index"))


def persistence(keyed: DataFrame, slots: DataFrame, least: int = 1000) -> DataFrame:
    """How a delay beyond the usual one carries to later stops of the trip: slope by mode and minutes ahead, and
    percentiles of what it leaves, by band of the excess where pairs are many enough. A trip meets itself alone, and a
    trip's stops are few, so pairs grow with trips."""
    u = with_slots(keyed, slots, ["dq50"]).withColumn("x", F.col("delay") - F.col("dq50")).where("x IS NOT NULL").select(*TRIP, "stop_sequence", "is_tram", "sod", "x")
    j = u.select(*TRIP, F.col("stop_sequence").alias("j_seq"), F.col("sod").alias("j_sod"), F.col("x").alias("y"))
    ahead = F.col("j_sod") - F.col("sod")
    p = u.join(j, TRIP).where((F.col("j_seq") > F.col("stop_sequence")) & ahead.between(1, HORIZONS_MIN[-1] * 60))
    horizon = F.lit(None).cast("int")
    for m in reversed(HORIZONS_MIN):
        horizon = F.when(ahead <= m * 60, m).otherwise(horizon)
    p = p.select("is_tram", horizon.alias("horizon_min"), "x", "y")
    slope = p.groupBy("is_tram", "horizon_min").agg((F.covar_pop("x", "y") / F.nullif(F.var_pop("x"), F.lit(0.0))).alias("alpha")).where("alpha IS NOT NULL")
    band = F.lit(EXCESS_FROM[0])
    for b in EXCESS_FROM[1:]:
        band = F.when(F.col("x") >= b, b).otherwise(band)
    r = p.join(F.broadcast(slope), ["is_tram", "horizon_min"]).select("is_tram", "horizon_min", "alpha", band.alias("excess_s"), (F.col("y") - F.col("alpha") * F.col("x")).alias("r"))
    q = lambda pre: F.percentile("r", F.array(*map(F.lit, (0.1, 0.5, 0.9)))).alias(pre)
    pooled = r.groupBy("is_tram", "horizon_min").agg(F.min("alpha").alias("alpha"), q("pq"))
    banded = r.groupBy("is_tram", "horizon_min", "excess_s").agg(F.count(F.lit(1)).alias("n"), q("bq"))
    grid = pooled.select("*", F.explode(F.array(*map(F.lit, EXCESS_FROM))).alias("excess_s")).join(banded, ["is_tram", "horizon_min", "excess_s"], "left").fillna(0, ["n"])
    best = F.when(F.col("n") >= least, F.col("bq")).otherwise(F.col("pq"))
    return grid.select("is_tram", "horizon_min", "excess_s", "n", F.round("alpha", 6).alias("alpha"), *[F.round(best[i], 4).alias(c) for i, c in enumerate(("low_s", "mid_s", "high_s"))])


def turnaround(trip: DataFrame, slack: int = 120) -> DataFrame:
    """Seconds from a vehicle's late arrival to its next departure, where less than `slack` of the break was left."""
    w = Window.partitionBy("service_date", "vehicle_number").orderBy("scheduled_start_s", "trip_id")
    t = trip.where("trip_quality IN ('complete', 'partial') AND mode IN ('bus', 'tram')").withColumn("b", F.lead(F.struct("scheduled_start_s", "start_delay_seconds")).over(w))
    t = t.withColumn("layover", F.col("b.scheduled_start_s") - F.col("scheduled_end_s")).where("layover BETWEEN 0 AND 3600").where(F.col("layover") - F.col("end_delay_seconds") < slack)
    turn = F.col("b.start_delay_seconds") + F.col("layover") - F.col("end_delay_seconds")
    return t.groupBy((F.col("mode") == "tram").alias("is_tram")).agg(F.count(F.lit(1)).alias("n"), *[F.percentile(turn, p).alias(c) for c, p in (("low_s", 0.1), ("mid_s", 0.5), ("high_s", 0.9))])


def expected_times(keyed: DataFrame, slots: DataFrame) -> DataFrame:
    """One expected time for each stop of a trip: the mean of the starts that the stops so far imply (timetable and
    usual delay, less the ride), plus the ride, never before that of the stop ahead."""
    s = with_slots(keyed, slots, ["dq50", "e3"])
    w = Window.partitionBy(*TRIP).orderBy("stop_sequence")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumns({"usual": F.round("dq50"), "leave_by": F.when(~F.col("is_last"), F.floor(F.round(F.least(F.col("e3") + TOLERANCE, F.lit(0)), 6))), "ride": F.col("sod") - F.first("sod").over(so_far)})
    start = F.when(F.col("leave_by").isNotNull(), F.col("sod") + F.greatest("usual", F.col("leave_by").cast("double")) - F.col("ride"))
    s = s.withColumn("start", start).withColumn("mean", F.avg("start").over(so_far))
    s = s.withColumn("raw", F.coalesce(F.col("mean") + F.col("ride"), F.col("sod") + F.col("usual")))
    return s.select(*TRIP, "stop_sequence", "usual", "leave_by", "ride", F.floor(F.max("raw").over(so_far) + 0.5).cast("long").alias("expected_sod"))


def near(left: DataFrame, right: DataFrame, metres: float) -> DataFrame:
    """Pairs of (id, lat, lon) within so many metres on the sphere. Cells of that size in degrees meet by equality with
    their eight neighbours; the distance decides. Cells of longitude are as wide as it takes at latitude 60."""
    dy, dx = metres / 111_000, metres / 55_000
    cell = lambda c, d: F.floor(F.col(c) / d).cast("long")
    a = left.select(F.col("id").alias("a_id"), F.col("lat").alias("a_lat"), F.col("lon").alias("a_lon"), cell("lat", dy).alias("cy"), cell("lon", dx).alias("cx"))
    step = F.explode(F.sequence(F.lit(-1), F.lit(1)))
    b = right.select(F.col("id").alias("b_id"), F.col("lat").alias("b_lat"), F.col("lon").alias("b_lon"), step.alias("sy"), cell("lat", dy).alias("y"), cell("lon", dx).alias("x")).select("*", step.alias("sx"))
    b = b.select("b_id", "b_lat", "b_lon", (F.col("y") + F.col("sy")).alias("cy"), (F.col("x") + F.col("sx")).alias("cx"))
    out = a.join(b, ["cy", "cx"]).withColumn("metres", haversine(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon")))
    return out.where(F.col("metres") <= metres).select("a_id", "b_id", "metres")


def footpaths(posts: DataFrame) -> DataFrame:
    """Walks between posts (id, lat, lon, station): straight lines and a detour, at walking speed, and the way to a
    platform."""
    station = posts.select(F.col("id").alias("s_id"), "station")
    n = near(posts, posts, WALK_MAX_M / WALK_DETOUR).where("a_id <> b_id").withColumn("d", F.col("metres") * WALK_DETOUR)
    for side in ("a", "b"):
        n = n.join(station.withColumnsRenamed({"s_id": f"{side}_id", "station": f"{side}_station"}), f"{side}_id")
    walk = F.greatest(F.lit(WALK_MIN_S), F.ceil(F.col("d") / WALK_SPEED)) + F.when(F.col("a_station") | F.col("b_station"), STATION_S).otherwise(0)
    return n.select(F.col("a_id").alias("from_stop_id"), F.col("b_id").alias("to_stop_id"), F.round("d").cast("int").alias("distance_m"), walk.cast("int").alias("walk_s"))


def segment_changes(event: DataFrame, arrival: DataFrame) -> DataFrame:
    """Pairs of neighbouring expected stops of complete trips, neighbours before anything is dropped, with what makes
    them usable and how the delay changes."""
    keys = ["gtfs_snapshot_id", *TRIP]
    seen = arrival.select(*keys, "stop_sequence", "scheduled_arrival_s", "actual_arrival_s")
    e = event.where("trip_quality = 'complete' AND mode IN ('bus', 'tram')").join(seen, [*keys, "stop_sequence"], "left")
    w = Window.partitionBy(*keys).orderBy("stop_sequence")
    e = e.withColumn("p", F.lag(F.struct("stop_id", "stop_sequence", "is_observed", "delay_seconds", "scheduled_arrival_s", "actual_arrival_s")).over(w)).where("p IS NOT NULL")
    by_day = lambda c: L.wall(F.col(c))
    now, then = by_day("scheduled_arrival_s"), by_day("p.scheduled_arrival_s")
    day = (F.to_date(now) == F.to_date(then)) & F.hour(now).between(6, 21) & F.hour(then).between(6, 21)
    ordered = (F.col("actual_arrival_s") >= F.col("p.actual_arrival_s")) & (F.col("scheduled_arrival_s") >= F.col("p.scheduled_arrival_s"))
    delta = F.col("delay_seconds") - F.col("p.delay_seconds")
    drift = F.abs(delta - ((F.col("actual_arrival_s") - F.col("p.actual_arrival_s")) - (F.col("scheduled_arrival_s") - F.col("p.scheduled_arrival_s"))))
    sure = lambda c: F.coalesce(c, F.lit(False))
    return e.withColumns({
        "period": F.when(F.dayofweek("service_date").isin(1, 7), "weekend").otherwise("weekday"), "time_window": F.when(sure(day), "daytime").otherwise("outside"), "delta": delta,
        "has_endpoints": sure(F.col("is_observed") & F.col("p.is_observed") & F.col("delay_seconds").isNotNull() & F.col("p.delay_seconds").isNotNull()), "has_ordered_times": sure(ordered), "has_consistent_delta": sure(drift <= 1),
    })


USABLE = "has_endpoints AND has_ordered_times AND has_consistent_delta"


def segment_statistics(changes: DataFrame) -> DataFrame:
    d = F.col("delta")
    key = ["period", "time_window", "gtfs_snapshot_id", "line", "mode", "direction_id", F.col("p.stop_id").alias("from_stop_id"), F.col("stop_id").alias("to_stop_id"), F.col("p.stop_sequence").alias("from_stop_sequence"), F.col("stop_sequence").alias("to_stop_sequence")]
    return changes.where(USABLE).groupBy(*key).agg(
        F.count(F.lit(1)).alias("observation_count"), F.countDistinct("service_date").alias("observed_days"), F.sum(d).alias("sum_delta_seconds"), F.sum(F.greatest(d, F.lit(0))).alias("sum_gain_seconds"), F.sum(F.greatest(-d, F.lit(0))).alias("sum_recovery_seconds"),
        F.count_if(d > 0).alias("gain_count"), F.count_if(d < 0).alias("recovery_count"), F.count_if(d == 0).alias("unchanged_count"), F.avg("p.delay_seconds").alias("mean_from_delay_seconds"), F.avg("delay_seconds").alias("mean_to_delay_seconds"),
    )


def pair_coverage(changes: DataFrame) -> DataFrame:
    ok = F.expr(USABLE)
    return changes.groupBy("service_date", "period").agg(F.count(F.lit(1)).alias("candidate_pairs"), F.count_if(ok).alias("usable_pairs"), *[F.count_if(~F.col(c)).alias(n) for c, n in (("has_endpoints", "missing_endpoint_count"), ("has_ordered_times", "invalid_time_count"), ("has_consistent_delta", "inconsistent_delta_count"))], F.count_if((F.col("time_window") == "daytime") & ok).alias("daytime_usable_pairs"))


def pooled(stats: DataFrame) -> DataFrame:
    """Segments of one pair of stops over snapshots, lines and windows of the day, weighed by their observations."""
    n = F.col("observation_count")
    return stats.groupBy("period", "mode", "from_stop_id", "to_stop_id").agg(F.sum(n).alias("observations"), F.count(F.lit(1)).alias("parts"), (F.sum("sum_delta_seconds") / F.sum(n)).alias("mean_change"), (F.sum(F.col("mean_to_delay_seconds") * n) / F.sum(n)).alias("mean_to_delay"), F.max("observed_days").alias("lower_days"), F.sum("observed_days").alias("upper_days"))

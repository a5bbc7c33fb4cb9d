"""Serving tables: windows of dates, entities within them, rankings, courses and daily lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions import local as L
from tramline.functions.columns import delay_block, delay_histogram

#: The reference number of matching dates of a rolling window, and how far back any window looks.
MATCHING, LOOKBACK = 60, 420


def observed_dates(arrival: DataFrame) -> DataFrame:
    """Dates with arrivals, and one kind of day for each (the first by name)."""
    return arrival.groupBy("service_date").agg(F.min("schedule_day_type").alias("schedule_day_type"))


def window_dates(observed: DataFrame, until: Column, matching: int = MATCHING, lookback: int = LOOKBACK) -> DataFrame:
    """window_type, window_key, service_date, schedule_day_type, date_rank: the dates of the day, the month, and the
    last `matching` weekdays and weekend days that end with `until`. The day's window stands even if nothing ran."""
    o = observed.where(F.col("service_date").between(F.date_sub(until, lookback), until))
    kind = F.when(F.col("schedule_day_type").isin("monday", "tuesday", "wednesday", "thursday", "friday", "weekday"), "weekdays").when(F.col("schedule_day_type").isin("saturday", "sunday_holiday"), "weekend")
    desc = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("service_date")))
    rolling = o.withColumn("window_type", kind).where("window_type IS NOT NULL").withColumn("date_rank", desc("window_type")).where(F.col("date_rank") <= matching)
    rolling = rolling.select("window_type", until.cast("string").alias("window_key"), "service_date", "schedule_day_type", "date_rank")
    month = o.where(F.trunc("service_date", "month") == F.trunc(until, "month")).withColumn("m", F.lit("month"))
    month = month.select(F.lit("month").alias("window_type"), F.date_format(until, "yyyy-MM").alias("window_key"), "service_date", "schedule_day_type", desc("m").alias("date_rank"))
    day = observed.sparkSession.range(1).select(until.alias("service_date")).join(o, "service_date", "left")
    day = day.select(F.lit("day").alias("window_type"), until.cast("string").alias("window_key"), "service_date", "schedule_day_type", F.lit(1).alias("date_rank"))
    return day.unionByName(month).unionByName(rolling)


def window_arrivals(serving: DataFrame) -> DataFrame:
    """Narrow rows of complete trips; long identities become 64-bit numbers."""
    return serving.where((F.col("trip_quality") == "complete") & F.col("mode").isin("bus", "tram")).select(
        "service_date", "gps_date", F.xxhash64("gtfs_snapshot_id", "trip_id", "vehicle_number").alias("trip_key"), F.xxhash64("gtfs_snapshot_id", "trip_id").alias("universe_trip_key"), "schedule_version_id",
        "mode", "line", "route_short_name", "direction_id", "trip_headsign", "stop_group_id", "stop_id", "stop_name", "stop_post_code", "stop_sequence", "schedule_day_type", "hour_bracket_s", "delay_seconds",
    )


def in_windows(arrival: DataFrame, windows: DataFrame, versions: DataFrame, until: Column) -> DataFrame:
    """Arrivals once for each window that holds their date, and whether their schedule version is in force at its end.
    Windows have a row for each date and type, hundreds in all, and versions in force one for each line."""
    anchors = versions.where((F.col("valid_from_date") <= until) & (F.coalesce("valid_to_date", F.lit("9999-12-31").cast("date")) >= until)).select("schedule_version_id", F.lit(True).alias("anchored"))
    out = arrival.join(F.broadcast(windows.select("window_type", "window_key", "service_date")), "service_date").join(anchors, "schedule_version_id", "left")
    return out.withColumn("is_anchor", F.coalesce("anchored", F.lit(False))).drop("anchored")


ENTITIES = {"mode": "mode", "line": "line", "stop_group": "stop_group_id", "stop_post": "stop_id"}


def fanned(base: DataFrame, entities: dict[str, str] = ENTITIES) -> DataFrame:
    """A row for each entity of an arrival; a line counts in a rolling window only under its version in force."""
    each = F.array(*[F.struct(F.lit(k).alias("entity_type"), F.col(c).alias("entity_id")) for k, c in entities.items()])
    out = base.select("*", F.inline(each))
    return out.where((F.col("entity_type") != "line") | F.col("window_type").isin("day", "month") | F.col("is_anchor"))


#: Windows by the bit that stands for each.
BITS = {"day": 1, "month": 2, "weekdays": 4, "weekend": 8}


def marked(arrival: DataFrame, windows: DataFrame, versions: DataFrame, until: Column) -> DataFrame:
    """Arrivals of complete trips (with `is_ranked`) that a window holds, a row each: `held` has the bits of their
    windows, from bit 4 on again for trips of the ranking universe; from bit 8 on both for lines, which count in a
    rolling window only under their version in force."""
    a = arrival.where((F.col("trip_quality") == "complete") & F.col("mode").isin("bus", "tram"))
    bit = F.coalesce(*[F.when(F.col("window_type") == k, F.lit(b)) for k, b in BITS.items()])
    dates = windows.groupBy("service_date").agg(F.bit_or(bit).alias("all"))
    anchors = versions.where(until.between(F.col("valid_from_date"), F.coalesce("valid_to_date", F.lit("9999-12-31").cast("date")))).select("schedule_version_id", F.lit(True).alias("anchored")).distinct()
    a = a.join(F.broadcast(dates), "service_date").join(F.broadcast(anchors), "schedule_version_id", "left")
    line = F.when(F.col("anchored"), F.col("all")).otherwise(F.col("all").bitwiseAND(BITS["day"] | BITS["month"]))
    ranked = F.when(F.col("is_ranked"), F.lit(16)).otherwise(F.lit(0))
    both = lambda c: c + c * ranked
    return a.withColumn("held", both(F.col("all")) + both(line) * 256)


def of_entities(rows: DataFrame, *own: str) -> DataFrame:
    """Rows of marked() once for each entity, with the bits that hold for it; no row if no window is left."""
    bits = lambda k: F.col("held").bitwiseAND(255) if k != "line" else F.shiftright("held", 8)
    each = F.array(*[F.struct(F.lit(k).alias("entity_type"), F.col(c).alias("entity_id"), (bits(k).bitwiseAND(15) if k == "mode" else bits(k)).alias("bits")) for k, c in ENTITIES.items()])
    return rows.select(*own, "mode", F.inline(each)).where("bits <> 0")


def in_bits(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """Rows with `bits` once for each universe and window that the bits stand for."""
    kinds = F.array(*[F.struct(F.lit(u).alias("universe_type"), F.lit(k).alias("window_type"), F.lit(b * by).alias("bit")) for u, by in (("all_observed", 1), ("zone1_public", 16)) for k, b in BITS.items()])
    out = rows.select("*", F.inline(F.filter(kinds, lambda x: x["bit"].bitwiseAND(F.col("bits")) != 0))).drop("bits", "bit")
    return out.join(F.broadcast(windows.select("window_type", "window_key").distinct()), "window_type")


def entity_windows(arrival: DataFrame, windows: DataFrame, versions: DataFrame, until: Column) -> DataFrame:
    """int_serving_entity_window_summary: entities in windows, for all trips and for those of the ranking universe.

    Arrivals are folded before they are multiplied, three ways: to numbers of equal delays at a post, to dates and
    headsigns of a post, and to posts of a trip. Trips are told apart where they lie, by their bits."""
    a = marked(arrival, windows, versions, until)
    place = ["mode", "line", "stop_group_id", "stop_id"]
    entity = ["entity_type", "entity_id", "mode"]
    key = [*entity, "universe_type", "window_type", "window_key"]
    d, n = F.col("delay_seconds"), F.col("n")
    counts = a.groupBy("held", *place, "delay_seconds").agg(F.count(F.lit(1)).alias("n"))
    counts = of_entities(counts, "delay_seconds", "n").groupBy(*entity, "bits", "delay_seconds").agg(F.sum("n").alias("n"))
    delays = in_bits(counts, windows).groupBy(*key).agg(*delay_block(d, n), delay_histogram(d, n).alias("delay_histogram"))
    seen = a.select("held", *place, "service_date", "trip_headsign").distinct()
    own = ["service_date", "trip_headsign"]
    seen = of_entities(seen.withColumns({f"own_{c}": F.col(c) for c in place[1:]}), *own, *[f"own_{c}" for c in place[1:]])
    several = lambda c: F.size(F.collect_set(c)).cast("long")
    seen = in_bits(seen.distinct(), windows).groupBy(*key).agg(
        F.min("service_date").alias("source_start_date"), several("service_date").alias("source_day_count"), F.min("trip_headsign").alias("route_label"),
        several("own_line").alias("line_count"), several("own_stop_group_id").alias("stop_group_count"), several("own_stop_id").alias("stop_post_count"),
    )
    trip = ["trip_id", "run"]
    posts = a.withColumn("run", F.xxhash64("gtfs_snapshot_id", "vehicle_number")).groupBy(*trip, *place).agg(F.bit_or("held").alias("held"))
    trips = of_entities(posts, *trip).groupBy(*trip, *entity).agg(F.bit_or("bits").alias("bits"))
    trips = in_bits(trips.groupBy(*entity, "bits").agg(F.count(F.lit(1)).alias("n")), windows).groupBy(*key).agg(F.sum("n").alias("trip_count"))
    out = seen.join(trips, key).join(delays, key).withColumn("delay_spread", F.col("p90_delay") - F.col("median_delay"))
    return out.select(*key, *seen.columns[6:], "trip_count", *delays.columns[6:], "delay_spread")


def rankings(summary: DataFrame) -> DataFrame:
    """mart_entity_rankings: four measures of the entities of the ranking universe with enough arrivals a day."""
    need = F.when(F.col("entity_type") == "line", 20).otherwise(10) * F.col("source_day_count")
    e = summary.where((F.col("universe_type") == "zone1_public") & (F.col("arrivals") >= need))
    values = ["median_delay", "on_time_rate", "arrivals", "delay_spread"]
    u = e.withColumn("arrivals", F.col("arrivals").cast("double")).unpivot(["entity_type", "entity_id", "mode", "window_type", "window_key"], values, "metric", "value").where("value IS NOT NULL")
    part = Window.partitionBy("entity_type", "metric", "mode", "window_type", "window_key")
    return u.withColumns({"position": F.row_number().over(part.orderBy(F.desc("value"), "entity_id")), "n_entities": F.count(F.lit(1)).over(part)})


def hour_windows(base: DataFrame) -> DataFrame:
    """mart_hour_window_summary: entities by local hour; the service day begins at four."""
    hour = L.local_hour(F.col("hour_bracket_s"))
    rows = fanned(base).withColumn("local_hour", hour)
    key = ["entity_type", "entity_id", "mode", "window_type", "window_key", "local_hour"]
    out = rows.groupBy(*key).agg(F.min("service_date").alias("source_start_date"), F.count(F.lit(1)).alias("arrival_count"), F.percentile("delay_seconds", 0.5).alias("median_delay_seconds"))
    return out.withColumns({"service_hour_index": (F.col("local_hour") + 20) % 24, "hour_bracket_label": F.format_string("%02d", "local_hour"), "has_min_sample": F.col("arrival_count") >= 3})


def daily_in_windows(base: DataFrame) -> DataFrame:
    """mart_entity_window_daily_summary: an entity's dates within a window."""
    key = ["entity_type", "entity_id", "mode", "window_type", "window_key", "service_date"]
    return fanned(base).groupBy(*key).agg(F.count(F.lit(1)).alias("arrival_count"), F.percentile("delay_seconds", 0.5).alias("median_delay_seconds"))


def entity_days(arrival: DataFrame) -> DataFrame:
    """mart_entity_daily_summary."""
    each = F.array(*[F.struct(F.lit(k).alias("entity_type"), F.col(c).alias("entity_id")) for k, c in ENTITIES.items()])
    return arrival.select("mode", "service_date", "delay_seconds", F.inline(each)).groupBy("entity_type", "entity_id", "mode", "service_date").agg(F.count(F.lit(1)).alias("arrival_count"), F.percentile("delay_seconds", 0.5).alias("median_delay_seconds"))


def timeline(serving: DataFrame, most: int = 600) -> DataFrame:
    """mart_entity_timeline_daily: points of a day, a line's one for each trip (median delay, middle of its scheduled
    times), a stop's one for each arrival; the first 600, placed from 04:00 in percent of a day."""
    a = serving.where((F.col("trip_quality") == "complete") & F.col("mode").isin("bus", "tram"))
    ms = F.col("scheduled_arrival_s")
    lines = a.groupBy(F.col("line").alias("entity_id"), "mode", "service_date", "trip_id", "vehicle_number").agg(F.percentile("delay_seconds", 0.5).alias("delay_seconds"), ((F.min(ms) + F.max(ms)) / 2).alias("at"))
    lines = lines.select(F.lit("line").alias("entity_type"), "entity_id", "mode", "service_date", "delay_seconds", "at", "trip_id", "vehicle_number", F.lit(0).alias("seq"))
    each = F.array(*[F.struct(F.lit(k).alias("entity_type"), F.col(c).alias("entity_id")) for k, c in (("stop_group", "stop_group_id"), ("stop_post", "stop_id"))])
    posts = a.select(F.inline(each), "mode", "service_date", F.col("delay_seconds").cast("double").alias("delay_seconds"), ms.cast("double").alias("at"), "trip_id", "vehicle_number", F.col("stop_sequence").alias("seq"))
    w = Window.partitionBy("entity_type", "entity_id", "mode", "service_date").orderBy("at", "trip_id", "vehicle_number", "seq")
    out = lines.unionByName(posts).withColumn("point_rank", F.row_number().over(w)).where(F.col("point_rank") <= most)
    start = L.midnight(F.col("service_date")) + 14400
    return out.select("entity_type", "entity_id", "mode", "service_date", "point_rank", F.round((F.col("at") - start) / 864.0, 9).alias("x_percent"), "delay_seconds", F.col("at").alias("source_event_s"))


def stop_lines(base: DataFrame) -> DataFrame:
    """mart_stop_line_window_summary: lines and destinations of stops in windows, the latest on top."""
    rows = base.select("*", F.inline(F.array(F.struct(F.lit("stop_group").alias("entity_type"), F.col("stop_group_id").alias("entity_id")), F.struct(F.lit("stop_post").alias("entity_type"), F.col("stop_id").alias("entity_id")))))
    key = ["entity_type", "entity_id", "mode", "line", "direction_id", "trip_headsign", "window_type", "window_key"]
    out = rows.groupBy(*key).agg(*delay_block(F.col("delay_seconds")))
    w = Window.partitionBy("entity_type", "entity_id", "mode", "window_type", "window_key").orderBy(F.desc("median_delay"), F.desc("arrivals"), "line", "direction_id", "trip_headsign")
    return out.withColumns({"display_rank": F.row_number().over(w), "delay_spread": F.col("p90_delay") - F.col("median_delay"), "has_min_sample": F.col("arrivals") >= 3})


def stop_group_lines(base: DataFrame) -> DataFrame:
    """mart_stop_group_line_group_window: lines of a stop group by number, their destinations by use, and the posts."""
    key = ["stop_group_id", "mode", "line", "trip_headsign", "window_type", "window_key"]
    per = base.groupBy(*key).agg(F.count(F.lit(1)).alias("arrival_count"), F.array_sort(F.collect_set(F.struct("stop_id", "stop_post_code"))).alias("posts"))
    number = F.col("line").try_cast("bigint").asc_nulls_first()
    by_line = Window.partitionBy("stop_group_id", "mode", "window_type", "window_key").orderBy(number, "line")
    by_use = Window.partitionBy("stop_group_id", "mode", "line", "window_type", "window_key").orderBy(F.desc("arrival_count"), F.col("trip_headsign").asc_nulls_first())
    return per.withColumns({"line_display_rank": F.dense_rank().over(by_line), "destination_display_rank": F.row_number().over(by_use)})


def eligible_patterns(patterns: DataFrame, windows: DataFrame, versions: DataFrame, until: Column) -> DataFrame:
    out = in_windows(patterns, windows, versions, until)
    return out.where(F.col("window_type").isin("day", "month") | F.col("is_anchor"))


COURSE = ["line", "mode", "direction_id", "trip_headsign", "route_pattern_id", "window_type", "window_key"]


def courses(eligible: DataFrame) -> DataFrame:
    """mart_line_course_window: a line's courses in a window, the most run first."""
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("service_date", "gtfs_snapshot_id", F.col("trip_id").alias("t"))))
    per = eligible.groupBy(*COURSE).agg(F.min("pattern_status").alias("pattern_status"), last("origin_stop_name").alias("origin_stop_name"), last("destination_stop_name").alias("destination_stop_name"), F.min("stop_call_count").alias("stop_call_count"), F.array_sort(F.collect_set("service_date")).alias("observed_service_dates"), F.count(F.lit(1)).alias("trip_count"))
    w = Window.partitionBy("line", "mode", "window_type", "window_key").orderBy(F.desc("trip_count"), F.col("direction_id"), F.col("trip_headsign").asc_nulls_first(), "route_pattern_id")
    return per.withColumn("course_rank", F.row_number().over(w))


def course_stops(eligible: DataFrame, arrival: DataFrame) -> DataFrame:
    """mart_line_course_stop_window: the calls of a course in order, with the arrivals seen there; calls without any
    stay, and don't count."""
    c = eligible.select(*COURSE, "gps_date", "service_date", F.xxhash64("gtfs_snapshot_id", "trip_id", "vehicle_number").alias("trip_key"), F.posexplode("calls").alias("pos", "call"))
    c = c.select(*COURSE, "gps_date", "service_date", "trip_key", (F.col("pos") + 1).alias("call_position"), "call.*")
    seen = arrival.select("trip_key", "gps_date", "service_date", "stop_sequence", "stop_id", "delay_seconds")
    rows = c.join(seen, ["trip_key", "gps_date", "service_date", "stop_sequence", "stop_id"], "left")
    d = F.col("delay_seconds")
    out = rows.groupBy(*COURSE, "call_position").agg(
        F.min("stop_sequence").alias("stop_sequence"), F.min("stop_group_id").alias("stop_group_id"), F.min("stop_id").alias("stop_id"), F.count(F.lit(1)).alias("trip_count"), F.count(d).alias("arrival_count"), F.avg(d).alias("mean_delay_seconds"), F.percentile(d, 0.5).alias("median_delay_seconds"),
        F.percentile(d, 0.9).alias("p90_delay_seconds"), F.count_if(d <= -60).alias("early_count"), F.count_if(d >= 180).alias("late_count"),
    )
    return out.withColumns({"has_min_sample": F.col("arrival_count") >= 3, "late_rate": F.try_divide("late_count", "arrival_count")})


def reliability(execution: DataFrame, most: int = 160) -> DataFrame:
    """mart_line_reliability_daily: outcomes of a course's trips of a day, the first 160 in order, and their numbers."""
    outcome = F.when(F.col("trip_quality") == "complete", "clean").when(F.col("trip_quality") == "broken", "broken").otherwise("partial")
    t = execution.withColumn("outcome", outcome)
    key = ["service_date", "mode", "line", "schedule_version_id", "direction_id", "trip_headsign"]
    w = Window.partitionBy(*key).orderBy("scheduled_start_s", "trip_id", "vehicle_number")
    t = t.withColumn("place", F.row_number().over(w))
    label = F.date_format(L.wall(F.col("scheduled_start_s")), "HH:mm")
    listed = F.array_sort(F.collect_list(F.when(F.col("place") <= most, F.struct("place", "trip_id", "vehicle_number", "scheduled_start_s", "outcome", label.alias("label")))))
    per = t.groupBy(*key).agg(*[F.count_if(F.col("outcome") == o).alias(f"{o}_count") for o in ("clean", "partial", "broken")], listed.alias("outcomes"))
    rank = Window.partitionBy("service_date", "mode", "line").orderBy((F.col("clean_count") + F.col("partial_count") + F.col("broken_count")).desc(), "direction_id", F.col("trip_headsign").asc_nulls_first(), "schedule_version_id")
    return per.withColumn("display_rank", F.row_number().over(rank))


def trip_days(execution: DataFrame, events: DataFrame) -> DataFrame:
    """mart_trip_daily: trips with their delay profile, its greatest jump between stops in a row, and six ranks."""
    key = ["gtfs_snapshot_id", "service_date", "trip_id", "vehicle_number"]
    profile = F.transform(F.array_sort(F.collect_list(F.when(F.col("delay_seconds").isNotNull(), F.struct("stop_sequence", "delay_seconds")))), lambda x: x["delay_seconds"])
    per = events.where("observation_status = 'observed'").groupBy(*key).agg(profile.alias("p"))
    t = execution.join(per, key, "left").withColumn("p", F.coalesce("p", F.array().cast("array<bigint>")))
    jumps = F.transform(F.sequence(F.lit(1), F.size("p") - 1), lambda i: F.abs(F.element_at("p", i + 1) - F.element_at("p", i)))
    t = t.withColumn("erratic_score", F.when(F.size("p") > 1, F.array_max(jumps)).otherwise(0).cast("long"))
    w = lambda *order: Window.partitionBy("service_date", "mode", "line").orderBy(*order, "trip_id", "vehicle_number")
    land = lambda *order: F.when(F.col("trip_quality") == "complete", F.row_number().over(Window.partitionBy("service_date", "mode", "trip_quality").orderBy(*order, "trip_id", "vehicle_number")))
    end, start = F.col("end_delay_seconds"), F.col("scheduled_start_s")
    ranks = {
        "departure_rank": F.row_number().over(w(start)), "line_end_delay_rank": F.row_number().over(w(end.desc(), start)), "line_erratic_rank": F.row_number().over(w(F.desc("erratic_score"), start)),
        "landing_worst_rank": land(F.abs(end).desc(), end.desc(), start), "landing_best_rank": land(F.abs(end), start), "landing_erratic_rank": land(F.desc("erratic_score"), end.desc()),
    }
    label = F.coalesce("trip_headsign", "destination_stop_name", "route_short_name")
    return t.withColumns({"route_label": label, **ranks}).select(*key, "mode", "line", "route_label", "end_delay_seconds", F.col("p").alias("delay_profile"), "erratic_score", *ranks)


def worst_events(serving: DataFrame, most: int = 20) -> DataFrame:
    """mart_worst_delay_event: the latest arrivals of each line, stop group and post on a day."""
    a = serving.where((F.col("trip_quality") == "complete") & F.col("mode").isin("bus", "tram"))
    each = F.array(*[F.struct(F.lit(k).alias("scope_type"), F.col(c).alias("scope_id")) for k, c in (("line", "line"), ("stop_group", "stop_group_id"), ("stop_post", "stop_id"))])
    w = Window.partitionBy("scope_type", "scope_id", "service_date", "mode").orderBy(F.desc("delay_seconds"), "scheduled_arrival_s", "trip_id", "vehicle_number", "stop_sequence")
    out = a.select("*", F.inline(each)).withColumn("delay_rank", F.row_number().over(w)).where(F.col("delay_rank") <= most)
    return out.select("scope_type", "scope_id", "service_date", "mode", "line", "trip_id", "vehicle_number", "stop_id", "stop_post_code", "scheduled_arrival_s", F.date_format(L.wall(F.col("scheduled_arrival_s")), "HH:mm").alias("time_label"), "delay_seconds", "delay_rank")


def trip_lines(execution: DataFrame) -> DataFrame:
    """mart_trip_line_daily: lines of a day in the order of their numbers."""
    per = execution.where("trip_quality = 'complete'").groupBy("service_date", "mode", "line").agg(F.count(F.lit(1)).alias("trip_count"))
    w = Window.partitionBy("service_date", "mode").orderBy(F.col("line").try_cast("bigint").asc_nulls_first(), "line")
    return per.withColumn("line_display_rank", F.row_number().over(w))


def trip_modes(execution: DataFrame) -> DataFrame:
    """mart_trip_mode_daily_summary."""
    d = F.col("end_delay_seconds")
    return execution.where("trip_quality = 'complete'").groupBy("service_date", "mode").agg(F.count(F.lit(1)).alias("trip_count"), (F.count_if((d > -60) & (d < 180)) / F.count(F.lit(1))).alias("on_time_rate"), F.percentile(d, 0.5).alias("median_delay_seconds"))


def trip_groups(execution: DataFrame) -> DataFrame:
    """mart_line_trip_group_daily: directions and destinations of a line on a day, the most run first."""
    per = execution.where("trip_quality = 'complete'").groupBy("service_date", "mode", "line", "direction_id", "trip_headsign").agg(F.min("origin_stop_name").alias("origin_stop_name"), F.min("destination_stop_name").alias("destination_stop_name"), F.count(F.lit(1)).alias("trip_count"))
    w = Window.partitionBy("service_date", "mode", "line").orderBy(F.desc("trip_count"), "direction_id", F.col("trip_headsign").asc_nulls_first())
    return per.withColumn("display_rank", F.row_number().over(w))


def serving_days(windows_end: DataFrame, status: DataFrame) -> DataFrame:
    """dim_serving_date: dates with their neighbours, and the latest on which both modes are complete."""
    whole = status.groupBy("service_date").agg(F.countDistinct("mode").alias("n"), F.bool_and("is_complete_day").alias("ok")).where("n = 2 AND ok").agg(F.max("service_date").alias("latest"))
    w = Window.orderBy("service_date")
    out = windows_end.select("service_date").distinct().crossJoin(F.broadcast(whole))
    return out.select("service_date", F.lag("service_date").over(w).alias("previous_service_date"), F.lead("service_date").over(w).alias("next_service_date"), F.coalesce(F.col("service_date") == F.col("latest"), F.lit(False)).alias("is_latest"), F.row_number().over(Window.orderBy(F.desc("service_date"))).alias("service_date_rank_desc"))


def without_windows(kept: DataFrame, rebuilt: DataFrame, types: list[str]) -> DataFrame:
    """A partition of which only the windows in `types` were rebuilt; the others are carried over."""
    return rebuilt.where(F.col("window_type").isin(types)).unionByName(kept.where(~F.col("window_type").isin(types)))


def universe_evidence(universe: DataFrame, date: Column) -> DataFrame:
    """rpt_ranking_universe_evidence: how the trips of a date fall into the ranking universe."""
    u = universe.where(F.col("processing_date") == date)
    zone1 = F.col("non_zone1_stop_count") == 0
    return u.agg(F.count(F.lit(1)).alias("total_count"), F.count_if("is_public_service_segment").alias("public_service_count"), F.count_if("is_short_turn_part_trip").alias("short_turn_part_trip_count"), F.count_if(zone1).alias("zone1_only_count"), F.count_if("is_zone1_public_ranking_trip").alias("ranking_trip_count"))

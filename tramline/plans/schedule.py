"""Timetable tables: staged feeds, governing snapshots, trips by date, duty chains, versions and dimensions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions import local as L
from tramline.functions.columns import easter, gtfs_seconds

#: Reads a feed by name.
Feed = Callable[[str], DataFrame]
SNAP = "gtfs_snapshot_id"


def calendar_dates(feed: Feed) -> DataFrame:
    out = feed("raw_calendar_dates").where("CAST(exception_type AS int) = 1")
    day_type = F.when(F.dayofweek("date").isin(1, 7), "weekend").otherwise("weekday")
    return out.select("service_id", F.col("date").alias("service_date"), day_type.alias("day_type"), SNAP)


def routes(feed: Feed) -> DataFrame:
    mode = F.when(F.col("route_type") == 0, "tram").when(F.col("route_type") == 1, "metro").when(F.col("route_type") == 2, "rail").when(F.col("route_type") == 3, "bus").otherwise("unknown")
    return feed("raw_routes").select("route_id", "route_short_name", "route_type", mode.alias("mode"), SNAP)


def shapes(feed: Feed) -> DataFrame:
    out = feed("raw_shapes").select("shape_id", F.col("shape_pt_lat").try_cast("double").alias("lat"), F.col("shape_pt_lon").try_cast("double").alias("lon"), F.col("shape_pt_sequence").alias("seq"), SNAP)
    return out.where(L.in_area(F.col("lat"), F.col("lon")))


def polylines(feed: Feed) -> DataFrame:
    """Each shape's points in order, as arrays."""
    points = F.array_sort(F.collect_list(F.struct("seq", "lat", "lon")))
    per = shapes(feed).groupBy(SNAP, "shape_id").agg(points.alias("p"))
    return per.select(SNAP, "shape_id", F.col("p.lat").alias("lat"), F.col("p.lon").alias("lon"), F.size("p").alias("points"))


def stop_times(feed: Feed) -> DataFrame:
    kind = lambda c: F.coalesce(F.col(c).try_cast("int"), F.lit(0))
    out = feed("raw_stop_times").select("trip_id", "stop_id", "stop_sequence", gtfs_seconds(F.col("arrival_time")).alias("arrival_s"), gtfs_seconds(F.col("departure_time")).alias("departure_s"), kind("pickup_type").alias("pickup_type"), kind("drop_off_type").alias("drop_off_type"), SNAP, "gtfs_snapshot_date")
    service = F.when((F.col("pickup_type") == 1) & (F.col("drop_off_type") == 1), "not_in_passenger_service").when(F.col("pickup_type").isin(2, 3) | F.col("drop_off_type").isin(2, 3), "request").otherwise("regular")
    return out.withColumn("stop_service_class", service)


def stops(feed: Feed) -> DataFrame:
    out = feed("raw_stops").select(
        "stop_id", F.substring("stop_id", 1, 4).alias("stop_group_id"), L.stop_post_code(F.col("stop_id")).alias("stop_post_code"), "stop_name", "stop_code", F.col("stop_lat").try_cast("double").alias("stop_lat"),
        F.col("stop_lon").try_cast("double").alias("stop_lon"), "zone_id", F.when(F.col("zone_id") == "1+2", "1").otherwise(F.col("zone_id")).alias("effective_zone_id"), "stop_name_stem", "town_name", SNAP,
    )
    return out.where(L.in_area(F.col("stop_lat"), F.col("stop_lon")))


def bare_number(text: Column) -> Column:
    """Without zeros at its start; 0 for nothing else."""
    return F.coalesce(F.nullif(F.regexp_replace(text, "^0+", ""), F.lit("")), F.lit("0"))


def trips(feed: Feed) -> DataFrame:
    blank = lambda c: F.nullif(F.col(c), F.lit("")).alias(c)
    return feed("raw_trips").select("trip_id", F.col("route_id").alias("line"), "service_id", "trip_headsign", "direction_id", blank("block_id"), blank("block_short_name"), bare_number(F.col("block_short_name")).alias("brigade"), "shape_id", SNAP, "gtfs_snapshot_date")


def of_snapshots(df: DataFrame, ids: list[str]) -> DataFrame:
    """Rows of the snapshots by literal dates taken from the ids, which prune a table laid out by snapshot date."""
    days = sorted({i[:10] for i in ids})
    return df.where(F.col("gtfs_snapshot_date").isin(*[F.lit(d).cast("date") for d in days]) & F.col(SNAP).isin(*ids)) if days else df.where("false")


def processing_snapshots(feed: Feed) -> DataFrame:
    """processing_date, snapshot: the latest snapshot that covers a date and the one before."""
    days = calendar_dates(feed).select(SNAP, "service_date").distinct()
    before = days.select(SNAP, F.date_add("service_date", 1).alias("service_date"))
    covered = days.join(before, [SNAP, "service_date"])
    named = covered.join(F.broadcast(feed("raw_snapshots").select(F.col("snapshot_id").alias(SNAP), "snapshot_s")), SNAP)
    return named.groupBy(F.col("service_date").alias("processing_date")).agg(F.max(F.struct("snapshot_s", SNAP)).alias("x")).select("processing_date", f"x.{SNAP}", "x.snapshot_s")


def padded(number: str, width: int) -> Column:
    """The number with zeros before it up to a width, as %0<width>d writes it."""
    n = F.col(number)
    return F.when(n.between(0, 10**width - 1), F.lpad(n.cast("string"), width, "0")).otherwise(F.format_string(f"%0{width}d", n))


def trip_rows(feed: Feed) -> DataFrame:
    """One row for each trip of a snapshot: bounds, stops and timetable signature. Trips are folded once here, before
    any date multiplies them."""
    st = stop_times(feed)
    first, last = F.least("arrival_s", "departure_s"), F.greatest("arrival_s", "departure_s")
    sign = F.when(F.col("arrival_s").isNotNull(), F.concat(padded("stop_sequence", 6), F.lit(":"), "stop_id", F.lit(":"), padded("arrival_s", 8)))
    calls = F.array_sort(F.collect_list(F.struct("stop_sequence", "stop_id", F.col("arrival_s").cast("string").alias("a"), sign.alias("sign"))))
    per = st.groupBy("trip_id", SNAP).agg(F.min(first).cast("long").alias("trip_start_s"), F.max(last).cast("long").alias("trip_end_s"), F.count(F.lit(1)).alias("stop_count"), F.count_if(F.col("stop_service_class") != "not_in_passenger_service").alias("passenger_stop_count"), calls.alias("c"))
    listed = lambda f: F.nullif(F.array_join(F.array_compact(F.col(f"c.{f}")), " | "), F.lit(""))
    return per.select(SNAP, "trip_id", "trip_start_s", "trip_end_s", "stop_count", "passenger_stop_count", listed("stop_id").alias("ordered_stop_ids"), listed("a").alias("ordered_arrivals"), listed("sign").alias("trip_timetable_signature"), F.col("c.stop_id").alias("stops"))


def timetables(feed: Feed) -> DataFrame:
    """Trips with what trip_rows() says of them, a row each, before any date multiplies them."""
    return trips(feed).drop("gtfs_snapshot_date", "block_id", "block_short_name", "brigade").join(trip_rows(feed), ["trip_id", SNAP])


DATED = ["service_date", "processing_date", SNAP, "line", "direction_id"]


def service_days(feed: Feed, governed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The services that run on each processing date and the one before it, and the kind of day of each line's direction."""
    days = F.explode(F.array("processing_date", F.date_sub("processing_date", 1))).alias("service_date")
    wanted = F.broadcast(governed.select("processing_date", SNAP, days))
    active = calendar_dates(feed).join(wanted, [SNAP, "service_date"]).withColumn("class", L.schedule_class(F.col("service_id"))).drop("day_type")
    kinds = trips(feed).select(SNAP, "service_id", "line", "direction_id").distinct().join(F.broadcast(active), [SNAP, "service_id"])
    per = kinds.groupBy(*DATED).agg(L.one_class(F.array_sort(F.collect_set("class"))).alias("schedule_day_type"), F.array_join(F.array_sort(F.collect_set("service_id")), ", ").alias("schedule_service_ids"))
    return active.drop("class"), per


def trip_schedule(feed: Feed, governed: DataFrame, overlapping: bool, timed: DataFrame | None = None) -> DataFrame:
    """The trips of each processing date under its snapshot (`governed`: processing_date, snapshot), of the service
    dates D and D-1; `overlapping`: only those that run at some time of the local day D. `timed`: timetables() as stored."""
    active, per = service_days(feed, governed)
    timed = timetables(feed) if timed is None else timed
    # days of service are few: they multiply trips, already beside their calls, by broadcast
    out = timed.join(F.broadcast(active), [SNAP, "service_id"]).join(F.broadcast(per), DATED)
    first = [SNAP, "trip_id", "service_date", "processing_date", "line", "direction_id"]
    own = ["service_id", "trip_headsign", "shape_id"]
    rest = [*own, *per.columns, *timed.columns]
    out = out.select(*first, *[c for c in dict.fromkeys(rest) if c not in first])
    if overlapping:
        out = out.where((L.instant(F.col("service_date"), F.col("trip_end_s")) >= L.midnight(F.col("processing_date"))) & (L.instant(F.col("service_date"), F.col("trip_start_s")) < L.midnight(F.date_add("processing_date", 1))))
    return out.withColumn("is_public_service_segment", F.col("passenger_stop_count") > 0)


def duty_chains(feed: Feed, schedule: DataFrame) -> DataFrame:
    """Trips in the order in which a vehicle's duty runs them, with what lies between."""
    t = trips(feed).select(SNAP, "trip_id", "block_id", "brigade")
    s = schedule.drop("processing_date").dropDuplicates([SNAP, "service_date", "trip_id"]).join(t, [SNAP, "trip_id"])
    s = s.withColumns({"duty_chain_source_id": F.coalesce("block_id", F.concat("line", F.lit(":"), "brigade")), "duty_chain_source": F.when(F.col("block_id").isNotNull(), "block_id").otherwise("line_brigade")})
    names = stops(feed).select(SNAP, "stop_id", "stop_name")
    for end, at in (("origin", F.element_at("stops", 1)), ("destination", F.element_at("stops", -1))):
        s = s.withColumn(f"{end}_stop_id", at).join(names.select(SNAP, F.col("stop_id").alias(f"{end}_stop_id"), F.col("stop_name").alias(f"{end}_stop_name")), [SNAP, f"{end}_stop_id"], "left")
    depot = r"(?i)(^R-[0-9]+\s+Zajezdnia|^Zajezdnia|\sZajezdnia)"
    is_depot = lambda c: F.coalesce(F.col(c), F.lit("")).rlike(depot) & (F.col("passenger_stop_count") == 0)
    w = Window.partitionBy(SNAP, "service_date", "duty_chain_source", "duty_chain_source_id").orderBy("trip_start_s", "trip_end_s", "trip_id")
    before = lambda c: F.lag(c).over(w)
    s = s.withColumns({"trip_order": F.row_number().over(w), "previous_trip_id": before("trip_id"), "next_trip_id": F.lead("trip_id").over(w), "layover_from_previous_s": F.col("trip_start_s") - before("trip_end_s"), "layover_to_next_s": F.lead("trip_start_s").over(w) - F.col("trip_end_s"), "line_changed": F.coalesce(before("line") != F.col("line"), F.lit(False)), "overlaps_previous": F.coalesce(F.col("trip_start_s") < before("trip_end_s"), F.lit(False))})
    chain = F.md5(F.concat_ws("|", SNAP, F.col("service_date").cast("string"), "duty_chain_source", "duty_chain_source_id"))
    bad = F.col("overlaps_previous") | (F.col("trip_end_s") < F.col("trip_start_s")) | (F.col("stop_count") < 2)
    return s.select(
        SNAP, "service_date", "trip_id", chain.alias("duty_chain_id"), "duty_chain_source", "trip_order", "line", "direction_id", "origin_stop_id", "origin_stop_name", "destination_stop_id", "destination_stop_name", is_depot("origin_stop_name").alias("is_depot_pull_out"),
        is_depot("destination_stop_name").alias("is_depot_pull_in"), (~F.col("is_public_service_segment")).alias("is_depot_segment"), "previous_trip_id", "next_trip_id", "layover_from_previous_s", "layover_to_next_s", F.col("line_changed").alias("line_changed_from_previous"),
        F.col("overlaps_previous").alias("overlaps_previous_trip"), bad.alias("is_malformed_duty_segment"),
    )


def fingerprints(schedule: DataFrame) -> DataFrame:
    """An MD5 of a line's timetable for each processing date, direction and kind of day, and a marker row for each
    date, with or without lines."""
    at = lambda c: L.instant(F.col("service_date"), F.col(c))
    order = F.struct(at("trip_start_s").alias("a"), at("trip_end_s").alias("b"), F.col("trip_timetable_signature").alias("sign"))
    signs = F.array_compact(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["sign"]))
    key = ["processing_date", SNAP, "line", "direction_id", "schedule_day_type"]
    return schedule.groupBy(*key).agg(F.md5(F.array_join(signs, "\n")).alias("timetable_fingerprint"), F.count(F.lit(1)).alias("scheduled_trip_count"))


def service_fingerprints(feed: Feed, governed: DataFrame, timed: DataFrame) -> DataFrame:
    """fingerprints() of the history of `timed`, without a row for each trip and date: a direction's trips are collected
    once, by service, and each date takes the services that run on it."""
    place = [SNAP, "line", "direction_id"]
    active, per = service_days(feed, governed)
    days = F.broadcast(active).join(per, ["service_date", "processing_date", SNAP]).select(*place, "processing_date", "schedule_day_type", F.struct("service_id", L.instant(F.col("service_date"), F.lit(0)).alias("day_s")).alias("run"))
    days = days.groupBy(*place, "processing_date", "schedule_day_type").agg(F.collect_list("run").alias("runs"))
    mine = timed.select(*place, "service_id", "trip_start_s", "trip_end_s", F.col("trip_timetable_signature").alias("sign")).repartition(*place)
    lists = mine.groupBy(*place, "service_id").agg(F.collect_list(F.struct("trip_start_s", "trip_end_s", "sign")).alias("trips"))
    lists = lists.groupBy(*place).agg(F.map_from_entries(F.collect_list(F.struct("service_id", "trips"))).alias("services"))
    run = lambda r: F.transform(F.coalesce(F.try_element_at("services", r["service_id"]), F.array().cast(lists.schema["services"].dataType.valueType)), lambda t: F.struct((r["day_s"] + t["trip_start_s"]).alias("a"), (r["day_s"] + t["trip_end_s"]).alias("b"), t["sign"].alias("sign")))
    dated = lists.join(F.broadcast(days), place).select("processing_date", *place, "schedule_day_type", F.flatten(F.transform("runs", run)).alias("trips")).where(F.size("trips") > 0)
    signs = F.array_compact(F.transform(F.array_sort("trips"), lambda x: x["sign"]))
    return dated.select("processing_date", *place, "schedule_day_type", F.md5(F.array_join(signs, "\n")).alias("timetable_fingerprint"), F.size("trips").cast("long").alias("scheduled_trip_count"))


def with_markers(prints: DataFrame, governed: DataFrame) -> DataFrame:
    none = {f.name: F.lit(None).cast(f.dataType) for f in prints.schema.fields if f.name not in ("processing_date", SNAP)}
    markers = governed.select("processing_date", SNAP).withColumns(none).select(*prints.columns)
    return prints.withColumn("is_date_marker", F.lit(False)).unionByName(markers.withColumn("is_date_marker", F.lit(True)))


def ledger_difference(governed: DataFrame, ledger: DataFrame) -> DataFrame:
    """Dates whose snapshot the ledger doesn't hold, or holds another of, with the snapshot that should stand."""
    a = governed.select("processing_date", SNAP)
    b = ledger.where("is_date_marker").where(F.col(SNAP).isNotNull()).select("processing_date", F.col(SNAP).alias("recorded"))
    both = a.join(b, "processing_date", "full")
    return both.where(~F.col(SNAP).eqNullSafe(F.col("recorded"))).select("processing_date", SNAP)


def schedule_versions(prints: DataFrame) -> DataFrame:
    """Runs of one fingerprint for each line, direction and kind of day, with the dates on which they hold."""
    key = ["line", "direction_id", "schedule_day_type"]
    w = Window.partitionBy(*key).orderBy("processing_date", SNAP)
    new = F.coalesce(F.lag("timetable_fingerprint").over(w) != F.col("timetable_fingerprint"), F.lit(True))
    runs = prints.withColumn("new", new.cast("int")).withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    at = F.struct("processing_date", SNAP)
    per = runs.groupBy(*key, "timetable_fingerprint", "run").agg(F.min("processing_date").alias("valid_from_date"), F.min(at).alias("a"), F.max(at).alias("z"), F.max("scheduled_trip_count").alias("max_scheduled_trip_count"))
    after = F.lead("valid_from_date").over(Window.partitionBy(*key).orderBy("valid_from_date"))
    name = F.md5(F.concat_ws("|", "line", F.col("direction_id").cast("string"), "schedule_day_type", "timetable_fingerprint", F.col("valid_from_date").cast("string")))
    return per.select(name.alias("schedule_version_id"), *key, "timetable_fingerprint", "valid_from_date", F.date_sub(after, 1).alias("valid_to_date"), F.col(f"a.{SNAP}").alias("first_gtfs_snapshot_id"), F.col(f"z.{SNAP}").alias("last_gtfs_snapshot_id"), F.col("z.processing_date").alias("last_processing_date"), "max_scheduled_trip_count")


def governing_snapshots(feed: Feed) -> DataFrame:
    """The last snapshot of each local date governs from the next one."""
    s = feed("raw_snapshots").select(F.col("snapshot_id").alias(SNAP), "snapshot_s", F.date_add(L.local_date(F.col("snapshot_s")), 1).alias("valid_from_date"))
    return s.groupBy("valid_from_date").agg(F.max(F.struct("snapshot_s", SNAP)).alias("x")).select(f"x.{SNAP}", "x.snapshot_s", "valid_from_date")


def scd(feed: Feed, states: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """Ranges of equal attributes of an entity over the governing snapshots; a snapshot without it ends a range."""
    governing = F.broadcast(governing_snapshots(feed))
    spine = states.select(key).distinct().crossJoin(governing)
    shown = F.concat_ws("|", *[F.coalesce(F.col(a).cast("string"), F.lit("~")) for a in attributes])
    full = spine.join(states.withColumn("attribute_hash", F.md5(shown)), [key, SNAP], "left").withColumn("attribute_hash", F.coalesce("attribute_hash", F.lit("__missing__")))
    w = Window.partitionBy(key).orderBy("snapshot_s", SNAP)
    new = F.coalesce(F.lag("attribute_hash").over(w) != F.col("attribute_hash"), F.lit(True))
    runs = full.withColumn("new", new.cast("int")).withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    at = F.struct("snapshot_s", SNAP)
    per = runs.groupBy(key, "attribute_hash", "run", *attributes).agg(F.min("valid_from_date").alias("valid_from_date"), F.min(at).alias("a"), F.max(at).alias("z"))
    after = F.lead("valid_from_date").over(Window.partitionBy(key).orderBy("valid_from_date"))
    out = per.select(key, *attributes, "attribute_hash", "valid_from_date", F.date_sub(after, 1).alias("valid_to_date"), F.col(f"a.{SNAP}").alias("first_gtfs_snapshot_id"), F.col(f"z.{SNAP}").alias("last_gtfs_snapshot_id"))
    return out.where("attribute_hash <> '__missing__'")


def overlapping_ranges(ranges: DataFrame, key: str) -> DataFrame:
    """Ranges of an entity that start before an earlier one of it has ended: none, if all is well."""
    w = Window.partitionBy(key).orderBy("valid_from_date").rowsBetween(Window.unboundedPreceding, -1)
    ended = F.max(F.coalesce("valid_to_date", F.lit("9999-12-31").cast("date"))).over(w)
    return ranges.withColumn("ended", ended).where("valid_from_date <= ended").select(key, "valid_from_date")


def line_states(feed: Feed) -> DataFrame:
    return routes(feed).select(F.col("route_id").alias("line"), "route_short_name", "mode", F.col("mode").isin("bus", "tram").alias("has_live_gps"), SNAP)


def most_common_name(posts: DataFrame, key: list[str], name: str) -> DataFrame:
    per = posts.groupBy(*key, "stop_name").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(*key).agg(F.min(F.struct((-F.col("n")).alias("n"), "stop_name")).alias("x")).select(*key, F.col("x.stop_name").alias(name))


def _joined(c: str, sep: str = " | ") -> Column:
    return F.nullif(F.array_join(F.array_sort(F.collect_set(c)), sep), F.lit(""))


def group_states(posts: DataFrame) -> DataFrame:
    """Stop groups of a snapshot: the commonest name, lists of names and zones, centre and number of posts."""
    key = ["stop_group_id", SNAP]
    per = posts.groupBy(*key).agg(
        _joined("stop_name").alias("stop_group_names"), _joined("zone_id").alias("zone_ids"), _joined("effective_zone_id").alias("effective_zone_ids"), _joined("town_name").alias("town_names"),
        F.round(F.avg("stop_lat"), 6).alias("centroid_lat"), F.round(F.avg("stop_lon"), 6).alias("centroid_lon"), F.count(F.lit(1)).alias("stop_post_count"),
    )
    return per.join(most_common_name(posts, key, "stop_group_name"), key)


def line_current(feed: Feed, snapshot: str) -> DataFrame:
    t = of_snapshots(trips(feed), [snapshot]).where("trip_headsign IS NOT NULL")
    per = t.groupBy("line").agg(*[F.nullif(F.array_join(F.array_sort(F.collect_set(F.when(F.col("direction_id") == i, F.col("trip_headsign")))), " | "), F.lit("")).alias(f"direction_{i}_headsigns") for i in (0, 1)])
    r = routes(feed).where(F.col(SNAP) == snapshot).select(F.col("route_id").alias("line"), "mode", "route_short_name", F.col("mode").isin("bus", "tram").alias("has_live_gps"), SNAP)
    return r.join(per, "line", "left")


def post_current(feed: Feed, snapshot: str) -> DataFrame:
    t = of_snapshots(trips(feed), [snapshot]).select("trip_id", "line", "direction_id")
    served = of_snapshots(stop_times(feed), [snapshot]).select("trip_id", "stop_id").join(t, "trip_id").join(routes(feed).where(F.col(SNAP) == snapshot).select(F.col("route_id").alias("line"), "mode"), "line")
    served = served.select("stop_id", "line", "mode", F.col("direction_id").cast("string").alias("direction")).distinct()
    per = served.groupBy("stop_id").agg(*[_joined(c, ", ").alias(n) for c, n in (("line", "lines_served"), ("mode", "modes_served"), ("direction", "directions_served"))])
    out = stops(feed).where(F.col(SNAP) == snapshot).join(per, "stop_id", "left")
    return out.fillna("", ["lines_served", "modes_served", "directions_served"])


def group_current(feed: Feed, snapshot: str) -> DataFrame:
    posts = post_current(feed, snapshot)
    flat = posts
    lists = {}
    for c in ("lines_served", "modes_served", "directions_served"):
        one = posts.select("stop_group_id", F.explode(F.split(c, ", ")).alias("x")).where("x <> ''").distinct()
        lists[c] = one.groupBy("stop_group_id").agg(F.array_join(F.array_sort(F.collect_set("x")), ", ").alias(c))
    out = group_states(flat)
    for c, per in lists.items():
        out = out.join(per, "stop_group_id", "left").fillna("", [c])
    return out


def dates(feed: Feed) -> DataFrame:
    """Every date that the calendars span, with holidays."""
    ends = calendar_dates(feed).agg(F.min("service_date").alias("a"), F.max("service_date").alias("z"))
    d = ends.select(F.explode(F.sequence("a", "z")).alias("service_date"))
    y, on = F.year("service_date"), F.col("service_date")
    fixed = [(1, 1), (1, 6), (5, 1), (5, 3), (8, 15), (11, 1), (11, 11), (12, 25), (12, 26)]
    is_fixed = F.struct(F.month(on), F.dayofmonth(on)).isin(*[F.struct(F.lit(m), F.lit(x)) for m, x in fixed])
    eve = (F.month(on) == 12) & (F.dayofmonth(on) == 24) & (y >= 2025)
    moving = F.datediff(on, easter(y)).isin(0, 1, 49, 60)
    kind = F.when(F.dayofweek(on).isin(1, 7), "weekend").otherwise("weekday")
    return d.select("service_date", kind.alias("day_type"), (is_fixed | eve | moving).alias("is_holiday"), F.date_format(on, "EEEE").alias("weekday_name"), F.dayofweek(on).alias("day_of_week"), F.weekofyear(on).alias("iso_week"), F.month(on).alias("month"), y.alias("year"))


def schedule_dates(feed: Feed, snapshot: str) -> DataFrame:
    """Every date of a snapshot's calendar with its kind of day."""
    c = calendar_dates(feed).where(F.col(SNAP) == snapshot).withColumn("class", L.schedule_class(F.col("service_id")))
    classes = F.array_sort(F.collect_set("class"))
    per = c.groupBy("service_date").agg(L.one_class(classes).alias("schedule_day_type"), F.array_join(classes, ", ").alias("schedule_day_types"), F.array_join(F.array_sort(F.collect_set("service_id")), ", ").alias("schedule_service_ids"))
    spine = c.agg(F.min("service_date").alias("a"), F.max("service_date").alias("z")).select(F.explode(F.sequence("a", "z")).alias("service_date"))
    return spine.join(per, "service_date", "left").fillna({"schedule_day_type": "unknown", "schedule_day_types": "unknown", "schedule_service_ids": ""})


def stop_profiles(feed: Feed, schedule: DataFrame) -> DataFrame:
    """Each trip's stop list with the zones that it touches, for buses and trams."""
    modes = routes(feed).where(F.col("mode").isin("bus", "tram")).select(SNAP, F.col("route_id").alias("line"), "mode")
    zone = stops(feed).select(SNAP, "stop_id", "effective_zone_id")
    s = schedule.join(modes, [SNAP, "line"])
    # zones are a matter of the trip alone: looked up once for each trip, not for each date
    one = s.select(SNAP, "trip_id", "stops").dropDuplicates([SNAP, "trip_id"]).select(SNAP, "trip_id", F.explode("stops").alias("stop_id")).join(zone, [SNAP, "stop_id"], "left")
    z = F.coalesce("effective_zone_id", F.lit(""))
    zones = one.groupBy(SNAP, "trip_id").agg(F.count_if(z != "1").alias("non_zone1_stop_count"), F.array_sort(F.collect_set(z)).alias("zone_ids"))
    return s.join(zones, [SNAP, "trip_id"]).select("service_date", "processing_date", SNAP, "trip_id", "line", "mode", "direction_id", "schedule_day_type", "is_public_service_segment", F.element_at("stops", 1).alias("origin_stop_id"), F.element_at("stops", -1).alias("destination_stop_id"), "stop_count", F.array_join("stops", "|").alias("ordered_stop_ids"), "non_zone1_stop_count", "zone_ids")


def trip_universe(profiles: DataFrame, times: Column | None = None) -> DataFrame:
    """Profiles (rows of `times` trips) with the rank of their pair of terminals and whether a longer public trip of the same processing date, line, direction and
    kind of day holds the whole stop list in a row, which makes a trip outside the commonest pair a short turn.

    Whether one list holds another is decided on distinct lists: each deals out its runs of stops, as many as the
    square of its length, and shorter lists meet them by equality."""
    key = ["processing_date", SNAP, "line", "direction_id", "schedule_day_type"]
    ends = ["origin_stop_id", "destination_stop_id"]
    pairs = profiles.where("is_public_service_segment").groupBy(*key, *ends).agg((F.count(F.lit(1)) if times is None else F.sum(times)).alias("terminal_pair_trip_count"))
    w = Window.partitionBy(*key).orderBy(F.desc("terminal_pair_trip_count"), *ends)
    pairs = pairs.withColumn("terminal_pair_rank", F.row_number().over(w))
    lists = profiles.where("is_public_service_segment").select(*key, "ordered_stop_ids", "stop_count").distinct()
    parts = F.split("ordered_stop_ids", r"\|")
    n = F.col("stop_count").cast("int")
    runs = F.flatten(F.transform(F.sequence(F.lit(1), n - 1), lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.array_join(F.slice(parts, i, k), "|"))))
    inner = lists.where("stop_count > 1").select(*key, F.explode(F.array_distinct(runs)).alias("ordered_stop_ids")).distinct().withColumn("is_inner", F.lit(True))
    out = profiles.join(pairs, [*key, *ends], "left").join(inner, [*key, "ordered_stop_ids"], "left")
    rank = F.coalesce("terminal_pair_rank", F.lit(999999))
    short = F.coalesce("is_inner", F.lit(False)) & (rank > 1)
    ranked = F.col("is_public_service_segment") & ~short & (F.col("non_zone1_stop_count") == 0) & ~F.upper("line").startswith("C")
    return out.select(*profiles.columns, F.coalesce("terminal_pair_trip_count", F.lit(0)).alias("terminal_pair_trip_count"), rank.alias("terminal_pair_rank"), short.alias("is_short_turn_part_trip"), ranked.alias("is_zone1_public_ranking_trip"))


#: What the ranking of a trip depends on, besides the day.
LISTED = [SNAP, "line", "direction_id", "service_id", "ordered_stop_ids", "stop_count", "is_public_service_segment"]


def day_pair(processing: str, service: str) -> Column:
    """Both dates as one number."""
    return F.unix_date(processing).cast("long") * 1_000_000 + F.unix_date(service)


def ranked_days(feed: Feed, governed: DataFrame, timed: DataFrame) -> DataFrame:
    """Trips of `timed` that trip_universe() ranks on some day (trip_id, snapshot, ranked_days: pairs of processing and
    service date). Ranks are found for stop lists, of which a line's service has few, each with the number of its trips;
    trips take them by broadcast, and no row is made for a trip and date."""
    own = timed.withColumn("is_public_service_segment", F.col("passenger_stop_count") > 0).select("trip_id", *LISTED)
    lists = own.groupBy(*LISTED).agg(F.count(F.lit(1)).alias("n"))
    active, per = service_days(feed, governed)
    modes = routes(feed).where(F.col("mode").isin("bus", "tram")).select(SNAP, F.col("route_id").alias("line"))
    lists = lists.join(F.broadcast(modes), [SNAP, "line"]).withColumn("stops", F.split("ordered_stop_ids", r" \| "))
    zone = stops(feed).select(SNAP, "stop_id", "effective_zone_id")
    seen = lists.select(SNAP, "ordered_stop_ids", F.explode(F.array_distinct("stops")).alias("stop_id")).distinct().join(F.broadcast(zone), [SNAP, "stop_id"], "left")
    zones = seen.groupBy(SNAP, "ordered_stop_ids").agg(F.count_if(F.coalesce("effective_zone_id", F.lit("")) != "1").alias("far"))
    # stops without a name aren't listed and lie in no zone
    p = lists.join(zones, [SNAP, "ordered_stop_ids"]).withColumn("non_zone1_stop_count", F.col("far") + F.col("stop_count") - F.size("stops"))
    p = p.join(F.broadcast(active), [SNAP, "service_id"]).join(F.broadcast(per), DATED)
    p = p.select(*DATED, "schedule_day_type", "service_id", F.col("ordered_stop_ids").alias("listed"), F.array_join("stops", "|").alias("ordered_stop_ids"), F.element_at("stops", 1).alias("origin_stop_id"), F.element_at("stops", -1).alias("destination_stop_id"), "stop_count", "is_public_service_segment", "non_zone1_stop_count", "n")
    u = trip_universe(p, F.col("n")).where("is_zone1_public_ranking_trip").withColumn("ordered_stop_ids", F.col("listed"))
    days = u.groupBy(*LISTED).agg(F.collect_set(day_pair("processing_date", "service_date")).alias("ranked_days"))
    got = own.join(F.broadcast(days), LISTED).select("trip_id", SNAP, "ranked_days")
    return got.groupBy("trip_id", SNAP).agg(F.flatten(F.collect_list("ranked_days")).alias("ranked_days"))

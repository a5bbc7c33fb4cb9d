"""Journeys over one day's timetable: patterns of calls, lower bounds, and a search in rounds of one vehicle each.

A network is a table of calls (trip_id, pos, stop_id, dep_s, arr_s, may_board, may_alight) and one of walks (from_stop_id,
to_stop_id, walk_s). Requests are rows too, so that a batch of them is searched by the same joins; nothing is collected.
Each round's labels are written, since the next round reads them several times and a lost executor must not cost more
than its round. Tables without rows give no journeys; ties keep one label, as only times are told apart; a stop that
no call names is reached by walks alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A journey takes at most so long.
MOST_S = 3 * 3600
#: Rides that a journey may have.
VEHICLES = 5
#: A late ride against the usual one where nothing is calibrated.
DEFAULT_RATIO = 1.1


def late_ride(ride: Column, cells: list[tuple[float, float, float]], default: float = DEFAULT_RATIO) -> Column:
    """A late ride's seconds by cells (over, up to, ratio). It never falls as the ride grows: at a cell's start it is at
    least what the cell before ended with, also over gaps between cells."""
    steps, end, high = [], 0.0, 0.0
    for lower, upper, ratio in sorted(cells):
        if lower > end:
            steps.append((lower, default, high))
            high = max(high, lower * default)
        steps.append((upper, max(1.0, ratio), high))
        high, end = max(high, upper * max(1.0, ratio)), upper
    out = F.greatest(F.lit(high), ride * default)
    for upper, ratio, floor in reversed(steps):
        out = F.when(ride <= upper, F.greatest(F.lit(floor), ride * ratio)).otherwise(out)
    return out


def patterns(calls: DataFrame) -> DataFrame:
    """Trips by their order of stops and where one may alight: pattern, stops, trips, first departure."""
    one = F.concat("stop_id", F.when(F.col("may_alight"), "").otherwise("!"))
    per = calls.withColumn("call", one).groupBy("trip_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "call"))), lambda x: x["call"]), ">").alias("pattern"), F.count(F.lit(1)).alias("stops"), F.min("dep_s").alias("starts_s"))
    return per.groupBy("pattern", "stops").agg(F.count(F.lit(1)).alias("trips"), F.min("starts_s").alias("first_s"))


def shortest_edges(calls: DataFrame, walks: DataFrame) -> DataFrame:
    """The shortest ride or walk from a stop to the next (from_stop_id, to_stop_id, s)."""
    from pyspark.sql import Window

    w = Window.partitionBy("trip_id").orderBy("pos")
    rides = calls.select(F.lag("stop_id").over(w).alias("from_stop_id"), F.col("stop_id").alias("to_stop_id"), F.greatest(F.lit(0), F.col("arr_s") - F.lag("dep_s").over(w)).alias("s")).where("from_stop_id IS NOT NULL")
    return rides.unionByName(walks.select("from_stop_id", "to_stop_id", F.col("walk_s").alias("s"))).groupBy("from_stop_id", "to_stop_id").agg(F.min("s").cast("long").alias("s"))


def lower_bounds(edges: DataFrame, targets: DataFrame, kept: Callable[[str, DataFrame], DataFrame], most: int = MOST_S) -> DataFrame:
    """Seconds from each stop to each target (target) without waiting, up to `most`: (target, stop_id, s).

    Backwards from the targets; a round extends only labels that the one before made better, until there are none."""
    best = kept("bound_0", targets.select("target", F.col("target").alias("stop_id"), F.lit(0).cast("long").alias("s")))
    fresh, n = best, 0
    while not fresh.isEmpty():
        n += 1
        step = fresh.join(edges.withColumnRenamed("s", "edge"), fresh["stop_id"] == edges["to_stop_id"]).select("target", F.col("from_stop_id").alias("stop_id"), (F.col("s") + F.col("edge")).alias("s")).where(F.col("s") <= most)
        both = best.withColumn("old", F.lit(True)).unionByName(step.withColumn("old", F.lit(False)))
        both = both.groupBy("target", "stop_id").agg(F.min("s").alias("s"), F.min(F.when(F.col("old"), F.col("s"))).alias("was"))
        both = kept(f"bound_{n}", both)
        best, fresh = both.select("target", "stop_id", "s"), both.where("was IS NULL OR s < was").select("target", "stop_id", "s")
    return best


def ride(frontier: DataFrame, calls: DataFrame, late: Callable[[Column], Column]) -> DataFrame:
    """Where one vehicle takes each label (request, until_s, stop_id, t): late arrivals at all later stops of all trips
    that leave there from t on and before the request's end; overtaking trips count like any other."""
    at = calls.where("may_board").select("trip_id", F.col("pos").alias("b_pos"), "stop_id", F.col("dep_s").alias("b_dep"))
    boarded = frontier.join(at, "stop_id").where((F.col("b_dep") >= F.col("t")) & (F.col("b_dep") < F.col("until_s"))).select("request", "until_s", "trip_id", "b_pos", "b_dep").distinct()
    to = calls.where("may_alight").select("trip_id", "pos", "stop_id", "arr_s")
    j = boarded.join(to, "trip_id").where(F.col("pos") > F.col("b_pos"))
    arrival = F.greatest(F.ceil(F.col("b_dep") + late(F.greatest(F.lit(0), F.col("arr_s") - F.col("b_dep")))), F.col("arr_s"), F.col("b_dep")).cast("long")
    return j.select("request", "until_s", "stop_id", arrival.alias("t")).where("t < until_s").groupBy("request", "until_s", "stop_id").agg(F.min("t").alias("t"))


def walk(labels: DataFrame, walks: DataFrame) -> DataFrame:
    j = labels.withColumnRenamed("stop_id", "from_stop_id").join(walks, "from_stop_id")
    return j.select("request", "until_s", F.col("to_stop_id").alias("stop_id"), (F.col("t") + F.col("walk_s")).cast("long").alias("t")).where("t < until_s")


def better(labels: DataFrame, best: DataFrame) -> DataFrame:
    """Labels, one a stop, that arrive before all of `best`."""
    b = best.groupBy("request", "stop_id").agg(F.min("t").alias("was"))
    least = labels.groupBy("request", "until_s", "stop_id").agg(F.min("t").alias("t"))
    return least.join(b, ["request", "stop_id"], "left").where("was IS NULL OR t < was").drop("was")


def search(requests: DataFrame, calls: DataFrame, walks: DataFrame, kept: Callable[[str, DataFrame], DataFrame], late: Callable[[Column], Column], vehicles: int = VEHICLES, most: int = MOST_S) -> DataFrame:
    """Late arrivals at every stop that each request (request, stop_id, depart_s) reaches, by the number of vehicles,
    where a further one arrives earlier: (request, stop_id, vehicles, t). Walks follow the start or a ride, never a walk.

    A round is two equi-joins (calls of a stop, calls of a trip) and an aggregate by request and stop. Labels are at most
    requests x stops; a hot stop's calls are bounded by a day's timetable."""
    start = requests.select("request", (F.col("depart_s") + most).cast("long").alias("until_s"), "stop_id", F.col("depart_s").cast("long").alias("t"))
    reached = kept("reached_0", start.unionByName(walk(start, walks)).groupBy("request", "until_s", "stop_id").agg(F.min("t").alias("t")))
    best, rides, found = reached, start.limit(0), None
    for n in range(1, vehicles + 1):
        rode = kept(f"rode_{n}", better(ride(reached, calls, late), rides))
        rides = rides.unionByName(rode)
        reached = kept(f"reached_{n}", better(rode.unionByName(walk(rode, walks)), best))
        best = best.unionByName(reached)
        one = reached.select("request", "stop_id", F.lit(n).alias("vehicles"), "t")
        found = one if found is None else found.unionByName(one)
    return found


def undominated(journeys: DataFrame) -> DataFrame:
    """Journeys (request, stop_id, depart_s, t, vehicles) that no other equals or beats in all three and beats in one.

    By the number of vehicles, latest departure first, a journey must arrive before all that use no more vehicles and
    leave no earlier: running minima, so no journey meets another."""
    from pyspark.sql import Window

    j = journeys.select("request", "stop_id", "depart_s", "t", "vehicles").distinct()
    w = Window.partitionBy("request", "stop_id").orderBy(F.desc("depart_s"), "t", "vehicles")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    counts = [F.min(F.when(F.col("vehicles") <= v, F.col("t"))).over(before) for v in range(1, VEHICLES + 1)]
    limit = F.element_at(F.array(*counts), F.col("vehicles").cast("int"))
    return j.withColumn("limit", limit).where("limit IS NULL OR t < limit").drop("limit")

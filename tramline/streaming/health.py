"""Feed health on streams: exact minute counters with late data, and incidents that carry their state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tramline.operators.relational import islands


def minute_counters(pings: DataFrame, late: str = "5 minutes") -> DataFrame:
    """Accepted pings and distinct vehicles of each minute and mode, counted exactly. On a stream each vehicle's pings of a
    minute are folded first, so the state holds one row for each; both steps drop what comes later than `late`, and a
    minute is emitted once the watermark has passed it."""
    if pings.isStreaming:
        pings = pings.withWatermark("gps_time", late)
    per = pings.groupBy(F.window("gps_time", "1 minute").alias("w"), "mode", "vehicle").agg(F.count(F.lit(1)).alias("n"))
    # the second window keeps the event time that the first one has
    again = per.groupBy(F.window(F.window_time("w"), "1 minute").alias("w"), "mode")
    return again.agg(F.sum("n").alias("accepted"), F.count(F.lit(1)).alias("vehicles")).select(F.col("w.start").alias("minute"), "mode", "accepted", "vehicles")


def sliding_fleet(pings: DataFrame, unit: str = "HOUR", width: int = 5) -> DataFrame:
    """Distinct vehicles with a ping in the `width` units up to each unit."""
    at = F.date_trunc(unit, F.col("gps_time").cast("timestamp")).cast("timestamp_ntz")
    one = pings.select("mode", "vehicle", at.alias("at")).distinct()
    spread = one.select("mode", "vehicle", F.explode(F.array(*[F.timestamp_add(unit, F.lit(i), F.col("at")) for i in range(width)])).alias("at"))
    return spread.distinct().groupBy("mode", "at").agg(F.count(F.lit(1)).alias("fleet"))


def incidents(series: DataFrame, keys: list[str], at: str, bad: str, least: int) -> DataFrame:
    """Runs of at least `least` bad points in a row: keys, opened (first bad point), closed (first good one after,
    null while open), points."""
    w = Window.partitionBy(*keys).orderBy(at)
    runs = islands(series.withColumn("__was", F.lag(bad).over(w)), keys, [at], F.col("__was") != F.col(bad))
    per = runs.groupBy(*keys, "island").agg(F.min(at).alias("opened"), F.count(F.lit(1)).alias("points"), F.first(bad).alias("__bad"))
    per = per.withColumn("closed", F.lead("opened").over(Window.partitionBy(*keys).orderBy("opened")))
    return per.where((F.col("__bad")) & (F.col("points") >= least)).select(*keys, "opened", "closed", "points")


def step(state: tuple, at: int, bad: bool, need: int) -> tuple[tuple, list[tuple]]:
    """One minute of one mode. State: (active since or 0, last minute, kind of the row: 1 bad, 0 good, its start, its length).
    Events: (transition, at)."""
    active, last, kind, start, size = state
    if at <= last:  # seen already
        return state, []
    fresh = at != last + 60 or kind != int(bad)
    kind, start, size = int(bad), at if fresh else start, 1 if fresh else size + 1
    events = []
    if kind and not active and size >= need:
        active = start
        events.append(("degraded", start))
    elif not kind and active and size >= need:
        active = 0
        events.append(("recovered", start))
    return (active, at, kind, start, size), events


def incident_events(minutes: DataFrame, need: int = 15) -> DataFrame:
    """mode, transition, at_s of a stream of minutes (mode, at_s, is_bad): an incident opens with `need` bad minutes in a
    row and closes with as many good ones; a missing minute breaks a row. The state of a mode is five numbers. Minutes
    of one batch are put in order; ones that come after a later batch are passed over."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.get if state.exists else (0, -1, 0, 0, 0)
        rows, events = pd.concat(list(frames)), []
        for at, bad in rows.sort_values("at_s")[["at_s", "is_bad"]].itertuples(index=False):
            now, more = step(now, int(at), bool(bad), need)
            events += more
        state.update(now)
        yield pd.DataFrame({"mode": [key[0]] * len(events), "transition": [e for e, _ in events], "at_s": [t for _, t in events]})

    return minutes.groupBy("mode").applyInPandasWithState(run, "mode string, transition string, at_s long", "active long, last long, kind long, start long, size long", "append", GroupStateTimeout.NoTimeout)

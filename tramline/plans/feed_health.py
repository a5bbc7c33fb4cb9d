"""Health of the feed: what was dropped, what is usual, which minutes are bad, and incidents made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tramline.functions import local as L

#: Oldest and newest ping accepted (seconds), comparable days, how far back, least samples, threshold of
#: the usual fleet, least fleet to judge, minutes that open and close an incident.
MAX_AGE, MAX_FUTURE, SAMPLES, LOOKBACK, LEAST_SAMPLES, THRESHOLD, LEAST_FLEET, MINUTES = 300, 60, 4, 28, 3, 0.5, 20, 15


def freshness(pings: DataFrame) -> DataFrame:
    """Pings accepted, stale and from the future, by mode and minute of receipt."""
    t, now = F.col("time_s"), F.col("ingested_s")
    stale, future = t < now - MAX_AGE, t > now + MAX_FUTURE
    return pings.groupBy("vehicle_type", (now - F.pmod(now, F.lit(60))).alias("minute_s")).agg(F.count(F.lit(1)).alias("parsed"), F.count_if(~stale & ~future).alias("accepted"), F.count_if(stale).alias("dropped_stale"), F.count_if(future).alias("dropped_future"))


def local_instant(naive: Column, received: Column) -> Column:
    """The instant of a wall-clock time (timestamp_ntz) that is nearest to its receipt: of both readings in the hour that
    clocks repeat, null in the hour that they skip."""
    reading = lambda hours: F.unix_seconds(F.timestamp_add("HOUR", F.lit(-hours), naive).cast("timestamp"))
    real = F.filter(F.array(reading(1), reading(2)), lambda x: L.wall(x).cast("timestamp_ntz") == naive)
    return F.array_min(F.transform(real, lambda x: F.struct(F.abs(x - received).alias("off"), x.alias("at"))))["at"]


def day_class(date: Column) -> Column:
    return F.when(F.dayofweek(date) == 1, "sunday").when(F.dayofweek(date) == 7, "saturday").otherwise("weekday")


def comparable_days(dates: DataFrame) -> DataFrame:
    """day, other: the last four days of the same class within four weeks before a day. Dates are few."""
    a = dates.select(F.col("day"), day_class(F.col("day")).alias("class"))
    b = F.broadcast(dates.select(F.col("day").alias("other"), day_class(F.col("day")).alias("class")))
    gap = F.datediff("day", "other")
    w = Window.partitionBy("day").orderBy(F.desc("other"))
    return a.join(b, "class").where(gap.between(1, LOOKBACK)).withColumn("place", F.row_number().over(w)).where(F.col("place") <= SAMPLES).select("day", "other")


def _median(a: Column) -> Column:
    s, n = F.array_sort(a), F.size(a)
    at = lambda i: F.element_at(s, i.cast("int"))
    return (at(F.floor((n + 1) / 2)) + at(F.floor(n / 2) + 1)) / 2


def baseline(minutes: DataFrame) -> DataFrame:
    """The usual fleet of each minute from the same local minute of the comparable days: median, least and greatest of
    the days with at least half the median; null below three samples."""
    wall = L.wall(F.col("at_s"))
    m = minutes.select("mode", "at_s", F.to_date(wall).alias("day"), F.date_format(wall, "HH:mm").alias("clock"), "attempts", "successes", "vehicles")
    per = m.where(F.col("successes") >= F.col("attempts") * THRESHOLD).groupBy("mode", "day", "clock").agg(F.percentile("vehicles", 0.5).alias("v"))
    days = comparable_days(m.select("day").distinct())
    seen = days.join(per.withColumnRenamed("day", "other"), "other").groupBy("mode", "day", "clock").agg(F.collect_list("v").alias("vs"))
    typical = _median(F.col("vs"))
    seen = seen.where(F.size("vs") >= LEAST_SAMPLES).withColumn("typical", typical)
    kept = F.filter("vs", lambda x: x >= F.col("typical") * THRESHOLD)
    seen = seen.withColumn("kept", F.when(F.size(kept) > 0, kept).otherwise(F.col("vs")))
    seen = seen.select("mode", "day", "clock", F.size("vs").alias("samples"), F.round(_median(F.col("kept")), 1).alias("usual"), F.round(F.array_min("kept"), 1).alias("low"), F.round(F.array_max("kept"), 1).alias("high"))
    return m.join(seen, ["mode", "day", "clock"], "left").fillna(0, ["samples"])


def judged(based: DataFrame) -> DataFrame:
    """Why a minute is bad: the interface failed, or a fleet that is usually there is absent or under half."""
    counts = F.coalesce(F.col("usual") >= LEAST_FLEET, F.lit(False))
    bad = F.when((F.col("attempts") == 0) | (F.col("successes") / F.col("attempts") < THRESHOLD), "api_failures").when(counts & (F.col("vehicles") == 0), "no_accepted").when(counts & (F.col("vehicles") < THRESHOLD * F.col("usual")), "low_fleet")
    return based.withColumn("bad_reason", bad)


def incidents(minutes: DataFrame, at: str = "at_s", bad: str = "is_bad", need: int = MINUTES, step: int = 60) -> DataFrame:
    """mode, start_s, end_s (null while open): `need` bad minutes in a row open an incident at the first of them, as many
    good ones close it at their first. A minute that is missing breaks a row and neither opens nor closes."""
    w = Window.partitionBy("mode").orderBy(at)
    new = F.coalesce((F.col(bad) != F.lag(bad).over(w)) | (F.col(at) - F.lag(at).over(w) != step), F.lit(True)).cast("int")
    r = minutes.withColumn("new", new).withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    r = r.groupBy("mode", "run", bad).agg(F.min(at).alias("start_s"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= need)
    # long rows alone change the state: an incident opens where one is bad and the one before it isn't
    v = Window.partitionBy("mode").orderBy("start_s")
    turns = r.withColumn("was", F.lag(bad).over(v)).where(F.col("was").isNull() | (F.col("was") != F.col(bad)))
    turns = turns.withColumn("end_s", F.lead("start_s").over(v))
    return turns.where(F.col(bad)).select("mode", "start_s", "end_s")


def hour_status(based: DataFrame, incident: DataFrame) -> DataFrame:
    """Each mode and hour: degraded while an incident is open, a gap if minutes are missing, warming up without a
    baseline, else healthy. An incident goes to each hour that it touches."""
    h = based.groupBy("mode", L.whole_hour(F.col("at_s")).alias("hour_s")).agg(F.count(F.lit(1)).alias("monitored_minutes"), F.max("samples").alias("baseline_samples"), F.sum("vehicles").alias("vehicle_minutes"))
    ends = based.groupBy("mode").agg(F.max("at_s").alias("last_s"))
    i = incident.join(ends, "mode").withColumn("until", F.coalesce("end_s", F.col("last_s") + 60))
    hours = F.explode(F.sequence(L.whole_hour(F.col("start_s")), L.whole_hour(F.col("until") - 1), F.lit(3600))).alias("hour_s")
    i = i.select("mode", hours).distinct().withColumn("open", F.lit(True))
    status = F.when(F.col("open"), "degraded").when(F.col("monitored_minutes") < 60, "monitoring_gap").when(F.col("baseline_samples") == 0, "warming_up").otherwise("healthy")
    return h.join(i, ["mode", "hour_s"], "left").withColumn("status", status).drop("open")


def day_status(hours: DataFrame) -> DataFrame:
    """mart_poller_daily_health."""
    d = hours.groupBy(L.local_date(F.col("hour_s")).alias("gps_date"), "mode").agg(F.count(F.lit(1)).alias("evaluated_hours"), F.sum("monitored_minutes").alias("monitored_minutes"), *[F.count_if(F.col("status") == s).alias(f"{s}_hours") for s in ("degraded", "monitoring_gap", "warming_up", "healthy")], F.count_if(F.col("baseline_samples") >= LEAST_SAMPLES).alias("hours_with_comparable_history"))
    pick = F.when(F.col("degraded_hours") > 0, "degraded").when(F.col("monitoring_gap_hours") > 0, "monitoring_gap").when(F.col("warming_up_hours") > 0, "warming_up").when(F.col("healthy_hours") > 0, "healthy").otherwise("not_monitored")
    return d.withColumn("status", pick)


def outbox(incident: DataFrame) -> DataFrame:
    """Alerts to send, once each: the id is a hash of what an alert says, so a repeated evaluation adds none."""
    each = F.array(F.struct(F.lit("degraded").alias("transition"), F.col("start_s").alias("at_s")), F.struct(F.lit("recovered").alias("transition"), F.col("end_s").alias("at_s")))
    e = incident.select("mode", F.inline(each)).where("at_s IS NOT NULL")
    return e.withColumn("event_id", F.sha2(F.concat_ws("|", "mode", "transition", F.col("at_s").cast("string")), 256)).dropDuplicates(["event_id"])


def planned_scale(chain: DataFrame) -> DataFrame:
    """A date's duties against the median of its class of days."""
    per = chain.groupBy("service_date").agg(F.countDistinct("duty_chain_id").alias("blocks")).withColumn("class", day_class(F.col("service_date")))
    mid = per.groupBy("class").agg(F.percentile("blocks", 0.5).alias("usual"))
    return per.join(F.broadcast(mid), "class").withColumn("scale", F.col("blocks") / F.col("usual"))


def mode_state(based: DataFrame, now: int) -> DataFrame:
    """What a rider is told now: silent for three minutes, failing after three failed ones, thin under half, normal."""
    w = Window.partitionBy("mode").orderBy(F.desc("at_s"))
    last = based.where(F.col("at_s") <= now).withColumn("place", F.row_number().over(w)).where(F.col("place") <= 3)
    per = last.groupBy("mode").agg(F.max("at_s").alias("last_s"), F.count_if(F.col("successes") < F.col("attempts") * THRESHOLD).alias("failed"), F.max_by("vehicles", "at_s").alias("vehicles"), F.max_by("usual", "at_s").alias("usual"))
    state = F.when(F.lit(now) - F.col("last_s") > 180, "silent").when(F.col("failed") >= 3, "failing").when(F.col("vehicles") < THRESHOLD * F.col("usual"), "thin").otherwise("normal")
    return per.withColumn("state", state)

"""Generic operators: each takes and returns frames, and leaves the physical plan to Catalyst."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row for each key, the first in `order`, which has to be total."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, name: str = "position") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def islands(df: DataFrame, keys: Sequence[str], order: Sequence[str], breaks: Column, name: str = "island") -> DataFrame:
    """Numbers the runs of rows of a key: a new one starts where `breaks` holds (null: it doesn't) and at the first row."""
    w = Window.partitionBy(*keys).orderBy(*order)
    first = F.row_number().over(w) == 1
    flagged = df.withColumn("__new", F.when(first | F.coalesce(breaks, F.lit(False)), 1).otherwise(0))
    return flagged.withColumn(name, F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def versions(daily: DataFrame, keys: Sequence[str], date: str, state: str) -> DataFrame:
    """Gaps and islands: keys, state, valid_from, valid_to (null for the open one). A state that returns opens a new
    version; valid_to is the day before the next one."""
    w = Window.partitionBy(*keys).orderBy(date)
    runs = islands(daily.withColumn("__was", F.lag(state).over(w)), keys, [date], ~F.col("__was").eqNullSafe(F.col(state)))
    per = runs.groupBy(*keys, "island").agg(F.min(date).alias("valid_from"), F.first(state).alias(state))
    after = F.lead("valid_from").over(Window.partitionBy(*keys).orderBy("valid_from"))
    return per.select(*keys, state, "valid_from", F.date_sub(after, 1).alias("valid_to"))


def scd2(daily: DataFrame, spine: DataFrame, keys: Sequence[str], date: str, state: str) -> DataFrame:
    """versions() over every date of `spine`: a date without a row of a known key closes its range, and the gap
    itself isn't returned."""
    every = daily.select(*keys).distinct().join(F.broadcast(spine.select(date).distinct()), how="cross")
    full = every.join(daily, [*keys, date], "left").withColumn(state, F.coalesce(F.col(state), F.lit("__missing__")))
    return versions(full, keys, date, state).where(F.col(state) != "__missing__")


def fan_out(df: DataFrame, entities: dict[str, Column]) -> DataFrame:
    """A row for each entity type of each row, so that one aggregation serves them all."""
    each = F.array(*[F.struct(F.lit(k).alias("entity_type"), c.cast("string").alias("entity_id")) for k, c in entities.items()])
    return df.select("*", F.inline(each))


def dense(df: DataFrame, spine: DataFrame, on: Sequence[str], fill: dict) -> DataFrame:
    return spine.join(df, list(on), "left").fillna(fill)


def grid_join(left: DataFrame, right: DataFrame, x: str, y: str, radius: float) -> DataFrame:
    """Pairs within `radius` in the plane: cells of that size meet by equality, the neighbours of one side are dealt
    out, and the distance decides. Right columns come with the prefix r_."""
    cell = lambda c: F.floor(F.col(c) / radius).cast("long")
    near = F.explode(F.sequence(F.lit(-1), F.lit(1)))
    a = left.withColumn("__cx", cell(x)).withColumn("__cy", cell(y))
    b = right.select(*[F.col(c).alias(f"r_{c}") for c in right.columns])
    b = b.withColumn("__dx", near).withColumn("__dy", near).withColumn("__cx", cell(f"r_{x}") + F.col("__dx")).withColumn("__cy", cell(f"r_{y}") + F.col("__dy"))
    dist = F.sqrt(F.pow(F.col(x) - F.col(f"r_{x}"), 2) + F.pow(F.col(y) - F.col(f"r_{y}"), 2))
    return a.join(b, ["__cx", "__cy"]).withColumn("distance", dist).where(F.col("distance") <= radius).drop("__cx", "__cy", "__dx", "__dy")


def fallback(df: DataFrame, value: str, levels: Sequence[Sequence[str]], least: int, name: str) -> DataFrame:
    """The mean of the finest level that has at least `least` rows, and its number; the last level always counts. Each
    level holds the next one's keys, so that rows are read and grouped once, by the first, and rolled up from there."""
    out, picks = df, []
    sums = df.groupBy(*levels[0]).agg(F.sum(value).alias("__s"), F.count(value).alias("__c"))
    for i, keys in enumerate(levels):
        need = least if i < len(levels) - 1 else 1
        sums = sums if i == 0 else sums.groupBy(*keys).agg(F.sum("__s").alias("__s"), F.sum("__c").alias("__c"))
        per = sums.where(F.col("__c") >= need).select(*keys, (F.col("__s") / F.col("__c")).alias(f"__m{i}"))
        out = out.join(per, list(keys), "left") if keys else out.join(F.broadcast(per), how="cross")
        picks.append(F.when(F.col(f"__m{i}").isNotNull(), F.struct(F.col(f"__m{i}").alias("m"), F.lit(i).alias("level"))))
    best = F.coalesce(*picks)
    return out.withColumn(name, best["m"]).withColumn("level", best["level"]).drop(*[f"__m{i}" for i in range(len(levels))])


def overlay(base: DataFrame, newer: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newer rows, and those of the base whose key has none."""
    return base.join(newer.select(*keys).distinct(), list(keys), "left_anti").unionByName(newer)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that more than one row has, with their rows' number."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")

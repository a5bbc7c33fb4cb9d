"""Readers, and the adapter that gives the general tables their transit roles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle positions from `events`: vehicle, mode, gps_time, ingested_at, lat, lon."""
    ts = F.col("ts").cast("timestamp_ntz")
    mode = F.when(F.col("user_id") % 2 == 0, "bus").otherwise("tram")
    return table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("vehicle"), mode.alias("mode"), ts.alias("gps_time"), F.timestamp_add("SECOND", F.col("event_id"), ts).alias("ingested_at"), (F.lit(52.0) + F.col("value") / 1000).alias("lat"), (F.lit(21.0) + F.col("value") / 2000).alias("lon"))


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop arrivals from `events`: line, stop, mode, vehicle, service_date, hour, delay (null for some)."""
    mode = F.when(F.col("user_id") % 2 == 0, "bus").otherwise("tram")
    return table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), (F.col("user_id") % 20).alias("line"), F.col("event_type").alias("stop"), mode.alias("mode"), F.col("user_id").alias("vehicle"), F.to_date("ts").alias("service_date"), F.hour("ts").alias("hour"), F.when(F.col("event_id") % 50 != 7, F.round(F.col("value") * 6 - 150).cast("int")).alias("delay"))


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stop calls from `lineitem`, one for each (trip, sequence): the first by part, supplier and price."""
    from tramline.operators.relational import latest

    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("trip"), F.col("l_linenumber").alias("seq"), F.col("l_suppkey").alias("stop"), F.col("l_quantity").alias("ride"), F.col("l_shipdate").cast("timestamp_ntz").alias("actual"), "l_partkey", "l_extendedprice", "l_discount", "l_tax")
    order = ["stop", "l_partkey", "l_extendedprice", "l_discount", "l_tax", "ride", "actual"]
    return latest(li, ["trip", "seq"], [F.col(c) for c in order]).select("trip", "seq", "stop", "ride", "actual")

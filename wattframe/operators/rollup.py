"""Readings to hours, hours to days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe import schemas as S
from wattframe.functions import Instant, floor_hour, mean_rounded, trailing_cutoff


def trailing(df: DataFrame, time: str, as_of: Instant | None, lookback: str | None,
             aligned: bool, bucket: str) -> DataFrame:
    """Rows of the lookback window; ``aligned`` widens it to whole buckets.

    Unaligned, the oldest bucket is cut through, and a later upsert would
    replace a whole bucket by its rest.  Rows that still carry the hour their
    deltas were computed by are bounded by it as well, which, unlike a bound on
    the time, may pass below that computation down to the scan.
    """
    if lookback is None:
        return df
    if time != "hour_start" and "hour_start" in df.columns:
        df = df.filter(F.col("hour_start") >= trailing_cutoff(as_of, lookback, "hour"))
    if aligned:
        return df.filter(F.col(time) >= trailing_cutoff(as_of, lookback, bucket))
    return df.filter(F.col(time) > trailing_cutoff(as_of, lookback))


def hourly(fact: DataFrame, as_of: Instant | None = None, lookback: str | None = "3 hours",
           aligned: bool = True) -> DataFrame:
    """Power, energy and quality figures per device and hour.

    When ``fact`` still carries the ``hour_start`` its deltas were computed
    by, its partitioning serves this grouping too and nothing is shuffled.
    """
    rows = trailing(fact, "reading_time", as_of, lookback, aligned, "hour")
    if "hour_start" not in rows.columns:
        rows = rows.withColumn("hour_start", floor_hour(F.col("reading_time")))
    grouped = rows.groupBy(*S.HOUR_GRAIN).agg(
        mean_rounded("active_power", 2).alias("avg_power_kw"),
        F.max("active_power").alias("max_power_kw"),
        F.min("active_power").alias("min_power_kw"),
        F.sum(F.coalesce("energy_delta", F.lit(0).cast("decimal(1,0)"))).alias("energy_kwh"),
        mean_rounded("power_factor", 4).alias("avg_pf"),
        mean_rounded("voltage_avg", 2).alias("avg_voltage"),
        F.count("*").alias("reading_count"))
    return grouped.selectExpr(*S.casts(S.hourly_schema(), as_is=S.DEVICE))


def daily(hours: DataFrame, as_of: Instant | None = None, lookback: str | None = "2 days",
          aligned: bool = True) -> DataFrame:
    """Days from hours.  Means are plain means of the hourly means."""
    rows = trailing(hours, "hour_start", as_of, lookback, aligned, "day")
    grouped = (rows.withColumn("reading_date", F.to_date("hour_start"))
               .groupBy(*S.DAY_GRAIN).agg(
        F.round(F.sum("energy_kwh"), 4).alias("total_energy_kwh"),
        F.max("max_power_kw").alias("peak_demand_kw"),
        mean_rounded("avg_power_kw", 2).alias("avg_power_kw"),
        F.max("max_power_kw").alias("max_power_kw"),
        F.min("min_power_kw").alias("min_power_kw"),
        mean_rounded("avg_pf", 4).alias("avg_pf"),
        mean_rounded("avg_voltage", 2).alias("avg_voltage"),
        F.sum("reading_count").alias("reading_count")))
    return grouped.selectExpr(*S.casts(S.daily_schema(), as_is=S.DEVICE))


def site_day_figures(days: DataFrame, numbers: DataFrame) -> DataFrame:
    """Per site, day and bucket of device numbers: figures that add up, and which devices there were as a bitmap.

    A device without a number (none at all) is in bucket -1 and in no bitmap.
    """
    number = F.col("number")
    return (days.join(numbers, "device_id", "left")
            .withColumn("bucket", F.coalesce(F.bitmap_bucket_number(number), F.lit(-1).cast("long")))
            .groupBy("site_id", "reading_date", "bucket")
            .agg(F.sum("total_energy_kwh").alias("total_energy_kwh"), F.max("peak_demand_kw").alias("peak_demand_kw"),
                 F.sum("avg_power_kw").alias("power_sum"), F.count("avg_power_kw").alias("power_count"),
                 F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("devices")))

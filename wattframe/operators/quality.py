"""Quality checks over the raw layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattframe import schemas as S
from wattframe.functions import Instant, ntz, trailing_cutoff
from wattframe.operators.joins import join_figures, join_stored_figures


@dataclass(frozen=True)
class Check:
    check_type: str
    threshold: int
    message: str


# Check names, the largest metric that passes, and log messages.
CHECKS = (
    Check("NULL_POWER", 10, "Readings with null active_power"),
    Check("NEGATIVE_POWER", 10, "Readings with negative active_power (sensor wiring error)"),
    Check("VOLTAGE_RANGE", 5, "Readings with voltage outside 180-260V"),
    Check("FUTURE_TIMESTAMP", 5, "Readings with collected_at in the future (clock drift)"),
    Check("DUPLICATE_RATE", 20, "Duplicate readings per (site, device, time) in last 2 hours"),
    Check("INGESTION_GAP", 3, "Devices with no data in the last 10 minutes"),
)
VOLTAGE_LOW, VOLTAGE_HIGH = 180, 260


def _recent(raw: DataFrame, as_of: Instant, lookback: str | None) -> DataFrame:
    """Rows ingested by ``as_of``, so that an earlier time gives the result of then; with a lookback the last of them."""
    landed = raw.filter(F.col("ingested_at") <= ntz(as_of))
    return landed if lookback is None else landed.filter(F.col("ingested_at") > trailing_cutoff(as_of, lookback))


def violation_counts(as_of: Instant) -> dict:
    """The four row-level checks as aggregates, by check name."""
    power, volts = F.col("active_power"), F.col("voltage_avg")
    return {
        "NULL_POWER": F.count_if(power.isNull()),
        "NEGATIVE_POWER": F.count_if(power < 0),
        "VOLTAGE_RANGE": F.count_if((volts < VOLTAGE_LOW) | (volts > VOLTAGE_HIGH)),
        "FUTURE_TIMESTAMP": F.count_if(F.col("collected_at") > ntz(as_of)),
    }


def reading_checks(raw: DataFrame, as_of: Instant, lookback: str | None = "2 hours",
                   only: list[str] | None = None) -> DataFrame:
    """(check_type, metric_value) of the five reading checks from one scan.

    ``only`` names the checks to run.  The duplicate count compares whole keys
    as structs, which also counts keys with a NULL member.  Keys are reduced
    in each map task before the shuffle.
    """
    counts = violation_counts(as_of)
    counts["DUPLICATE_RATE"] = F.count("*") - F.count_distinct(F.struct(*S.RAW_GRAIN))
    names = [name for name in counts if only is None or name in only]
    row = _recent(raw, as_of, lookback).agg(*(counts[name].alias(name) for name in names))
    return row.unpivot([], names, "check_type", "metric_value")


def silent_devices(devices: DataFrame, raw: DataFrame, as_of: Instant,
                   lookback: str = "10 minutes") -> DataFrame:
    """Active devices without a reading ingested in the lookback."""
    heard = _recent(raw, as_of, lookback).select("device_id").distinct()
    return devices.filter("is_active").join(heard, "device_id", "left_anti")


def ingestion_gap(devices: DataFrame, raw: DataFrame, as_of: Instant,
                  lookback: str = "10 minutes") -> DataFrame:
    """One row (check_type, metric_value): how many active devices are silent."""
    silent = silent_devices(devices, raw, as_of, lookback)
    return silent.agg(F.count_distinct("device_id").alias("metric_value")).select(
        F.lit("INGESTION_GAP").alias("check_type"), "metric_value")


def quality_log(metrics: DataFrame, as_of: Instant, checks: tuple[Check, ...] = CHECKS) -> DataFrame:
    """Log rows for measured checks; a metric equal to its threshold passes."""
    def of_check(field: str) -> Column:
        pairs = [F.lit(x) for c in checks for x in (c.check_type, getattr(c, field))]
        return F.try_element_at(F.create_map(*pairs), F.col("check_type"))

    log = metrics.withColumns({
        "check_time": ntz(as_of), "site_id": F.lit(None), "device_id": F.lit(None),
        "threshold_value": of_check("threshold"), "message": of_check("message"),
    }).filter(F.col("threshold_value").isNotNull())
    status = F.when(F.col("metric_value") <= F.col("threshold_value"), "PASS").otherwise("FAIL")
    return log.withColumn("status", status).selectExpr(*S.casts(S.log_schema()))


def run_checks(devices: DataFrame, raw: DataFrame, as_of: Instant) -> DataFrame:
    """All six checks as log rows: a scan of raw for the readings, a narrow one for the gap."""
    metrics = reading_checks(raw, as_of).unionByName(ingestion_gap(devices, raw, as_of))
    return quality_log(metrics, as_of)


def power_figures(raw: DataFrame, *by: str) -> DataFrame:
    """(device_id, *by, n, mean, squares): count, mean and summed squared deviations of active power."""
    power = F.col("active_power").cast("double")
    return raw.groupBy("device_id", *by).agg(
        F.count(power).alias("n"), F.avg(power).alias("mean"),
        (F.var_pop(power) * F.count(power)).alias("squares")).filter(F.col("n") > 0)


def merged_figures(figures: DataFrame) -> DataFrame:
    """(device_id, mean, deviation) from the figures of disjoint parts of the readings of a device.

    The deviations of the parts' means from the common mean are added to the
    squares of the parts, so large means don't cancel digits of small deviations.
    A window holds one row for each part of a device.
    """
    device = W.partitionBy("device_id")
    total = F.sum("n").over(device)
    mean = F.sum(F.col("n") * F.col("mean")).over(device) / total
    parts = figures.select("device_id", "n", "squares", F.col("mean").alias("own"), mean.alias("mean"))
    return parts.groupBy("device_id", "mean").agg(F.sqrt(
        F.sum(F.col("squares") + F.col("n") * (F.col("own") - F.col("mean")) ** 2)
        / F.nullif(F.sum("n") - 1, F.lit(0))).alias("deviation"))


def power_scores(raw: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """``raw`` plus ``z``: active power in standard deviations from its device's mean.

    Mean and sample deviation are aggregated per device and joined back
    instead of computed in a window, which would draw all rows of a device
    into one task.  ``stats`` may hold them already, as a written table.
    """
    power = F.col("active_power").cast("double")
    if stats is None:
        stats = raw.groupBy("device_id").agg(F.avg(power).alias("mean"), F.stddev_samp(power).alias("deviation"))
        joined = join_figures(raw, stats, ["device_id"])
    else:
        joined = join_stored_figures(raw, stats, ["device_id"], salt_by=["id"])
    z = (power - F.col("mean")) / F.nullif(F.col("deviation"), F.lit(0.0))
    return joined.select(*raw.columns, z.alias("z"))


def is_anomaly(z: float) -> Column:
    return (F.abs("z") > z) & (F.col("quality_flag") == S.RAW)


def flag_anomalies(raw: DataFrame, z: float = 3.0, stats: DataFrame | None = None) -> DataFrame:
    """Readings still flagged RAW become ANOMALY beyond ``z`` deviations."""
    return power_scores(raw, stats).withColumn(
        "quality_flag", F.when(is_anomaly(z), S.ANOMALY).otherwise(F.col("quality_flag")))

from datetime import date, datetime
from decimal import Decimal as D

from helpers import DAY, fact, rows
from pyspark.sql import functions as F

from wattframe import schemas as S
from wattframe.operators.delta import energy_delta
from wattframe.operators.merge import upsert
from wattframe.operators.rollup import daily, hourly

NOW = DAY + "10:20:00"


def minutes(start, end):
    return [f"{DAY}{m // 60:02}:{m % 60:02}:00" for m in range(start, end)]


def test_hourly_figures_and_tie_away_from_zero(spark):
    made = energy_delta(fact(spark, [("D1", DAY + "10:00:00", 5, 1.25), ("D1", DAY + "10:30:00", 7, 1.26)]))
    assert rows(hourly(made, lookback=None), "hour_start", "avg_power_kw", "max_power_kw", "min_power_kw",
                "energy_kwh", "avg_pf", "avg_voltage", "reading_count") == [
        (datetime(2026, 3, 27, 10), D("1.26"), D("1.26"), D("1.25"), D("2.0000"), D("0.9000"), D("220.00"), 2)]


def test_mean_is_exact_where_a_six_digit_average_is_not(spark):
    many = spark.range(100_003).select(
        F.lit("S1").alias("site_id"), F.lit("D1").alias("device_id"),
        F.lit(DAY + "10:00:00").cast("timestamp_ntz").alias("reading_time"),
        F.when(F.col("id") < 50_001, 0.01).otherwise(0).cast("decimal(12,2)").alias("active_power"),
        F.lit(None).cast("decimal(10,4)").alias("energy_delta"),
        F.lit(None).cast("decimal(5,4)").alias("power_factor"), F.lit(None).cast("decimal(8,2)").alias("voltage_avg"))
    assert rows(hourly(many, lookback=None), "avg_power_kw", "avg_pf") == [(D("0.00"), None)]


def test_hour_cutoff_literal_and_aligned(spark):
    made = energy_delta(fact(spark, [("D1", t, 1) for t in minutes(420, 600)]))
    literal = rows(hourly(made, NOW, aligned=False), "hour_start", "reading_count")
    aligned = rows(hourly(made, NOW), "hour_start", "reading_count")
    assert [r[1] for r in literal] == [39, 60, 60]
    assert [r[1] for r in aligned] == [60, 60, 60]


def test_reset_counts_as_no_energy(spark):
    made = energy_delta(fact(spark, [("D1", DAY + "10:00:00", 50), ("D1", DAY + "10:01:00", 2)]))
    assert rows(hourly(made, lookback=None), "energy_kwh") == [(D("0.0000"),)]


def hours(spark, *items):
    kinds = "device_id string, hour_start string, avg_power_kw double, energy_kwh double, reading_count int"
    df = spark.createDataFrame(list(items), kinds).withColumns(
        {"site_id": F.lit("S1"), "max_power_kw": F.col("avg_power_kw") + 1, "min_power_kw": F.col("avg_power_kw") - 1})
    return df.selectExpr(*S.casts(S.hourly_schema(), df.columns))


def test_daily_is_the_plain_mean_of_hours(spark):
    made = hours(spark, ("D1", DAY + "01:00:00", 10.0, 1.5, 60), ("D1", DAY + "02:00:00", 20.0, 2.5, 1))
    assert rows(daily(made, lookback=None), "reading_date", "total_energy_kwh", "peak_demand_kw", "avg_power_kw",
                "max_power_kw", "min_power_kw", "reading_count") == [
        (date(2026, 3, 27), D("4.0000"), D("21.00"), D("15.00"), D("21.00"), D("9.00"), 61)]


def test_day_cutoff_literal_and_aligned(spark):
    made = hours(spark, *(("D1", f"2026-03-{d} {h:02}:00:00", 1.0, 1.0, 60) for d in (25, 26, 27) for h in (3, 9, 12)))
    literal = rows(daily(made, NOW, aligned=False), "reading_date", "reading_count")
    aligned = rows(daily(made, NOW), "reading_date", "reading_count")
    assert [r[1] for r in literal] == [60, 180, 180]
    assert [r[1] for r in aligned] == [180, 180, 180]


def test_upsert_replaces_adds_and_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, kept int")
    source = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    once = upsert(target, source, ["k"])
    assert rows(once, "k", "v", "kept") == [(1, "a", 1), (2, "B", None), (3, "C", None)]
    assert rows(upsert(once, source, ["k"]), "k", "v", "kept") == rows(once, "k", "v", "kept")


def test_hourly_needs_no_shuffle_after_the_delta(spark):
    from wattframe.plans.pipeline import hours_from_raw
    from helpers import raw
    plan = hours_from_raw(raw(spark, [{}]), NOW)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    window = next(i for i, line in enumerate(lines) if "Window [lag" in line)
    assert not any("Exchange" in line for line in lines[:window])

"""Reads from stored layers: newest partitions only, and exact device counts from bitmaps."""

from datetime import date, datetime, timedelta

import pytest
from helpers import raw, rows
from pyspark.sql import functions as F

from wattframe import schemas as S
from wattframe.operators import reads as R
from wattframe.plans import serving
from wattframe.plans.pipeline import run_pipeline
from wattframe.sources.tables import Warehouse

LATER = "2026-12-31"
HOURS = S.hourly_schema().names


def readings(days, devices, hours=(1, 2), first=datetime(2026, 1, 1)):
    return [{"site_id": f"S{d % 3}", "device_id": f"D{d}", "collected_at": str(first + timedelta(days=i, hours=h)),
             "energy_kwh": 10 * i + h} for i in range(days) for d in range(devices) for h in hours]


@pytest.fixture(scope="module", params=["day", "hour"])
def filled(spark, tmp_path_factory, request):
    tables = Warehouse(spark, str(tmp_path_factory.mktemp("stored")), grain=request.param)
    sparse = [{"site_id": "S9", "device_id": "RARE", "collected_at": f"2026-01-{d:02} 03:00:00"} for d in (1, 3, 9)]
    tables.append("raw", raw(spark, readings(10, 6) + sparse))
    tables.append("sites", spark.createDataFrame([(f"S{i}", f"site {i}") for i in (0, 1, 2, 9)],
                                                 "site_id string, site_name string"))
    run_pipeline(tables, LATER)
    return tables


def opened(df):
    return sorted({f.split("=")[1].split("/")[0] for f in df.inputFiles()})


CASES = [{"limit": n} for n in (1, 5, 12, 13, 500, None)] + [
    {"limit": 2, "device_id": "RARE"}, {"limit": 3, "device_id": "RARE"}, {"limit": 4, "device_id": "RARE"},
    {"limit": 3, "site_id": "S1", "start": "2026-01-02", "end": "2026-01-04"}, {"limit": 3, "start": "2027-01-01"},
    {"limit": 5, "end": "2026-01-03"}, {"limit": 0}, {"limit": 2, "device_id": "NONE"}]


@pytest.mark.parametrize("case", CASES, ids=str)
def test_same_rows_as_a_full_sort(filled, case):
    assert rows_in_order(serving.newest_hours(filled, **case)) == rows_in_order(R.find_hourly(filled.read("hourly"), **case))
    assert rows_in_order(serving.newest_days(filled, **case)) == rows_in_order(R.find_daily(filled.read("daily"), **case))


def rows_in_order(df):
    return [tuple(r) for r in df.collect()]


def test_only_the_newest_partitions_are_opened(filled):
    hour = filled.grain == "hour"
    assert opened(serving.newest_hours(filled, limit=5)) == (["2026011002"] if hour else ["20260110"])
    assert len(opened(serving.newest_hours(filled, limit=13))) == (4 if hour else 2)
    assert opened(serving.newest_days(filled, limit=6)) == ["2026-01-10"]
    ranged = opened(serving.newest_days(filled, limit=1, end="2026-01-04"))
    assert ranged == ["2026-01-04"]
    assert len(opened(serving.newest_hours(filled, limit=3, device_id="RARE"))) > 9


def test_nothing_stored_is_an_empty_result(spark, tmp_path):
    empty = Warehouse(spark, str(tmp_path))
    assert serving.newest_hours(empty).count() == 0 and serving.newest_days(empty).columns == S.daily_schema().names
    assert serving.devices_seen(empty).count() == 0


def test_site_totals_equal_the_summary_of_days(filled):
    for case in ({}, {"site_id": "S1"}, {"start": "2026-01-03", "end": "2026-01-04"}, {"limit": 2}):
        assert rows_in_order(serving.site_summary(filled, **case)) == rows_in_order(
            R.site_daily_summary(filled.read("daily"), filled.read("sites"), **case))
    files = serving.site_summary(filled).inputFiles()
    assert not any(f"/{layer}/" in f for f in files for layer in ("daily", "hourly", "readings", "raw"))


def test_devices_keep_their_numbers_and_are_counted_once(spark, tmp_path):
    tables = Warehouse(spark, str(tmp_path))
    numbers = {}
    for first, devices in ((datetime(2026, 1, 1), 5), (datetime(2026, 1, 2), 40), (datetime(2026, 1, 1, 0, 30), 8)):
        tables.append("raw", raw(spark, readings(2, devices, (1,), first)))
        run_pipeline(tables, LATER)
        now = dict(rows(tables.read("device_numbers"), "device_id", "number"))
        assert len(set(now.values())) == len(now) and numbers.items() <= now.items()
        numbers = now
    days = tables.read("daily")
    for start, end in ((None, None), ("2026-01-01", "2026-01-01"), ("2026-01-02", "2026-01-03")):
        part = days.filter((F.col("reading_date") >= (start or "1900-01-01")) & (F.col("reading_date") <= (end or LATER)))
        wanted = part.groupBy("site_id").agg(F.count_distinct("device_id").alias("device_count"))
        assert rows(serving.devices_seen(tables, start, end), "site_id", "device_count") == rows(
            wanted, "site_id", "device_count")


def test_numbers_far_apart_and_missing_devices(spark):
    from wattframe.operators.rollup import site_day_figures
    days = spark.createDataFrame([("S1", d, date(2026, 1, 1), 1.0, 2.0, 3.0) for d in ("A", "B", "C", None)],
                                 "site_id string, device_id string, reading_date date, total_energy_kwh double,"
                                 " peak_demand_kw double, avg_power_kw double")
    days = days.selectExpr("site_id", "device_id", "reading_date", *[
        f"cast({c} as decimal(14,4)) as {c}" for c in ("total_energy_kwh", "peak_demand_kw", "avg_power_kw")])
    numbers = spark.createDataFrame([("A", 0), ("B", 32769), ("C", (5 << 33) + 7)], "device_id string, number long")
    sites = spark.createDataFrame([("S1", "one")], "site_id string, site_name string")
    made = R.summary_of(site_day_figures(days, numbers), sites)
    assert rows(made, "device_count", "avg_power_kw", "total_energy_kwh")[0][:2] == (3, 3.0)
    assert made.collect() == R.site_daily_summary(days, sites).collect()

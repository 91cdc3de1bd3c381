from datetime import date, datetime
from decimal import Decimal as D

import pytest
from helpers import rows
from pyspark.sql import functions as F

from wattframe import schemas as S
from wattframe.operators import reads as R
from wattframe.sources.seed import DEVICES, SITES, seed_devices, seed_sites

MADE = "2026-01-01"


@pytest.fixture(scope="module")
def sites(spark):
    made = spark.createDataFrame([("SITE_TPE_02", "office B", "office", 200), ("SITE_TPE_01", "plant A", "factory", 500)],
                                 "site_id string, site_name string, site_type string, capacity_kw int")
    return made.selectExpr(*S.casts(S.sites_schema(), made.columns))


@pytest.fixture(scope="module")
def devices(spark):
    made = spark.createDataFrame([("DEV_TPE_01_MAIN", "SITE_TPE_01", True), ("DEV_TPE_01_HVAC", "SITE_TPE_01", True),
                                  ("DEV_TPE_02_MAIN", "SITE_TPE_02", True)],
                                 "device_id string, site_id string, is_active boolean")
    return made.selectExpr(*S.casts(S.devices_schema(), made.columns))


@pytest.fixture(scope="module")
def days(spark):
    made = spark.createDataFrame(
        [("SITE_TPE_01", "DEV_TPE_01_MAIN", "2026-03-27", "480.5000", "25.30", "20.02", 1440),
         ("SITE_TPE_01", "DEV_TPE_01_HVAC", "2026-03-27", "360.2000", "18.50", "15.01", 1440)],
        "site_id string, device_id string, reading_date string, total_energy_kwh string, peak_demand_kw string,"
        " avg_power_kw string, reading_count int")
    return made.selectExpr(*S.casts(S.daily_schema(), made.columns))


def hours(spark, *items):
    made = spark.createDataFrame(list(items), "site_id string, device_id string, hour_start string")
    return made.selectExpr(*S.casts(S.hourly_schema(), made.columns))


def test_sites_in_order(sites):
    assert [r[0] for r in R.list_sites(sites).collect()] == ["SITE_TPE_01", "SITE_TPE_02"]


def test_one_site_or_none(sites):
    assert rows(R.get_site(sites, "SITE_TPE_01"), "site_type") == [("factory",)]
    assert R.get_site(sites, "NONEXISTENT").isEmpty()


def test_devices_of_a_site(devices):
    assert [r[0] for r in R.list_devices(devices, "SITE_TPE_01").collect()] == ["DEV_TPE_01_HVAC", "DEV_TPE_01_MAIN"]
    assert R.list_devices(devices, "NONEXISTENT").isEmpty()


def test_one_device_or_none(devices):
    assert rows(R.get_device(devices, "DEV_TPE_01_MAIN"), "is_active") == [(True,)]
    assert R.get_device(devices, "NONEXISTENT").isEmpty()


def test_daily_by_site_and_closed_range(days):
    assert R.find_daily(days, site_id="SITE_TPE_01").count() == 2
    assert R.find_daily(days, start="2026-03-27", end="2026-03-27").count() == 2
    assert R.find_daily(days, start=date(2026, 3, 28)).isEmpty()
    assert R.find_daily(days, end=date(2026, 3, 26)).isEmpty()
    assert R.find_daily(days, site_id="NONEXISTENT").isEmpty()
    assert R.find_daily(days, device_id="DEV_TPE_01_HVAC").count() == 1
    assert R.find_daily(days).count() == 2


def test_summary_of_a_site(days, sites):
    assert [tuple(r) for r in R.site_daily_summary(days, sites, site_id="SITE_TPE_01").collect()] == [
        ("SITE_TPE_01", "plant A", date(2026, 3, 27), D("840.7000"), D("25.30"), 17.515, 2)]
    assert R.site_daily_summary(days, sites, start="2026-03-28").isEmpty()


def test_hourly_range_ends_with_the_last_hour_of_the_day(spark):
    made = hours(spark, *(("S1", "D1", t) for t in ("2026-03-26 23:00:00", "2026-03-27 00:00:00",
                                                    "2026-03-27 23:00:00", "2026-03-28 00:00:00")))
    found = R.find_hourly(made, start="2026-03-27", end="2026-03-27")
    assert [r.hour_start for r in found.collect()] == [datetime(2026, 3, 27, 23), datetime(2026, 3, 27, 0)]


def test_limit_cuts_ties_by_key(spark):
    made = hours(spark, *(("S1", d, "2026-03-27 00:00:00") for d in ("D3", "D1", "D2")))
    assert [r.device_id for r in R.find_hourly(made, limit=2).collect()] == ["D1", "D2"]


def test_reads_sort_only_what_they_return(days):
    assert "TakeOrderedAndProject" in R.find_daily(days)._jdf.queryExecution().executedPlan().toString()


def test_camel_case_names(days):
    assert R.camel_case(days).columns[:4] == ["siteId", "deviceId", "readingDate", "totalEnergyKwh"]


def test_seed_rows_follow_their_schema(spark):
    sites, devices = seed_sites(spark, MADE), seed_devices(spark, MADE)
    assert sites.schema.simpleString() == S.sites_schema().simpleString()
    assert devices.schema.simpleString() == S.devices_schema().simpleString()
    assert (sites.count(), devices.count()) == (len(SITES), len(DEVICES)) == (7, 16)
    assert devices.join(sites, "site_id", "left_anti").isEmpty()
    assert devices.filter(~F.col("is_active")).isEmpty()

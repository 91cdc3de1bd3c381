"""Parameterised reads over sites, devices and the rolled-up facts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe import schemas as S
from wattframe.functions import Instant, day_of, exact_mean, ntz

SITE_COLUMNS = S.sites_schema().names
DEVICE_COLUMNS = S.devices_schema().names


def _where(df: DataFrame, *conditions: Column | None) -> DataFrame:
    present = [c for c in conditions if c is not None]
    return df.filter(reduce(Column.__and__, present)) if present else df


def _equals(column: str, value) -> Column | None:
    return None if value is None else F.col(column) == value


def list_sites(sites: DataFrame) -> DataFrame:
    return sites.select(*SITE_COLUMNS).orderBy("site_id")


def get_site(sites: DataFrame, site_id) -> DataFrame:
    """The site with that id; no row if there is none."""
    return sites.filter(F.col("site_id") == site_id).select(*SITE_COLUMNS)


def list_devices(devices: DataFrame, site_id) -> DataFrame:
    return devices.filter(F.col("site_id") == site_id).select(*DEVICE_COLUMNS).orderBy("device_id")


def get_device(devices: DataFrame, device_id) -> DataFrame:
    return devices.filter(F.col("device_id") == device_id).select(*DEVICE_COLUMNS)


def _first(rows: DataFrame, limit: int | None) -> DataFrame:
    return rows if limit is None else rows.limit(limit)


def find_hourly(hours: DataFrame, site_id=None, device_id=None, start: Instant | None = None,
                end: Instant | None = None, limit: int | None = 500) -> DataFrame:
    """Newest hours first, all of them without ``limit``; ``start`` and ``end`` are days, both included."""
    time = F.col("hour_start")
    rows = _where(hours, _equals("site_id", site_id), _equals("device_id", device_id),
                  None if start is None else time >= ntz(day_of(start)),
                  None if end is None else time < ntz(F.date_add(day_of(end), 1)))
    return _first(rows.select(*S.hourly_schema().names)
                  .orderBy(F.desc_nulls_first("hour_start"), "site_id", "device_id"), limit)


def find_daily(days: DataFrame, site_id=None, device_id=None, start: Instant | None = None,
               end: Instant | None = None, limit: int | None = 500) -> DataFrame:
    """Newest days first within a closed or one-sided range of days."""
    rows = _where(days, _equals("site_id", site_id), _equals("device_id", device_id),
                  *_days_between(start, end))
    return _first(rows.select(*S.daily_schema().names)
                  .orderBy(F.desc_nulls_first("reading_date"), "site_id", "device_id"), limit)


def _days_between(start: Instant | None, end: Instant | None) -> list[Column | None]:
    day = F.col("reading_date")
    return [None if start is None else day >= day_of(start),
            None if end is None else day <= day_of(end)]


def site_daily_summary(days: DataFrame, sites: DataFrame, site_id=None, start: Instant | None = None,
                       end: Instant | None = None, limit: int | None = 200) -> DataFrame:
    """Energy, peak, mean power and device count per site and day, newest day first.

    Days are grouped per site before the names are joined, so the join sees
    one row per site and day.
    """
    rows = _where(days, _equals("site_id", site_id), *_days_between(start, end))
    totals = rows.groupBy("site_id", "reading_date").agg(
        F.sum("total_energy_kwh").alias("total_energy_kwh"),
        F.max("peak_demand_kw").alias("peak_demand_kw"),
        exact_mean("avg_power_kw").alias("avg_power_kw"),
        F.count_distinct("device_id").alias("device_count"))
    return _named(totals, sites, limit)


def _named(totals: DataFrame, sites: DataFrame, limit: int | None) -> DataFrame:
    named = totals.join(sites.select("site_id", "site_name"), "site_id").select(
        "site_id", "site_name", "reading_date", "total_energy_kwh", "peak_demand_kw", "avg_power_kw", "device_count")
    return _first(named.orderBy(F.desc_nulls_first("reading_date"), F.asc_nulls_last("site_id")), limit)


def summary_of(site_days: DataFrame, sites: DataFrame, site_id=None, start: Instant | None = None,
               end: Instant | None = None, limit: int | None = 200) -> DataFrame:
    """``site_daily_summary`` from figures per site, day and bucket; buckets share no device."""
    rows = _where(site_days, _equals("site_id", site_id), *_days_between(start, end))
    totals = rows.groupBy("site_id", "reading_date").agg(
        F.sum("total_energy_kwh").alias("total_energy_kwh"),
        F.max("peak_demand_kw").alias("peak_demand_kw"),
        (F.sum("power_sum").cast("double") / F.nullif(F.sum("power_count"), F.lit(0))).alias("avg_power_kw"),
        F.sum(F.bitmap_count("devices")).alias("device_count"))
    return _named(totals, sites, limit)


def camel_case(df: DataFrame) -> DataFrame:
    """Result columns renamed from snake_case to camelCase."""
    def camel(name: str) -> str:
        head, *rest = name.split("_")
        return head + "".join(word.capitalize() for word in rest)
    return df.toDF(*map(camel, df.columns))

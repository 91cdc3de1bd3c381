"""Reads from the stored layers: newest rows first, and site totals with exact device counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.functions import Instant, day_of
from wattframe.operators import reads as R
from wattframe.operators.rollup import site_day_figures
from wattframe.sources.tables import Warehouse

FIRST_PARTS = 1


def _newest(wh: Warehouse, name: str, find: Callable[..., DataFrame], start: Instant | None, end: Instant | None,
            limit: int | None, **equal) -> DataFrame:
    """``find`` over no more of the newest partitions than hold ``limit`` matching rows.

    Partitions follow the time that rows are sorted by, so once the newest ones
    hold enough matches no older row can be among the first.  Each try takes
    twice as many partitions as the last, so a sparse filter costs at most
    twice a full scan; the partitions of a try are counted, not sorted.
    """
    parts = wh.folders(name, start, end)
    taken = FIRST_PARTS if limit is not None else len(parts)
    while taken < len(parts):
        matching = find(wh.read(name, parts[:taken]), start=start, end=end, limit=None, **equal)
        if matching.select(F.lit(1)).limit(limit).count() >= limit:
            break
        taken *= 2
    return find(wh.read(name, parts[:taken]), start=start, end=end, limit=limit, **equal)


def newest_hours(wh: Warehouse, site_id=None, device_id=None, start: Instant | None = None, end: Instant | None = None,
                 limit: int | None = 500) -> DataFrame:
    """``find_hourly`` over the stored hours, opening only the newest partitions that are needed."""
    return _newest(wh, "hourly", R.find_hourly, start, end, limit, site_id=site_id, device_id=device_id)


def newest_days(wh: Warehouse, site_id=None, device_id=None, start: Instant | None = None, end: Instant | None = None,
                limit: int | None = 500) -> DataFrame:
    """``find_daily`` over the stored days, opening only the newest partitions that are needed."""
    return _newest(wh, "daily", R.find_daily, start, end, limit, site_id=site_id, device_id=device_id)


def refresh_site_days(wh: Warehouse, parts: list) -> None:
    """Recomputes the site totals of these days, giving numbers to devices not met before.

    A device keeps its number for good, so bitmaps of different days can be
    joined.  Numbers are unique, not gapless: each task counts on from a start
    of its own.
    """
    days = wh.read("daily", parts)
    known = wh.read("device_numbers")
    fresh = wh.stage("new_devices", days.select("device_id").distinct().where("device_id is not null")
                     .join(known, "device_id", "left_anti").withColumn("step", F.monotonically_increasing_id()))
    if not fresh.isEmpty():
        top = known.agg(F.max("number")).first()[0]
        start = 0 if top is None else top + 1
        wh.append("device_numbers", fresh.select("device_id", (F.col("step") + start).alias("number")))
    wh.replace("site_days", site_day_figures(days, wh.read("device_numbers")))


def site_summary(wh: Warehouse, site_id=None, start: Instant | None = None, end: Instant | None = None,
                 limit: int | None = 200) -> DataFrame:
    """``site_daily_summary`` from the stored site totals: neither readings, hours nor device days are read."""
    return R.summary_of(wh.read("site_days"), wh.read("sites"), site_id, start, end, limit)


def devices_seen(wh: Warehouse, start: Instant | None = None, end: Instant | None = None) -> DataFrame:
    """(site_id, device_count): devices with a reading on any of the days, each counted once."""
    days = wh.read("site_days")
    day = F.col("reading_date")
    if start is not None:
        days = days.filter(day >= day_of(start))
    if end is not None:
        days = days.filter(day <= day_of(end))
    seen = days.groupBy("site_id", "bucket").agg(F.bitmap_or_agg("devices").alias("devices"))
    return seen.groupBy("site_id").agg(F.sum(F.bitmap_count("devices")).alias("device_count"))

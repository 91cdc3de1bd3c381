"""Energy used between consecutive readings of a cumulative meter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattframe import schemas as S
from wattframe.functions import Instant, floor_hour, trailing_cutoff

DELTA = S.fact_schema()["energy_delta"].dataType


def reading_tails(readings: DataFrame, time: str = "reading_time",
                  order: list[str] | None = None) -> DataFrame:
    """The last reading of every device and hour: (site, device, hour, time, energy).

    Aggregated before the shuffle, so its cost follows device-hours.  ``order``
    names the columns that decide which of several rows is last; with the
    ingest order of raw rows no deduplication is needed first.
    """
    last = F.struct(*order) if order else F.col(time)
    return (readings.groupBy(*S.DEVICE, floor_hour(F.col(time)).alias("hour_start"))
            .agg(F.max(time).alias("reading_time"),
                 F.max_by("energy_kwh", last).alias("energy_kwh")))


def _carried(tails: DataFrame) -> DataFrame:
    """Each tail moved into the next hour in which its device has readings."""
    hours = W.partitionBy(*reversed(S.DEVICE)).orderBy("hour_start")
    return (tails.withColumn("hour_start", F.lead("hour_start").over(hours))
            .filter(F.col("hour_start").isNotNull()))


def with_delta(fact: DataFrame, tails: DataFrame, keep: Column | None = None) -> DataFrame:
    """``fact`` plus ``hour_start`` and the guarded difference ``delta``.

    A plain LAG would sort the whole history of a device in one task.  Here
    the window runs per device and hour; the last reading of the device's
    previous hour is added as its first row and dropped afterwards.  Devices
    lead the sorts, as there are far more of them than sites.
    """
    own = fact.withColumns({"hour_start": floor_hour(F.col("reading_time")), "carried": F.lit(False)})
    carry = _carried(tails)
    if keep is not None:
        carry = carry.filter(keep)
    rows = own.unionByName(carry.withColumn("carried", F.lit(True)), allowMissingColumns=True)
    slices = W.partitionBy("device_id", "hour_start", "site_id").orderBy("reading_time")
    used = F.col("energy_kwh") - F.col("previous")
    return (rows.withColumn("previous", F.lag("energy_kwh").over(slices)).filter(~F.col("carried"))
            .withColumn("delta", F.when(used >= 0, used).cast(DELTA)).drop("carried", "previous"))


def energy_delta(fact: DataFrame, as_of: Instant | None = None, lookback: str | None = None,
                 carry_in: bool = True, fill_only_null: bool = False,
                 tails: DataFrame | None = None, keep_hour: bool = False) -> DataFrame:
    """Fills ``energy_delta``; a falling counter (meter reset) gives NULL.

    ``lookback`` limits the work to readings after ``as_of - lookback``; older
    rows keep what they hold.  ``carry_in=False`` hides the readings before
    that cutoff from the difference, ``fill_only_null=True`` never replaces a
    value: both together give the literal form of the update.  ``tails`` may
    bring stored hour tails; otherwise they are taken from ``fact`` in a second
    narrow scan, so ``fact`` should be a stored table.
    """
    if "energy_delta" not in fact.columns:
        fact = fact.withColumn("energy_delta", F.lit(None).cast(DELTA))
    columns = [*S.fact_schema().names, *(["hour_start"] if keep_hour else [])]
    time = F.col("reading_time")
    seen, older, inside, keep = fact, None, F.lit(True), None
    if lookback is not None:
        inside = time > trailing_cutoff(as_of, lookback)
        first_hour = trailing_cutoff(as_of, lookback, "hour")
        window = (time >= first_hour) if carry_in else inside
        seen, older = fact.filter(window), fact.filter(~window)
        keep = F.col("hour_start") >= first_hour
    if tails is None:
        tails = reading_tails(fact if carry_in else seen)
    fresh = F.coalesce("energy_delta", "delta") if fill_only_null else F.col("delta")
    done = (with_delta(seen, tails, keep)
            .withColumn("energy_delta", F.when(inside, fresh).otherwise(F.col("energy_delta")))
            .select(*columns))
    if older is None:
        return done
    if keep_hour:
        older = older.withColumn("hour_start", floor_hour(time))
    return done.unionByName(older.select(*columns))

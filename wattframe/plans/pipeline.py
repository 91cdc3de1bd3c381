"""The transform run: raw readings into readings, hours and days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattframe import schemas as S
from wattframe.functions import Instant, floor_hour
from wattframe.operators.audit import quarantine
from wattframe.operators.clean import clean_readings, dedupe_readings
from wattframe.operators.delta import energy_delta, reading_tails
from wattframe.operators.merge import upsert
from wattframe.operators.quality import is_anomaly, merged_figures, power_figures, power_scores, run_checks
from wattframe.operators.rollup import daily, hourly
from wattframe.plans.serving import refresh_site_days
from wattframe.session import fit_shuffles
from wattframe.sources.tables import Warehouse

NEAR_DAYS = 2


def tails_from_raw(raw: DataFrame, as_of: Instant) -> DataFrame:
    """Hour tails straight from the clean raw rows: last by time, then as duplicates are decided."""
    return reading_tails(clean_readings(raw, as_of), "collected_at", ["collected_at", "ingested_at", "id"])


def readings_from_raw(raw: DataFrame, as_of: Instant, keep_hour: bool = False) -> DataFrame:
    """Clean, deduplicated readings with deltas as one lazy plan.

    The tails do not need the deduplicated rows, so the large shuffle of
    deduplication runs once.
    """
    return energy_delta(dedupe_readings(raw, as_of), tails=tails_from_raw(raw, as_of), keep_hour=keep_hour)


def hours_from_raw(raw: DataFrame, as_of: Instant) -> DataFrame:
    return hourly(readings_from_raw(raw, as_of, keep_hour=True), lookback=None)


def days_from_raw(raw: DataFrame, as_of: Instant) -> DataFrame:
    return daily(hours_from_raw(raw, as_of), lookback=None)


def _merge_tails(wh: Warehouse, winners: DataFrame, parts: list[int]) -> None:
    """Tails of the touched partitions; at equal times the new reading counts.

    Winners and stored tails are grouped once, by figures that a hash aggregate can hold.
    """
    row = [*S.DEVICE, "reading_time", "energy_kwh"]
    both = (wh.read("tails", parts).select(*row, F.lit(False).alias("fresh"))
            .unionByName(winners.select(*row, F.lit(True).alias("fresh"))))
    new, old = F.when(F.col("fresh"), F.col("reading_time")), F.when(~F.col("fresh"), F.col("reading_time"))
    last = both.groupBy(*S.DEVICE, floor_hour(F.col("reading_time")).alias("hour_start")).agg(
        F.max(new).alias("new"), F.max_by("energy_kwh", new).alias("new_energy"),
        F.max(old).alias("old"), F.max_by("energy_kwh", old).alias("old_energy"))
    wh.replace("tails", last.select(
        *S.HOUR_GRAIN, F.greatest("new", "old").alias("reading_time"),
        F.when(F.col("old").isNull() | (F.col("new") >= F.col("old")), F.col("new_energy"))
        .otherwise(F.col("old_energy")).alias("energy_kwh")))


def _affected_parts(wh: Warehouse, winners: DataFrame, parts: list[int]) -> list[int]:
    """Touched partitions plus, per device, that of the next hour with readings.

    The first delta of that hour starts from a reading that changed.  When no
    later partition exists beside the touched ones, as in an ordinary run, there
    is nothing to search.
    """
    if set(wh.parts("tails", wh.read("tails", since=parts[0]))) <= set(parts):
        return parts
    touched = reading_tails(winners).select(*S.HOUR_GRAIN, F.lit(True).alias("touched"))
    later = wh.read("tails", since=parts[0]).join(
        touched.select(*S.DEVICE).distinct(), S.DEVICE, "left_semi")
    before = F.lag("touched").over(W.partitionBy(*S.DEVICE).orderBy("hour_start"))
    rows = (later.join(touched, S.HOUR_GRAIN, "left").withColumn("follows", before)
            .filter(F.coalesce("touched", "follows")))
    return wh.parts("tails", rows)


def _carry_tails(wh: Warehouse, parts: list[int]) -> DataFrame:
    """Tails that may precede a reading of the affected partitions.

    Two days back are enough for devices that report; only if some device was
    silent for longer are older tails searched, and then for those devices only.
    """
    bound = wh.shifted(parts[0], -NEAR_DAYS)
    near = wh.read("tails", since=bound, before=parts[-1] + 1)
    silent = (near.groupBy(*S.DEVICE).agg(F.min("reading_part").alias("first"))
              .filter(F.col("first") >= parts[0]))
    older = wh.read("tails", before=bound)
    if older.isEmpty() or silent.isEmpty():
        return near
    last = older.join(silent, S.DEVICE, "left_semi").groupBy(*S.DEVICE).agg(
        F.max("hour_start").alias("hour_start"),
        F.max_by("reading_time", "hour_start").alias("reading_time"),
        F.max_by("energy_kwh", "hour_start").alias("energy_kwh"))
    return near.unionByName(last, allowMissingColumns=True)


def absorb(wh: Warehouse, winners: DataFrame, rollups: bool = True) -> None:
    """Merges stored winners into the readings and refreshes all that depends on them.

    Work follows the partitions touched, not the history.  Deltas, hours and days
    are recomputed for whole partitions, so repeating a run changes nothing.
    """
    touched = wh.parts("readings", winners)
    if not touched:
        return
    _merge_tails(wh, winners, touched)
    affected = _affected_parts(wh, winners, touched)
    base = upsert(wh.read("readings", affected), wh.placed("readings", winners), S.FACT_GRAIN)
    wh.replace("readings", energy_delta(base, tails=_carry_tails(wh, affected).drop("reading_part")))
    if not rollups:
        return
    wh.replace("hourly", hourly(wh.read("readings", affected), lookback=None))
    wh.replace("daily", daily(wh.read("hourly", wh.day_parts(affected)), lookback=None))
    refresh_site_days(wh, sorted({f"{p[:4]}-{p[4:6]}-{p[6:8]}" for p in map(str, affected)}))


def _flagged(wh: Warehouse, fresh: DataFrame, z: float) -> DataFrame:
    """Fresh rows with anomalies flagged, by the figures of all that has landed in raw.

    Figures are kept per device and raw partition.  Only the partitions of the
    fresh rows are counted anew, and replaced as a whole, so repeating a run
    counts nothing twice.  The merged figures, one row per device, and the hits
    are stored; the fresh rows themselves are scored where they are read and
    not written once more.
    """
    parts = wh.parts("raw", fresh)
    if not parts:
        return fresh
    wh.replace("power_days", power_figures(wh.read("raw", parts, marked=False), "ingested_part"))
    stats = wh.stage("figures", merged_figures(wh.read("power_days")))
    scored = power_scores(fresh, stats)
    hit = is_anomaly(z)
    wh.merge("anomalies", wh.stage("hits", wh.placed("anomalies", scored.filter(hit))))
    return scored.withColumn("quality_flag", F.when(hit, S.ANOMALY).otherwise(F.col("quality_flag"))).drop("z")


def _gated(wh: Warehouse, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of known devices, rows that wait): what waited before counts again.

    A row without a device refers to none and passes.
    """
    both = rows.unionByName(wh.read("waiting"), allowMissingColumns=True)
    return quarantine(both.select(*S.raw_schema().names), "device_id", wh.read("devices"))


def run_pipeline(wh: Warehouse, as_of: Instant, since: int | None = None, files: list[str] | None = None,
                 z: float | None = None, gate: bool = False) -> None:
    """One run over the raw files that no run has taken.

    The files are listed once, or given as listed before; rows that arrive
    meanwhile wait for the next run.  ``since`` may name the raw partition of
    the last run; rows land in the partition of their arrival, so earlier ones
    hold nothing new.  The ledger is written last: a run that failed half-way
    finds its files again, and raw itself is never rewritten.

    With ``z``, readings whose power lies beyond that many deviations of their
    device are kept out of the readings and listed in ``anomalies``.  With
    ``gate``, readings of devices that ``devices`` lacks wait in ``waiting`` and
    are taken up by the first run that knows the device; in what order devices
    and readings arrive makes no difference to the readings, hours and days.
    """
    files = wh.unconsumed(since) if files is None else files
    fresh = wh.raw_files(files)
    fit_shuffles(fresh)
    if z is not None:
        fresh = _flagged(wh, fresh, z)
    waiting = None
    if gate:
        fresh, orphans = _gated(wh, fresh)
        waiting = wh.stage("waiting", orphans.dropDuplicates(["id"]))
    winners = wh.stage("winners", dedupe_readings(fresh, as_of))
    absorb(wh, winners)
    if waiting is not None:
        wh.replace("waiting", waiting)
    wh.consume(files, as_of)


def run_quality(wh: Warehouse, as_of: Instant) -> None:
    """Appends the results of the six checks to the quality log."""
    raw = wh.recent("raw", as_of, "2 hours")
    wh.append("quality_log", run_checks(wh.read("devices"), raw, as_of))

"""Continuous counterparts of the batch operators.

The stream checkpoint takes the place of the processed mark: each file or
offset is read once.  Every sink step replaces whole keys or partitions, so a
micro-batch that is repeated after a failure leaves the same tables.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattframe import schemas as S
from wattframe.functions import Instant, mean_rounded
from wattframe.operators.clean import dedupe_readings
from wattframe.plans.pipeline import absorb
from wattframe.sources.tables import Warehouse

Clock = Callable[[], Instant]
LATENESS = "3 hours"


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _require_utc(stream: DataFrame) -> None:
    zone = stream.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        raise ValueError(f"event-time streams need session zone UTC, not {zone}")


def _start(stream: DataFrame, step: Callable, checkpoint: str, trigger: dict | None,
           mode: str = "update") -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(step).trigger(**(trigger or {"availableNow": True})).start()


def with_site_name(stream: DataFrame, sites: DataFrame) -> DataFrame:
    """Stream-static join: each row with the name of its site, NULL if unknown."""
    return stream.join(sites.select("site_id", "site_name"), "site_id", "left")


def stream_clean(raw: DataFrame, wh: Warehouse, checkpoint: str, clock: Clock = utc_now,
                 trigger: dict | None = None) -> StreamingQuery:
    """Raw stream to deduplicated readings.

    Copies within a micro-batch are resolved before the shuffle as in batch;
    copies across micro-batches meet in the table by key and the later one
    wins.  The table is the state, so no reading is ever too late.
    """
    def step(batch: DataFrame, _: int) -> None:
        wh.merge("readings", wh.stage("clean_batch", dedupe_readings(batch, clock())))
    return _start(raw, step, checkpoint, trigger)


def stream_energy_delta(raw: DataFrame, wh: Warehouse, checkpoint: str, clock: Clock = utc_now,
                        trigger: dict | None = None, rollups: bool = False) -> StreamingQuery:
    """Raw stream to readings with deltas, and with ``rollups`` also to hours and days.

    The state is the stored tail of each device and hour.  Unlike state keyed
    by device it lets a busy device be split by hour, and a late reading still
    corrects its own and its successor's delta.
    """
    def step(batch: DataFrame, _: int) -> None:
        absorb(wh, wh.stage("delta_batch", dedupe_readings(batch, clock())), rollups)
    return _start(raw, step, checkpoint, trigger)


def stream_hourly(fact: DataFrame, wh: Warehouse, checkpoint: str, sites: DataFrame | None = None,
                  trigger: dict | None = None, lateness: str = LATENESS) -> StreamingQuery:
    """Stream of readings with deltas to the hourly table.

    Each hour stays open for ``lateness`` of event time, at first the reach of
    the batch lookback; later readings are left to the batch run or to
    ``stream_energy_delta`` with rollups, which repair their hour; an updated hour replaces its row.  With ``sites``, hours of
    unknown sites are left out; they are joined once grouped, not per reading.
    """
    _require_utc(fact)
    timed = fact.withColumn("event_time", F.col("reading_time").cast("timestamp"))
    hours = (timed.withWatermark("event_time", lateness)
             .groupBy(*S.DEVICE, F.window("event_time", "1 hour").alias("bucket"))
             .agg(mean_rounded("active_power", 2).alias("avg_power_kw"),
                  F.max("active_power").alias("max_power_kw"),
                  F.min("active_power").alias("min_power_kw"),
                  F.sum(F.coalesce("energy_delta", F.lit(0).cast("decimal(1,0)"))).alias("energy_kwh"),
                  mean_rounded("power_factor", 4).alias("avg_pf"),
                  mean_rounded("voltage_avg", 2).alias("avg_voltage"),
                  F.count("*").alias("reading_count"))
             .withColumn("hour_start", F.col("bucket.start").cast("timestamp_ntz")))

    def step(batch: DataFrame, _: int) -> None:
        changed = wh.stage("hourly_batch", wh.placed("hourly", batch))
        if sites is not None:
            changed = changed.join(sites.select("site_id"), "site_id", "left_semi")
        wh.merge("hourly", changed)
    return _start(hours, step, checkpoint, trigger)


def sliding_counts(rows: DataFrame) -> DataFrame:
    """Violation counts per two-hour ingest window sliding by one hour.

    A reading is from the future if its own time lies beyond its window.
    Works on streams and on tables; expects a zoned ``event_time``.
    """
    power, volts = F.col("active_power"), F.col("voltage_avg")
    ahead = F.col("collected_at") > F.col("bucket.end").cast("timestamp_ntz")
    return (rows.withColumn("bucket", F.window("event_time", "2 hours", "1 hour"))
            .groupBy("bucket")
            .agg(F.count_if(power.isNull()).alias("null_power"),
                 F.count_if(power < 0).alias("negative_power"),
                 F.count_if((volts < 180) | (volts > 260)).alias("voltage_range"),
                 F.count_if(ahead).alias("future_timestamp"))
            .select(F.col("bucket.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("bucket.end").cast("timestamp_ntz").alias("window_end"),
                    "null_power", "negative_power", "voltage_range", "future_timestamp"))


def stream_quality(raw: DataFrame, wh: Warehouse, checkpoint: str,
                   trigger: dict | None = None, lateness: str = LATENESS) -> StreamingQuery:
    """Raw stream to violation counts per sliding ingest window, open for ``lateness``."""
    _require_utc(raw)
    timed = raw.withColumn("event_time", F.col("ingested_at").cast("timestamp"))
    counts = sliding_counts(timed.withWatermark("event_time", lateness))

    def step(batch: DataFrame, _: int) -> None:
        wh.merge("quality_windows", wh.stage("quality_batch", wh.placed("quality_windows", batch)))
    return _start(counts, step, checkpoint, trigger)

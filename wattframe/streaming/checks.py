"""All six quality checks on a stream, logged at each full hour as a batch run at that hour would.

Three stateful steps follow one another in append mode:

* readings are counted per check window and whole key, so that a key's second
  and further readings in a window are its duplicates;
* a processor per active device keeps the hours in whose last minutes the
  device was heard, and an event-time timer reports every hour, heard or not:
  silence is found without a row arriving;
* both are added up per hour, and an hour is logged once the watermark is past it.

Windows are open at their start and closed at their end, like the lookbacks of
the batch checks, so times are moved back by a microsecond.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from wattframe import schemas as S
from wattframe.functions import Instant, ntz
from wattframe.operators.quality import VOLTAGE_HIGH, VOLTAGE_LOW, quality_log
from wattframe.sources.tables import Warehouse
from wattframe.streaming.jobs import LATENESS, _require_utc, _start

HOUR = 3_600_000_000  # microseconds
HEARD = timedelta(minutes=10)
COUNTS = ("null_power", "negative_power", "voltage_range", "future_timestamp", "duplicate_rate")


def _micros(time: Column) -> Column:
    return F.unix_micros(time)


def _hour_after(time: Column) -> Column:
    """The next full hour in microseconds; times are already moved back, so a full hour is its own."""
    return (F.expr(f"div(unix_micros(event_time), {HOUR})") + 1) * HOUR


def _moved_back(raw: DataFrame) -> DataFrame:
    return raw.withColumn("event_time", F.col("ingested_at").cast("timestamp") - F.expr("INTERVAL 1 MICROSECOND"))


def _violations(raw: DataFrame, lateness: str) -> DataFrame:
    """(event_time, counts): per window and key, once the window is closed."""
    power, volts = F.col("active_power"), F.col("voltage_avg")
    ahead = F.col("collected_at") > F.col("bucket.end").cast("timestamp_ntz")
    per_key = (_moved_back(raw).withWatermark("event_time", lateness)
               .withColumn("bucket", F.window("event_time", "2 hours", "1 hour"))
               .groupBy("bucket", *S.RAW_GRAIN)
               .agg(F.count_if(power.isNull()).alias("null_power"),
                    F.count_if(power < 0).alias("negative_power"),
                    F.count_if((volts < VOLTAGE_LOW) | (volts > VOLTAGE_HIGH)).alias("voltage_range"),
                    F.count_if(ahead).alias("future_timestamp"),
                    (F.count("*") - 1).alias("duplicate_rate")))
    return per_key.select(F.window_time("bucket").alias("event_time"), *COUNTS, F.lit(0).cast("long").alias("silent"))


def _heard(raw: DataFrame, lateness: str, key: T.DataType) -> DataFrame:
    """(device_id, hour, event_time): once per device, hour and batch of a task, beside each batch's latest time.

    Only readings in the last minutes before an hour matter; the latest time,
    under no device, keeps the watermark going.  A device that sends a third of
    all readings is thus a few rows for each task.
    """
    near = _hour_after(F.col("event_time"))
    lasting = F.lit(int(HEARD.total_seconds() * 1_000_000))
    rows = _moved_back(raw).where("event_time is not null").select(
        "device_id", "event_time",
        F.when(near - _micros(F.col("event_time")) <= lasting, near).alias("hour"))

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not table.num_rows:
                continue
            heard = table.filter(table["hour"].is_valid()).group_by(["device_id", "hour"]).aggregate([("event_time", "max")])
            latest = table.group_by([]).aggregate([("event_time", "max")])
            kind = table.schema
            both = pa.concat_tables([
                pa.table([heard[c] for c in ("device_id", "event_time_max", "hour")], kind.names),
                pa.table([pa.nulls(1, kind.field("device_id").type), latest["event_time_max"], pa.nulls(1, pa.int64())],
                         kind.names)]).cast(kind)
            yield from both.combine_chunks().to_batches()

    schema = T.StructType([T.StructField("device_id", key), T.StructField("event_time", T.TimestampType()),
                           T.StructField("hour", T.LongType())])
    return rows.mapInArrow(once, schema).withWatermark("event_time", lateness)


class SilenceProcessor(StatefulProcessor):
    """Reports at each full hour whether a device was silent in the minutes before.

    A device has a timer from the start on, so one that is never heard reports
    as well.  State is the next hour and the hours ahead in which it was heard.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        number = T.StructType([T.StructField("value", T.LongType())])
        self.handle = handle
        self.due = handle.getValueState("due", number)
        self.heard = handle.getMapState("heard", number, number)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._wait(initialState["first"])

    def _wait(self, hour: int) -> None:
        self.due.update((hour,))
        self.handle.registerTimer(hour // 1000 - 1)  # a timer fires when the watermark is beyond it

    def handleInputRows(self, key, rows, timerValues):
        if self.due.exists():
            due = self.due.get()[0]
            for row in rows:
                if row["hour"] is not None and row["hour"] >= due:
                    self.heard.updateValue((row["hour"],), (1,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        hour, reached = self.due.get()[0], timerValues.getCurrentWatermarkInMs() * 1000
        while hour <= reached:
            silent = not self.heard.containsKey((hour,))
            if not silent:
                self.heard.removeKey((hour,))
            yield Row(event_time=datetime.fromtimestamp((hour - 1) / 1e6, timezone.utc).replace(tzinfo=None),
                      silent=int(silent))
            hour += HOUR
        self._wait(hour)

    def close(self) -> None:
        pass


def _silence(raw: DataFrame, devices: DataFrame, since: Instant, lateness: str, key: T.DataType) -> DataFrame:
    """(event_time, counts): per active device and hour whether it was silent."""
    first = _hour_from(since)
    active = devices.where("is_active").select("device_id").distinct().withColumn("first", first)
    reports = _heard(raw, lateness, key).groupBy("device_id").transformWithState(
        SilenceProcessor(), "event_time timestamp, silent long", "Append", "EventTime",
        active.groupBy("device_id"), "event_time")
    return reports.select("event_time", *[F.lit(0).cast("long").alias(c) for c in COUNTS], "silent")


def _hour_from(since: Instant) -> Column:
    """The full hour at or after ``since`` in microseconds."""
    micros = _micros(ntz(since).cast("timestamp"))
    return F.ceil(micros / F.lit(HOUR)).cast("long") * HOUR


def stream_quality_log(raw: DataFrame, devices: DataFrame, wh: Warehouse, checkpoint: str, since: Instant,
                       trigger: dict | None = None, lateness: str = LATENESS) -> StreamingQuery:
    """Log rows of all six checks for each full hour from ``since`` on, in the table ``quality_stream``.

    An hour is logged once, when ``lateness`` has passed in event time, with the
    figures of a batch run as of that hour over the readings that were not later
    than that.  Hours without any reading are logged too.  ``devices`` is read
    when the checkpoint is new; a change of the active devices takes a new one.
    Without any active device, hours without readings have no row.
    """
    _require_utc(raw)
    both = _violations(raw, lateness).union(_silence(raw, devices, since, lateness, wh.key))
    hours = both.groupBy(F.window("event_time", "1 hour").alias("bucket")).agg(
        *[F.sum(c).alias(c.upper()) for c in COUNTS], F.sum("silent").alias("INGESTION_GAP"))
    wide = hours.select(F.col("bucket.end").cast("timestamp_ntz").alias("check_time"),
                        *[c.upper() for c in COUNTS], "INGESTION_GAP").where(F.col("check_time") >= ntz(since))

    def step(batch: DataFrame, _: int) -> None:
        metrics = batch.unpivot(["check_time"], [c.upper() for c in COUNTS] + ["INGESTION_GAP"], "check_type", "metric_value")
        log = quality_log(metrics, F.col("check_time"))
        wh.merge("quality_stream", wh.stage("quality_stream_batch", wh.placed("quality_stream", log)))
    return _start(wide, step, checkpoint, trigger, "append")

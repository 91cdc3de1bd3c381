"""Landed feed responses as a stream, with the high-water mark of each device as keyed state."""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from wattframe import schemas as S
from wattframe.functions import ntz
from wattframe.plans.ingest import latest_times
from wattframe.sources.feed import decoded_rows, feed_rejects, parse_feed, with_defaults
from wattframe.sources.tables import Warehouse
from wattframe.streaming.jobs import Clock, _require_utc, _start, utc_now


def response_stream(spark: SparkSession, landing: str, **options: str) -> DataFrame:
    """Landed files below ``channel_id=<n>/`` as (channel_id, payload, source, received_at), a row for each file.

    Responses of a channel count in the order in which their files were written.
    """
    files = (spark.readStream.format("text").option("wholetext", True).options(**options)
             .schema("value string").option("recursiveFileLookup", True).load(landing))
    return files.select(
        F.regexp_extract("_metadata.file_path", r"channel_id=(-?\d+)/", 1).try_cast("long").alias("channel_id"),
        F.col("value").alias("payload"), F.col("_metadata.file_name").alias("source"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("received_at"))


def _response(row) -> tuple:
    """The order of responses; missing times and names come first and are equal to each other."""
    received, source = row[RECEIVED], row[SOURCE]
    return received is not None, received or 0, source is not None, source or ""


class NewerThanMark(StatefulProcessor):
    """Passes the readings of each response that are later than all readings of the responses before it.

    The state of a device is one number, the time of its latest reading.  The
    rows of one micro-batch are put into the order of their responses first, so
    how a stream is cut into micro-batches changes nothing.  It takes rows, not a
    data frame for each device: devices are many and send little in a micro-batch.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.mark = handle.getValueState("mark", T.StructType([T.StructField("value", T.LongType())]))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.mark.update((int(initialState.collected),))

    def handleInputRows(self, key, rows, timerValues):
        mark = self.mark.get()[0] if self.mark.exists() else -(1 << 63)
        passed = []
        for _, response in groupby(sorted(rows, key=_response), _response):
            response = list(response)
            passed += [row for row in response if row[COLLECTED] > mark]
            mark = max(mark, max(row[COLLECTED] for row in response))
        self.mark.update((mark,))
        return iter(passed)

    def close(self) -> None:
        pass


BODY = ["id", *S.MEASURES]
RECEIVED, COLLECTED, SOURCE = 2, 3, 4  # places in a row, after the key


def _newer(decoded: DataFrame, marks: DataFrame, key: T.DataType) -> DataFrame:
    """The rows of ``decoded`` that are later than the mark of their device."""
    def micros(name: str):
        return F.unix_micros(F.col(name).cast("timestamp"))

    # What the processor doesn't look at travels as one text.
    texts = F.struct(*[F.col(name).cast("string").alias(name) for name in BODY])
    rows = decoded.select(*[F.col(c).cast(key).alias(c) for c in S.DEVICE], micros("received_at").alias("received"),
                          micros("collected_at").alias("collected"), "source", F.to_json(texts).alias("body"))
    schema = T.StructType([T.StructField("site_id", key), T.StructField("device_id", key),
                           *[T.StructField(n, T.LongType()) for n in ("received", "collected")],
                           *[T.StructField(n, T.StringType()) for n in ("source", "body")]])
    known = marks.select(*[F.col(c).cast(key).alias(c) for c in S.DEVICE], micros("collected_at").alias("collected"))
    # Without stored times each device would still be looked up among them one by one.
    passed = rows.groupBy(*S.DEVICE).transformWithState(
        NewerThanMark(), schema, "Append", "None", None if known.isEmpty() else known.groupBy(*S.DEVICE))
    body = F.from_json("body", ", ".join(f"{name} string" for name in BODY))
    read = passed.select(*S.DEVICE, F.timestamp_micros("collected").cast("timestamp_ntz").alias("collected_at"), body.alias("body"))
    return read.select(*S.DEVICE, "collected_at", F.col("body.id").cast("long").alias("id"),
                       *[F.col(f"body.{name}").cast(kind).alias(name) for name, kind in S.MEASURES.items()])


def stream_ingest(responses: DataFrame, channels: DataFrame, wh: Warehouse, checkpoint: str, clock: Clock = utc_now,
                  trigger: dict | None = None) -> StreamingQuery:
    """Responses (channel_id, payload, source, received_at) to raw readings and rejects.

    Same rows as a run of ``ingest_responses`` for each response in turn, however
    they fall into micro-batches; responses of equal time in one micro-batch go by
    ``source``.  A new checkpoint
    starts from the times already stored, after that the marks are state and no
    table of them is read or rewritten.  Entries that can't be readings and
    responses that are no JSON go to ``feed_rejects``.  A micro-batch that is
    repeated after a failure appends copies with the same ids, which
    deduplication resolves.
    """
    _require_utc(responses)
    parsed = parse_feed(responses, mode="PERMISSIVE", more=["received_at"])
    marks = wh.read("high_water")
    marks = latest_times(wh.read("raw")) if marks.isEmpty() else marks
    fresh = _newer(decoded_rows(parsed, channels, "received_at", "source"), marks, wh.key)
    rejects = feed_rejects(parsed, channels, ntz("1970-01-01")).drop("ingested_at")
    both = (fresh.withColumn("reason", F.lit(None).cast("string"))
            .unionByName(rejects, allowMissingColumns=True))

    def step(batch: DataFrame, _: int) -> None:
        now = clock()
        held = wh.stage("ingest_batch", batch)
        accepted = held.filter(F.col("reason").isNull()).select(*S.DEVICE, "collected_at", "id", *S.MEASURES)
        wh.append("raw", with_defaults(accepted, now))
        wh.append("feed_rejects", held.filter(F.col("reason").isNotNull())
                  .select("channel_id", "entry", "reason", "source").withColumn("ingested_at", ntz(now)))
    return _start(both, step, checkpoint, trigger, "append")

"""From landed responses to raw rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe import schemas as S
from wattframe.functions import Instant
from wattframe.sources.feed import decode_feed, feed_rejects, new_since
from wattframe.sources.tables import Warehouse


def latest_times(rows: DataFrame) -> DataFrame:
    """The latest reading time of each device."""
    return rows.groupBy(*S.DEVICE).agg(F.max("collected_at").alias("collected_at"))


def ingest_responses(wh: Warehouse, responses: DataFrame, channels: DataFrame, ingested_at: Instant) -> None:
    """Appends what is newer than the latest stored reading of its device.

    The latest times are kept as a table of one row per device, so the raw
    history is searched for them only the first time.  Should a run fail after
    the append, its repetition appends copies, which deduplication resolves.
    Entries that can't be readings, and responses that are no JSON, go to
    ``feed_rejects`` with their reason; the rest of the run goes on.
    """
    wh.append("feed_rejects", feed_rejects(responses, channels, ingested_at))
    marks = wh.read("high_water")
    if marks.isEmpty():
        marks = latest_times(wh.read("raw"))
    fresh = wh.stage("fresh", new_since(decode_feed(responses, channels, ingested_at), marks))
    wh.append("raw", fresh)
    wh.merge("high_water", wh.stage("marks", latest_times(marks.unionByName(latest_times(fresh)))))

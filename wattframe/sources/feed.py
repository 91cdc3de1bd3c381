"""JSON sensor feeds: decoding, field mapping and the high-water mark."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe import schemas as S
from wattframe.functions import Instant, ntz, safe_double, utc_naive
from wattframe.operators.joins import join_figures
from wattframe.sources.small import small_table

FEEDS = "array<map<string,string>>"
BROKEN = "_corrupt_record"


@dataclass(frozen=True)
class Channel:
    """Where a channel's readings belong and which feed field fills which column."""

    channel_id: int
    site_id: object
    device_id: object
    fields: dict[str, str] = field(default_factory=dict)


# The known external channel and the meaning of its fields.
METER_FIELDS = {
    "field1": "energy_kwh",
    "field2": "active_power",
    "field3": "voltage_avg",
    "field4": "current_avg",
    "field5": "frequency",
    "field6": "power_factor",
}
CHANNELS = (Channel(972755, "SITE_EXT_01", "DEV_EXT_PZEM", METER_FIELDS),)


def channel_table(spark: SparkSession, channels: tuple[Channel, ...] = CHANNELS,
                  key: str = "string") -> DataFrame:
    """Channels as rows; ``source_of`` maps a column to the feed field it comes from."""
    rows = [(c.channel_id, c.site_id, c.device_id, [(column, name) for name, column in c.fields.items()])
            for c in channels]
    table = small_table(spark, rows, ["channel_id", "site_id", "device_id", "source_of"],
                        source_of=pa.map_(pa.string(), pa.string()))
    return table.selectExpr("channel_id", f"cast(site_id as {key}) as site_id",
                            f"cast(device_id as {key}) as device_id", "source_of")


def read_feed(spark: SparkSession, landing: str, mode: str = "PERMISSIVE") -> DataFrame:
    """Landed responses, one JSON document per file below ``channel_id=<n>/`` folders.

    A file that is no JSON is kept, with its text as ``broken`` and its name as
    ``source``, for ``feed_rejects``; the others are not affected.  With FAILFAST
    it stops the run.
    """
    kept = "" if mode == "FAILFAST" else f", {BROKEN} string"
    read = (spark.read.schema(f"feeds {FEEDS}, channel_id long{kept}").option("multiLine", True)
            .option("mode", mode).option("columnNameOfCorruptRecord", BROKEN).json(landing))
    broken = F.lit(None).cast("string") if mode == "FAILFAST" else F.col(BROKEN)
    # True for each row; Spark refuses to read the broken texts of files without another of their columns.
    return read.where(F.coalesce(F.size("feeds"), F.lit(0)) >= -1).select("channel_id", "feeds", broken.alias("broken"), F.col("_metadata.file_name").alias("source"))


def parse_feed(payloads: DataFrame, payload: str = "payload", mode: str = "FAILFAST",
               more: list[str] = ()) -> DataFrame:
    """Responses held as text next to their ``channel_id`` and, if there is one, their ``source``; columns ``more`` stay.

    With PERMISSIVE a text that is no JSON is kept as ``broken``.
    """
    kept = "" if mode == "FAILFAST" else f", {BROKEN} string"
    parsed = F.from_json(payload, f"feeds {FEEDS}{kept}", {"mode": mode, "columnNameOfCorruptRecord": BROKEN})
    source = F.col("source") if "source" in payloads.columns else F.lit(None).cast("string")
    held = payloads.select("channel_id", parsed.alias("parsed"), source.alias("source"), *more)
    broken = F.lit(None).cast("string") if mode == "FAILFAST" else F.col(f"parsed.{BROKEN}")
    return held.select("channel_id", F.col("parsed.feeds").alias("feeds"), broken.alias("broken"), "source", *more)


def with_defaults(rows: DataFrame, ingested_at: Instant) -> DataFrame:
    """Insert defaults: ingest time, unprocessed, flag RAW.  Given values stay."""
    defaults = {"ingested_at": ntz(ingested_at), "is_processed": F.lit(False), "quality_flag": F.lit(S.RAW)}
    return rows.withColumns({name: F.coalesce(F.col(name), value) if name in rows.columns else value
                             for name, value in defaults.items()})


# Why an entry can't become a reading, or a response has no entries to read.
UNKNOWN_CHANNEL, BAD_TIME, TOO_LARGE, BAD_JSON = "UNKNOWN_CHANNEL", "BAD_TIME", "NUMBER_TOO_LARGE", "BAD_JSON"


def _entries(responses: DataFrame, channels: DataFrame, *more: str) -> DataFrame:
    """Each entry with the place, time and numbers it stands for, and ``reason`` where it can't be a reading.

    Entries are read where they stand in their response, before they become
    rows: each text is parsed once, and no filter on what was read repeats the
    parsing below it.
    """
    names = list(S.MEASURES)
    sources = F.array(*[F.try_element_at("source_of", F.lit(name)) for name in names])
    known = channels.select("channel_id", "site_id", "device_id", sources.alias("sources"), F.lit(True).alias("known"))

    def read(entry: Column) -> Column:
        texts = F.transform("sources", lambda source: F.try_element_at(entry, source))
        return F.struct(entry.alias("entry"), utc_naive(F.try_element_at(entry, F.lit("created_at"))).alias("collected_at"),
                        F.coalesce(F.transform(texts, safe_double), F.array().cast("array<double>")).alias("numbers"))

    # explode would add a filter on the array size below, parsing each payload again for it.
    rows = (responses.join(known, "channel_id", "left")
            .select("channel_id", "source", *more, "known", "site_id", "device_id",
                    F.explode_outer(F.transform("feeds", read)).alias("r"))
            .filter(F.col("r.entry").isNotNull()))
    taken = rows.select("channel_id", "source", *more, "known", "site_id", "device_id", "r.entry", "r.collected_at",
                        *[F.get("r.numbers", F.lit(i)).alias(name) for i, name in enumerate(names)])
    too_large = reduce(Column.__or__, [F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull()
                                       for name, kind in S.MEASURES.items()])
    return taken.withColumn("reason", F.when(F.col("known").isNull(), UNKNOWN_CHANNEL)
                            .when(F.col("collected_at").isNull(), BAD_TIME).when(too_large, TOO_LARGE))


def decoded_rows(responses: DataFrame, channels: DataFrame, *more: str) -> DataFrame:
    """The readings of ``decode_feed`` without insert defaults; columns ``more`` of the responses stay.

    The id is a digest of the reading, the same whenever the same response is decoded.
    """
    extra = [name for name in more if name != "source"]
    rows = _entries(responses, channels, *extra).filter(F.col("reason").isNull())
    values = ["site_id", "device_id", "collected_at", *S.MEASURES]
    rows = rows.select("site_id", "device_id", "collected_at", *more,
                       *[F.col(name).try_cast(kind).alias(name) for name, kind in S.MEASURES.items()])
    return rows.withColumn("id", F.xxhash64(*values))


def decode_feed(responses: DataFrame, channels: DataFrame, ingested_at: Instant) -> DataFrame:
    """Raw readings from responses; no or empty ``feeds`` gives no rows.

    The channel table is joined, not looped over, and is broadcast only when
    its size allows.  Columns without a mapped field are NULL.  The id is a
    digest of the reading, the same whenever the same response is decoded.
    Entries that can't be readings, and responses that can't be read, are in
    ``feed_rejects``.
    """
    return with_defaults(decoded_rows(responses, channels), ingested_at).select(*S.raw_schema().names)


def feed_rejects(responses: DataFrame, channels: DataFrame, ingested_at: Instant) -> DataFrame:
    """What ``decode_feed`` leaves out, with the reason.

    Entries as JSON: unknown channel, no readable time, or a number too large
    for its column; the first of these counts.  A number that can't be read is
    NULL, not a reason.  Whole responses as they came where they are no JSON.
    """
    entries = _entries(responses, channels).filter(F.col("reason").isNotNull()).select(
        "channel_id", F.to_json("entry").alias("entry"), "reason", "source")
    broken = responses.filter(F.col("broken").isNotNull()).select(
        "channel_id", F.col("broken").alias("entry"), F.lit(BAD_JSON).alias("reason"), "source")
    return entries.union(broken).withColumn("ingested_at", ntz(ingested_at))


def new_since(batch: DataFrame, existing: DataFrame, keys: list[str] = S.DEVICE,
              time: str = "collected_at") -> DataFrame:
    """Rows of ``batch`` later than the latest ``existing`` row of their key.

    A key without existing rows keeps all of its batch.
    """
    marks = existing.groupBy(*keys).agg(F.max(time).alias("high_water"))
    late = F.col("high_water").isNull() | (F.col(time) > F.col("high_water"))
    return join_figures(batch, marks, keys).filter(late).select(*batch.columns)

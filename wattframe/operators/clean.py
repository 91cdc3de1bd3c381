"""Validation and deduplication of raw readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattframe import schemas as S
from wattframe.functions import Instant, ntz


def _rejected(as_of: Instant) -> Column:
    power = F.col("active_power")
    return ((F.col("quality_flag") == S.ANOMALY) | power.isNull() | (power < 0)
            | (F.col("collected_at") > ntz(as_of)))


def clean_readings(raw: DataFrame, as_of: Instant) -> DataFrame:
    """Unprocessed readings fit for the fact table, duplicates still included.

    A NULL flag passes neither this test nor the rejection test: such a row
    stays unprocessed until the ingest default fills its flag.
    """
    power = F.col("active_power")
    return raw.filter(~F.col("is_processed")
                      & (F.col("quality_flag") != S.ANOMALY)
                      & power.isNotNull() & (power >= 0)
                      & (F.col("collected_at") <= ntz(as_of)))


def dedupe_readings(raw: DataFrame, as_of: Instant) -> DataFrame:
    """The latest ingested clean reading per (site, device, time), as fact rows.

    Equal ingest times fall to the higher id, so a winner is stable.  ``rn = 1``
    lets Spark keep one row per key in each map task before the shuffle, so
    many copies of one reading never travel together.  The time, of which there
    are the most values, leads the sort.
    """
    latest = W.partitionBy(*reversed(S.RAW_GRAIN)).orderBy(F.desc("ingested_at"), F.desc("id"))
    return (clean_readings(raw, as_of)
            .withColumn("rn", F.row_number().over(latest))
            .filter(F.col("rn") == 1)
            .select(*S.DEVICE, F.col("collected_at").alias("reading_time"),
                    *S.MEASURES, F.col("id").alias("raw_reading_id")))


def mark_rejected(raw: DataFrame, as_of: Instant) -> DataFrame:
    """Unprocessed bad readings get their reason as flag and count as processed."""
    power = F.col("active_power")
    hit = ~F.col("is_processed") & _rejected(as_of)
    reason = (F.when(F.col("quality_flag") == S.ANOMALY, S.ANOMALY)
              .when(power.isNull(), S.REJECTED_NULL)
              .when(power < 0, S.REJECTED_NEGATIVE)
              .otherwise(S.REJECTED_FUTURE))
    return raw.withColumns({
        "quality_flag": F.when(hit, reason).otherwise(F.col("quality_flag")),
        "is_processed": F.when(hit, True).otherwise(F.col("is_processed")),
    })


def mark_processed(raw: DataFrame, winners: DataFrame) -> DataFrame:
    """Raw readings whose id was taken into the fact table count as processed."""
    taken = winners.select(*S.DEVICE, F.col("reading_time").alias("collected_at"),
                           F.col("raw_reading_id").alias("id"), F.lit(True).alias("taken"))
    return (raw.join(taken, ["id", *S.RAW_GRAIN], "left")
            .withColumn("is_processed", F.col("is_processed") | F.coalesce("taken", F.lit(False)))
            .select(*raw.columns))


def settled_at(raw: DataFrame, as_of: Column) -> DataFrame:
    """Marks rows as ``settle`` does at the time in ``as_of``; rows where it is NULL stay as they are."""
    marks = ("is_processed", "quality_flag")
    both = settle(raw.withColumns({f"_{c}": F.col(c) for c in marks}), as_of)
    return both.select(*[F.when(as_of.isNull(), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in marks else c
                         for c in raw.columns])


def settle(raw: DataFrame, as_of: Instant) -> DataFrame:
    """One pass over raw that marks winners, losers and rejects together.

    Every clean reading is either the winner of its key or a loser consumed in
    the same run, so neither a join with the winners nor a shuffle is needed,
    and a loser can never come back to replace a winner.
    """
    clean = ~F.col("is_processed") & ~_rejected(as_of)
    return mark_rejected(
        raw.withColumn("is_processed", F.col("is_processed") | F.coalesce(clean, F.lit(False))), as_of)

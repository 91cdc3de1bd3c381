"""Joining per-key figures back to rows of very uneven keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPREAD = 8
MOST_BROADCAST = 1_000_000  # keys; about 60 MB in each executor


def join_figures(rows: DataFrame, figures: DataFrame, keys: list[str], spread: int = SPREAD,
                 salt_by: list[str] | None = None) -> DataFrame:
    """Left join of ``figures``, one row per key, to ``rows``.

    Figures that were grouped by the same keys are already partitioned by
    them, and Spark would join without a second shuffle; but then adaptive
    execution cannot split a key that holds a large share of the rows.  A
    salt taken from the row's content spreads such a key and makes Spark
    shuffle both sides for the join, so what is still too large is split at
    run time.  Only figures, small beside the rows, are repeated.  Figures
    small enough are broadcast all the same.  ``salt_by`` names the columns the
    salt is taken from, so that a narrow read of the rows stays narrow.
    """
    salted = figures.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    salt = F.pmod(F.xxhash64(*(salt_by or rows.columns)), F.lit(spread)).cast("int")
    return rows.withColumn("salt", salt).join(salted, [*keys, "salt"], "left").drop("salt")


def join_stored_figures(rows: DataFrame, figures: DataFrame, keys: list[str], salt_by: list[str],
                        most: int = MOST_BROADCAST) -> DataFrame:
    """``join_figures`` with figures that are a written table: broadcast up to ``most`` of them.

    Spark's own limit of 10 MB is reached by some 400,000 keys with two figures,
    and from there on all rows, as wide as they are, would be shuffled.  A
    session that has turned broadcasting off is obeyed.
    """
    allowed = not figures.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")
    if allowed and figures.count() <= most:
        return rows.join(F.broadcast(figures), keys, "left")
    return join_figures(rows, figures, keys, salt_by=salt_by)

"""Table constraints as audits: Parquet enforces none of them."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Contract:
    """What a table promises: unique key, filled columns, references, decimal sizes."""

    unique: list[str] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    references: dict[str, DataFrame] = field(default_factory=dict)
    decimals: dict[str, T.DecimalType] = field(default_factory=dict)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def orphan_keys(df: DataFrame, key: str, parent: DataFrame) -> DataFrame:
    """Key values of ``df`` unknown to ``parent``, with their row count.

    Rows are counted per key before the join, so a hot key costs one row.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("orphan_rows"))
    return counts.join(parent.select(key), key, "left_anti")


def tag_orphans(df: DataFrame, key: str, parent: DataFrame) -> DataFrame:
    """``df`` plus ``is_orphan``: its key has no parent.  A NULL key refers to none.

    The parent's key is unique.  It is joined as it is stored, not reduced
    first, so that a key with too many rows can be split at run time.
    """
    known = parent.select(key, F.lit(True).alias("known"))
    orphan = F.col(key).isNotNull() & F.col("known").isNull()
    return df.join(known, key, "left").select(*df.columns, orphan.alias("is_orphan"))


def quarantine(df: DataFrame, key: str, parent: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, orphans): rows with and without a parent."""
    tagged = tag_orphans(df, key, parent)
    return (tagged.filter(~F.col("is_orphan")).drop("is_orphan"),
            tagged.filter("is_orphan").drop("is_orphan"))


def _filled(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def _overflow(column: str, kind: T.DecimalType) -> Column:
    return F.count_if(F.col(column).isNotNull() & F.col(column).try_cast(kind).isNull())


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, null_rows) per column from one scan."""
    return df.agg(*(_filled(c).alias(c) for c in columns)).unpivot([], columns, "column_name", "null_rows")


def decimal_overflows(df: DataFrame, sizes: dict[str, T.DecimalType]) -> DataFrame:
    """(column_name, overflow_rows): values too large for their column."""
    row = df.agg(*(_overflow(c, kind).alias(c) for c, kind in sizes.items()))
    return row.unpivot([], list(sizes), "column_name", "overflow_rows")


def _violations(constraint: str, subject: str, count: Column) -> Column:
    return F.struct(F.lit(constraint).alias("constraint"), F.lit(subject).alias("subject"),
                    F.coalesce(count, F.lit(0)).cast("bigint").alias("violations"))


def audit(df: DataFrame, contract: Contract) -> DataFrame:
    """(constraint, subject, violations) for every promise of the contract.

    Column checks share one scan; keys and references are counted per key first.
    """
    parts = []
    if contract.unique:
        parts.append(duplicate_keys(df, contract.unique).agg(
            _violations("unique", ",".join(contract.unique), F.sum(F.col("copies") - 1)).alias("v")))
    columns = [*(_violations("not_null", c, _filled(c)) for c in contract.not_null),
               *(_violations("decimal", c, _overflow(c, kind)) for c, kind in contract.decimals.items())]
    if columns:
        parts.append(df.agg(F.array(*columns).alias("all")).select(F.explode("all").alias("v")))
    for key, parent in contract.references.items():
        parts.append(orphan_keys(df, key, parent).agg(
            _violations("reference", key, F.sum("orphan_rows")).alias("v")))
    return reduce(DataFrame.unionByName, parts).select("v.*")

"""Replace-or-add by key."""

from __future__ import annotations

from pyspark.sql import DataFrame


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` with every row of ``source`` added or put in place of its key.

    Keys are unique on both sides, so no key group can grow hot.  A small
    source is broadcast by size at run time and the target is not shuffled.
    Columns that ``source`` lacks become NULL in its rows.
    """
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.select(*target.columns).unionByName(source, allowMissingColumns=True)

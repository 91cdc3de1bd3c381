"""Small tables held by the driver program."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def small_table(spark: SparkSession, rows: list[tuple], names: list[str], **kinds: pa.DataType) -> DataFrame:
    """Rows as a local relation, whose known size lets Spark broadcast it.

    Rows handed over as Python objects would have no known size, and a join
    with them would shuffle its large side.
    """
    columns = zip(*rows) if rows else ([] for _ in names)
    return spark.createDataFrame(pa.table(
        {name: pa.array(list(values), kinds.get(name)) for name, values in zip(names, columns)}))

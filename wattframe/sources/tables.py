"""Stored layers: reading, appending, replacing and merging Parquet tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe import schemas as S
from wattframe.functions import Instant, day_of, ntz, part_number, trailing_cutoff
from wattframe.operators.clean import settled_at
from wattframe.operators.merge import upsert
from wattframe.sources.small import small_table


MOST_FOLDERS = 1000


class Warehouse:
    """The layers below one root folder.  One writer at a time.

    Raw is only ever appended to; the ledger names the files that runs have taken.
    Every other change replaces whole partitions through the dynamic-overwrite commit,
    so lost executors only repeat tasks and a failed run is simply run again.
    ``grain`` sets how large a partition is: by the day, or by the hour where an
    hour alone fills files of good size and a day is too much to rewrite per run.
    """

    def __init__(self, spark: SparkSession, root: str, key: T.DataType = S.STRING, grain: str = "day"):
        if grain not in ("day", "hour"):
            raise ValueError(f"grain must be day or hour, not {grain}")
        self.spark, self.root, self.key, self.grain = spark, root.rstrip("/"), key, grain

    def shifted(self, part: int, days: int) -> int:
        """The partition that lies ``days`` away."""
        pattern = "%Y%m%d%H" if self.grain == "hour" else "%Y%m%d"
        return int((datetime.strptime(str(part), pattern) + timedelta(days=days)).strftime(pattern))

    def day_parts(self, parts: list[int]) -> list[int]:
        """All partitions of the days that ``parts`` lie in."""
        if self.grain == "day":
            return parts
        return [day * 100 + hour for day in sorted({p // 100 for p in parts}) for hour in range(24)]

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def schema(self, name: str) -> T.StructType:
        """Column types of a layer, its partition column included."""
        layer = S.LAYERS[name]
        schema = layer.schema(self.key)
        if layer.part and layer.part not in schema.names:
            schema = T.StructType([*schema.fields, T.StructField(layer.part, T.IntegerType())])
        return schema

    def read(self, name: str, parts: list | None = None, since=None, before=None, marked: bool = True) -> DataFrame:
        """A layer with its partition column; a layer never written is empty.

        ``parts`` lists partitions, ``since`` and ``before`` bound them; all
        three prune folders before any file is opened.  A short list is read by
        its folders alone, without listing the files of the whole history.
        Raw rows come with the marks of the run that took them unless ``marked`` is false.
        """
        layer, schema, path = S.LAYERS[name], self.schema(name), self.path(name)
        reader, wanted = self.spark.read.schema(schema).option("basePath", path), path
        if parts is not None and len(parts) <= MOST_FOLDERS:
            wanted = f"{path}/{{{','.join(f'{layer.part}={p}' for p in parts)}}}"
        try:
            df = reader.parquet(wanted).selectExpr(*schema.names, *(["_metadata.file_name as _file"] if name == "raw" else []))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.range(1).selectExpr(*S.casts(schema, [])).filter("false")
        if parts is not None and wanted == path:
            df = df.filter(F.col(layer.part).isin(parts))
        if since is not None:
            df = df.filter(F.col(layer.part) >= since)
        if before is not None:
            df = df.filter(F.col(layer.part) < before)
        if name != "raw":
            return df
        return self._standing(df) if marked else df.drop("_file")

    def _standing(self, rows: DataFrame) -> DataFrame:
        """Raw rows with the marks of the run that took their file; the stored rows never change."""
        taken = self.read("ledger").groupBy("file").agg(F.min("as_of").alias("_as_of"))
        joined = rows.join(taken, rows["_file"] == taken["file"], "left").drop("file", "_file")
        return settled_at(joined, F.col("_as_of")).drop("_as_of")

    def unconsumed(self, since=None) -> list[str]:
        """The raw files that no run has taken yet, from partition ``since`` on.

        What a run works on is fixed by this list: rows that arrive later are
        in other files and wait for the next run.
        """
        try:
            stored = self.spark.read.schema(self.schema("raw")).parquet(self.path("raw"))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        if since is not None:
            parts = [p for p in (int(row[0]) for row in stored.select(S.LAYERS["raw"].part).distinct().collect())
                     if p >= since]
            if not parts:
                return []
            stored = self.spark.read.schema(self.schema("raw")).option("basePath", self.path("raw")).parquet(
                *[f"{self.path('raw')}/{S.LAYERS['raw'].part}={p}" for p in parts])
        taken = {row[0] for row in self.read("ledger").collect()}
        return sorted(f for f in stored.inputFiles() if f.rsplit("/", 1)[-1] not in taken)

    def raw_files(self, files: list[str]) -> DataFrame:
        """The rows of these raw files as they were written."""
        if not files:
            return self.spark.range(1).selectExpr(*S.casts(self.schema("raw"), [])).filter("false")
        return (self.spark.read.schema(self.schema("raw")).option("basePath", self.path("raw")).parquet(*files)
                .select(*self.schema("raw").names))

    def consume(self, files: list[str], as_of: Instant) -> None:
        """Notes that a run as of ``as_of`` has taken these files."""
        if files:
            names = small_table(self.spark, [(f.rsplit("/", 1)[-1],) for f in files], ["file"])
            self.append("ledger", names.withColumn("as_of", ntz(as_of)))

    def recent(self, name: str, as_of: Instant, lookback: str, floor: str | None = None) -> DataFrame:
        """The partitions an operator with this lookback can need; it still filters rows itself.

        ``floor`` widens the reach to whole hours or days, as aligned rollups do.
        """
        return self.read(name, since=part_number(trailing_cutoff(as_of, lookback, floor), self.grain))

    def placed(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` in the column order and types of the layer, partition column filled.

        Columns that ``df`` lacks are NULL.
        """
        layer = S.LAYERS[name]
        if layer.part and layer.time:
            df = df.withColumn(layer.part, part_number(F.col(layer.time), self.grain))
        return df.selectExpr(*S.casts(self.schema(name), df.columns))

    def folders(self, name: str, start: Instant | None = None, end: Instant | None = None) -> list:
        """The partitions of a layer between two days, both included, the newest first.

        Only the names of the folders are listed, neither their files nor their rows.
        """
        layer, root = S.LAYERS[name], self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        store = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in store.listStatus(root)] if store.exists(root) else []
        values = [n.split("=", 1)[1] for n in names if n.startswith(f"{layer.part}=")]
        kind = self.schema(name)[layer.part].dataType
        if isinstance(kind, T.DateType):
            placed = {v: int(v.replace("-", "")) for v in values}
        else:
            values = [int(v) for v in values]
            placed = {v: v // 100 if self.grain == "hour" else v for v in values}
        low, high = (None if day is None else self.spark.range(1).select(
            part_number(day_of(day), "day")).first()[0] for day in (start, end))
        return sorted((v for v in values if (low is None or placed[v] >= low) and (high is None or placed[v] <= high)),
                      key=placed.get if isinstance(kind, T.DateType) else None, reverse=True)

    def parts(self, name: str, df: DataFrame) -> list:
        """The partitions ``df`` falls into: at most one value per day or hour.

        Rows read from the layer carry their partition, so no other column is read.
        """
        part = S.LAYERS[name].part
        placed = df if part in df.columns else self.placed(name, df)
        return sorted(row[0] for row in placed.select(part).distinct().collect())

    def _write(self, name: str, df: DataFrame, mode: str) -> None:
        part = S.LAYERS[name].part
        rows = self.placed(name, df)
        if part is None:
            rows.write.mode(mode).parquet(self.path(name))
            return
        # Rebalancing gathers each partition's rows into few files and splits a large one.
        (rows.hint("rebalance", part).write.mode(mode)
         .option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(self.path(name)))

    def append(self, name: str, df: DataFrame) -> None:
        self._write(name, df, "append")

    def replace(self, name: str, df: DataFrame) -> None:
        """Replaces the partitions that occur in ``df``, which must hold them in full."""
        self._write(name, df, "overwrite")

    def merge(self, name: str, source: DataFrame) -> None:
        """Upserts a stored ``source`` by the layer's grain, touching only its partitions.

        A layer without partitions is rewritten from a staged copy.
        """
        layer = S.LAYERS[name]
        parts = self.parts(name, source) if layer.part else None
        if parts == []:
            return
        merged = upsert(self.read(name, parts), self.placed(name, source), layer.grain)
        self.replace(name, merged if layer.part else self.stage(f"new_{name}", merged))

    def stage(self, name: str, df: DataFrame) -> DataFrame:
        """Writes a result that several later steps read, and returns the written table.

        The folder is reused by the next run, so at most one copy is kept.  A
        micro-batch is staged first thing: its own session runs without adaptive
        execution, whereas the table comes back in the session of the warehouse.
        """
        path = f"{self.root}/_staged/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

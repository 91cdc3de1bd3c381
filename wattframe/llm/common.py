"""Helpers shared by the text operators: staging, distributed ranks, connected components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattframe.session import shared_folder

WORD_SPACE = "[\\x20\\x09-\\x0D]+"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the cluster's shared folder and read back.

    It cuts the lineage, survives lost executors and computes ``df`` once.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_text(docs: DataFrame, encoded: bool = False) -> DataFrame:
    """Only doc_id and text (null: empty), as UTF-8 bytes if asked for; other columns can't clash."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (text.cast("binary") if encoded else text).alias("text"))


def row_key(docs: DataFrame, *more: str, source: str = "") -> Column:
    """doc_id, a digest of the text (null: empty) and of the columns ``more`` as one value that is never null."""
    def of(name: str) -> Column:
        return F.col(f"{source}{name}")

    digests = [F.md5(F.coalesce(of("text").cast("string"), F.lit("")).cast("binary"))]
    digests += [F.coalesce(F.md5(of(c).cast("string").cast("binary")), F.lit("-")) for c in more if c in docs.columns]
    return F.concat_ws("/", F.coalesce(of("doc_id").cast("long").cast("string"), F.lit("-")), *digests)


def ranked(df: DataFrame, groups: list[str], order: list[str], rows: int, per: int = 5000) -> DataFrame:
    """Adds ``rank``, gapless from 0 within each group, without a sort of a whole group.

    Rows are dealt by hash to buckets of about ``per`` rows; a bucket's rank
    starts after the counts of those before it.  Only counts meet in one task.
    """
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(rows // per + 1)))
    counts = dealt.groupBy(*groups, "_bucket").agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*groups, "_bucket",
                           F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*groups, "_bucket").orderBy(*order)
    return (dealt.withColumn("_within", F.row_number().over(within) - 1)
            .join(starts, [*groups, "_bucket"])
            .withColumn("rank", (F.col("_start") + F.col("_within")).cast("long"))
            .drop("_bucket", "_start", "_within"))


def thinned(edges: DataFrame) -> DataFrame:
    """Fewer edges (a < b) with the same components.

    Each b is tied to its smallest a; any other edge is moved to the smallest
    of its ends, where those of a dense group become one and the same.
    """
    edges = staged(edges.distinct(), "edges")
    near = staged(edges.groupBy("b").agg(F.min("a").alias("least")), "near")
    low = edges.join(near.select(F.col("b").alias("a"), F.col("least").alias("x")), "a", "left")
    moved = (low.join(near.select("b", F.col("least").alias("y")), "b")
             .select(F.coalesce("x", "a").alias("x"), "y").where("x <> y").distinct())
    return near.select(F.col("least").alias("a"), "b").union(
        moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for the ends of ``edges`` (a, b): root is the smallest node reachable.

    Each round takes the smallest label among the neighbours and then the label
    of that label, so long chains shrink by halves.  Labels are staged per round.
    """
    both = staged(edges.select(F.col("a"), F.col("b"))
                  .union(edges.select(F.col("b"), F.col("a"))).distinct(), "edges")
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                    .select("node", F.least("node", "m").alias("root")), "labels")
    for _ in range(most_rounds):
        near = (both.join(labels.select(F.col("node").alias("b"), "root"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("least")))
        lower = labels.join(near, "node").select(
            "node", F.col("root").alias("was"), F.least("root", "least").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("next"))
        after = staged(lower.join(jump, "root").select("node", "was", F.col("next").alias("root")), "labels")
        changed = after.where("root <> was").limit(1).count()
        labels = after.select("node", "root")
        if not changed:
            return labels
    raise RuntimeError("components did not settle; raise most_rounds")


def rows_of(batches: Iterable[pa.RecordBatch], most_bytes: int) -> Iterator[tuple[list, ...]]:
    """Batches regrouped to chunks of at most ``most_bytes`` of their last column, one row at least."""
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns[:-1]]
        last = batch.column(batch.num_columns - 1)
        start, size = 0, 0
        for i in range(batch.num_rows):
            size += len(last[i].as_buffer() or b"") if last[i].is_valid else 0
            if size >= most_bytes or i + 1 == batch.num_rows:
                yield (*[c[start:i + 1] for c in columns], last.slice(start, i + 1 - start).to_pylist())
                start, size = i + 1, 0


def hex16(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")

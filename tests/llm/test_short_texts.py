"""Verdicts on short texts follow the labels as those on long ones do."""

from pyspark.sql import functions as F

from wattframe.llm import classifier
from wattframe.llm import queries as Q


def test_bad_short_texts_go(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = (Q.QUERIES["op4_quality"](spark, folder).where("not base_failed and n_words < 150").join(labels, "doc_id")
            .withColumn("held", classifier.remainder(F.col("doc_id")) == 0).collect())
    for held in (False, True):  # the limits were chosen on labels outside the held-out fold
        good = [r.kept for r in rows if r.held == held and r.quality == 1]
        bad = [r.kept for r in rows if r.held == held and r.quality == 0]
        assert sum(good) >= 0.99 * len(good)
        assert sum(bad) <= 0.2 * len(bad)

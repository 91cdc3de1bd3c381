from helpers import raw, rows
from pyspark.sql import functions as F

from wattframe.operators.joins import join_figures
from wattframe.session import fit_shuffles, shared_folder, streaming_session
from wattframe.sources.feed import with_defaults


def test_every_row_keeps_its_figures(spark):
    made = spark.createDataFrame([(i % 3, i) for i in range(30)], "k int, v int")
    figures = made.filter("k < 2").groupBy("k").agg(F.sum("v").alias("total"))
    joined = join_figures(made, figures, ["k"])
    assert joined.columns == ["k", "v", "total"] and joined.count() == 30
    assert rows(joined.distinct(), "k", "total", order=["k", "total"])[0] == (0, 135)
    assert joined.filter("k = 2 and total is null").count() == 10


def test_a_key_with_most_rows_is_split(spark):
    session = spark.newSession()
    for key, value in (("autoBroadcastJoinThreshold", "-1"),
                       ("adaptive.skewJoin.skewedPartitionThresholdInBytes", "20k"),
                       ("adaptive.advisoryPartitionSizeInBytes", "10k"), ("shuffle.partitions", "16")):
        session.conf.set(f"spark.sql.{key}", value)
    made = session.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 10 > 0, 0).otherwise(F.col("id")).alias("k"), "id")
    joined = join_figures(made, made.groupBy("k").agg(F.count("*").alias("n")), ["k"], spread=2)
    assert joined.filter("k = 0 and n > 1000").count() == 180_001
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan


def test_shuffles_grow_with_the_input_and_never_shrink(spark):
    session = spark.newSession()
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    fit_shuffles(session.range(1000))
    assert session.conf.get(key, None) is None
    fit_shuffles(session.range(10 ** 9))
    grown = int(session.conf.get(key))
    fit_shuffles(session.range(1000))
    assert grown > 4 and int(session.conf.get(key)) == grown


def test_stream_sessions_leave_the_caller_alone(spark):
    caller = spark.newSession()
    caller.conf.set("spark.sql.session.timeZone", "Asia/Taipei")
    assert streaming_session(caller).conf.get("spark.sql.session.timeZone") == "UTC"
    assert caller.conf.get("spark.sql.session.timeZone") == "Asia/Taipei"


def test_shared_folder_lies_below_the_configured_one(spark):
    one, two = shared_folder(spark), shared_folder(spark)
    assert one != two and one.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_insert_defaults_keep_given_values(spark):
    made = raw(spark, [{"quality_flag": None}, {"quality_flag": "ANOMALY", "is_processed": True}])
    filled = with_defaults(made, "2026-01-01")
    assert rows(filled, "id", "is_processed", "quality_flag") == [(1, False, "RAW"), (2, True, "ANOMALY")]
    assert rows(filled, "ingested_at") == rows(made, "ingested_at")

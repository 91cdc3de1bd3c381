from datetime import datetime, timedelta

import pytest
from helpers import raw, rows
from pyspark.sql import functions as F
from test_pipeline import TICKS, content, story

from wattframe import schemas as S
from wattframe.operators.clean import dedupe_readings
from wattframe.operators.rollup import hourly
from wattframe.plans.pipeline import days_from_raw, readings_from_raw
from wattframe.session import streaming_session
from wattframe.sources.tables import Warehouse
from wattframe.streaming import jobs

NOW = TICKS[-1]


def source(child, folder, frames, schema):
    """A file stream that hands out one frame per micro-batch, in order."""
    for number, frame in enumerate(frames):
        frame.coalesce(1).write.parquet(str(folder / f"in/{number:03}"))
    import os
    for number in range(len(frames)):
        for name in os.listdir(folder / f"in/{number:03}"):
            if name.endswith(".parquet"):
                os.utime(folder / f"in/{number:03}/{name}", (1_000_000 + number, 1_000_000 + number))
    return (child.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .parquet(str(folder / "in/*")))


def split(df, column, *cuts):
    edges = ["1900-01-01", *cuts, "2999-01-01"]
    return [df.filter((F.col(column) > low) & (F.col(column) <= high)) for low, high in zip(edges, edges[1:])]


@pytest.fixture(scope="module")
def child(spark):
    return streaming_session(spark)


def test_clean_stream_equals_batch(spark, child, tmp_path):
    made = raw(spark, story(5)[:60])
    tables = Warehouse(child, str(tmp_path / "out"))
    stream = source(child, tmp_path, split(made, "ingested_at", *TICKS[:3]), S.raw_schema())
    jobs.stream_clean(stream, tables, str(tmp_path / "cp"), lambda: NOW).awaitTermination()
    expected = dedupe_readings(made, NOW)
    assert rows(tables.read("readings"), *expected.columns) == rows(expected, *expected.columns)


def test_delta_stream_equals_batch_with_late_rows_and_rollups(spark, child, tmp_path):
    made = raw(spark, story(6)[:60])
    tables = Warehouse(child, str(tmp_path / "out"))
    stream = source(child, tmp_path, split(made, "ingested_at", *TICKS[:3]), S.raw_schema())
    jobs.stream_energy_delta(stream, tables, str(tmp_path / "cp"), lambda: NOW, rollups=True).awaitTermination()
    for name, expected in (("readings", readings_from_raw(made, NOW)), ("daily", days_from_raw(made, NOW))):
        layer = S.LAYERS[name]
        assert content(tables, name) == rows(expected, *layer.schema().names, order=layer.grain)


def minute_facts(spark, times):
    made = raw(spark, [{"collected_at": str(t), "energy_kwh": i, "active_power": i} for i, t in enumerate(times)])
    return readings_from_raw(made, NOW)


def test_hourly_stream_equals_batch_and_drops_only_beyond_lateness(spark, child, tmp_path):
    start = datetime(2026, 3, 27, 6)
    facts = minute_facts(spark, [start + timedelta(minutes=7 * i) for i in range(60)])
    early, middle, end = split(facts, "reading_time", "2026-03-27 08:00:00", "2026-03-27 12:00:00")
    slightly_late = middle.filter("minute(reading_time) = 28")
    too_late = minute_facts(spark, [datetime(2026, 3, 27, 1)])
    frames = [early, middle.exceptAll(slightly_late), end.unionByName(slightly_late), too_late]
    tables = Warehouse(child, str(tmp_path / "out"))
    stream = source(child, tmp_path, frames, S.fact_schema())
    jobs.stream_hourly(stream, tables, str(tmp_path / "cp")).awaitTermination()
    expected = hourly(facts, lookback=None)
    assert content(tables, "hourly") == rows(expected, *S.hourly_schema().names, order=S.HOUR_GRAIN)


def test_hourly_stream_leaves_out_unknown_sites(spark, child, tmp_path):
    facts = minute_facts(spark, [datetime(2026, 3, 27, 6)])
    facts = facts.unionByName(facts.withColumn("site_id", F.lit("S2")))
    sites = child.createDataFrame([("S1", "one")], "site_id string, site_name string")
    tables = Warehouse(child, str(tmp_path / "out"))
    stream = source(child, tmp_path, [facts], S.fact_schema())
    jobs.stream_hourly(stream, tables, str(tmp_path / "cp"), sites).awaitTermination()
    assert rows(tables.read("hourly"), "site_id") == [("S1",)]


def test_quality_stream_equals_the_same_windows_in_batch(spark, child, tmp_path):
    made = raw(child, story(7)[:80]).orderBy("ingested_at")
    tables = Warehouse(child, str(tmp_path / "out"))
    stream = source(child, tmp_path, split(made, "ingested_at", *TICKS[:3]), S.raw_schema())
    jobs.stream_quality(stream, tables, str(tmp_path / "cp")).awaitTermination()
    expected = jobs.sliding_counts(made.withColumn("event_time", F.col("ingested_at").cast("timestamp")))
    names = S.windows_schema().names
    assert rows(tables.read("quality_windows"), *names) == rows(expected, *names)


def test_restarted_stream_reads_only_what_is_new(spark, child, tmp_path):
    frames = [raw(spark, [{"id": 1}]), raw(spark, [{"id": 2, "device_id": "D2"}])]
    tables = Warehouse(child, str(tmp_path / "out"))
    seen = []
    def clock():
        seen.append(1)
        return NOW
    for until in (1, 2):
        frames[until - 1].coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = child.readStream.schema(S.raw_schema()).parquet(str(tmp_path / "in"))
        jobs.stream_clean(stream, tables, str(tmp_path / "cp"), clock).awaitTermination()
    assert len(seen) == 2 and tables.read("readings").count() == 2


def test_site_names_join_a_stream(spark, child, tmp_path):
    stream = source(child, tmp_path, [raw(spark, [{}, {"site_id": "S9"}])], S.raw_schema())
    sites = child.createDataFrame([("S1", "one")], "site_id string, site_name string")
    named = jobs.with_site_name(stream, sites)
    query = named.writeStream.format("memory").queryName("named").trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows(child.table("named"), "site_id", "site_name") == [("S1", "one"), ("S9", None)]


def test_event_time_streams_insist_on_utc(spark, tmp_path):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Taipei")
    stream = other.readStream.schema(S.raw_schema()).parquet(str(tmp_path))
    with pytest.raises(ValueError):
        jobs.stream_quality(stream, Warehouse(other, str(tmp_path)), str(tmp_path / "cp"))

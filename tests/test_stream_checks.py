"""The stream of all six checks against batch runs as of each full hour."""

from datetime import datetime, timedelta

import pytest
from helpers import raw, rows
from test_streaming import source

from wattframe import schemas as S
from wattframe.operators.quality import run_checks
from wattframe.session import streaming_session
from wattframe.sources.tables import Warehouse
from wattframe.streaming.checks import stream_quality_log

FIRST = datetime(2026, 3, 27, 7)
LOGGED = ["check_time", "check_type", "status", "metric_value", "threshold_value", "message"]


@pytest.fixture(scope="module")
def child(spark):
    return streaming_session(spark)


def devices(spark, *items):
    return spark.createDataFrame(list(items), "device_id string, is_active boolean")


KNOWN = (("D1", True), ("D2", True), ("D3", True), ("NEVER", True), ("OFF", False))


def readings(spark):
    """Copies, odd values and times on the edges of hours and of their last ten minutes."""
    made, at = [], FIRST - timedelta(hours=2)
    for i in range(150):
        at += timedelta(minutes=3, seconds=20 * (i % 4))
        made.append({"device_id": f"D{1 + i % 2}", "collected_at": str(at - timedelta(minutes=i % 3)),
                     "ingested_at": str(at), "active_power": None if i % 9 == 0 else -1 if i % 11 == 0 else 5,
                     "voltage_avg": 300 if i % 13 == 0 else 220})
    last = made[-1]["ingested_at"]
    for hour in range(7, 15):
        edge = datetime(2026, 3, 27, hour)
        for offset in (0, 1, -1):  # microseconds
            shifted = edge + timedelta(microseconds=offset)
            made.append({"device_id": "D3" if hour % 2 else "OFF", "collected_at": str(edge), "ingested_at": str(shifted)})
        made.append({"device_id": "D1", "collected_at": str(edge + timedelta(hours=3)), "ingested_at": str(edge)})
        made.append({"device_id": "D3", "collected_at": "2026-03-27 06:00:00",
                     "ingested_at": str(edge - timedelta(minutes=10, microseconds=hour % 2))})
    made += [{"device_id": None, "ingested_at": "2026-03-27 08:30:00"}] * 2
    made += [{"device_id": "STRANGE", "ingested_at": "2026-03-27 08:59:00"}]
    return raw(spark, [r for r in made if r["ingested_at"] <= last])


def batch_log(spark, made, known, hours):
    return [r for hour in hours for r in rows(run_checks(known, made, str(hour)), *LOGGED, order=["check_type"])]


def logged(tables):
    return rows(tables.read("quality_stream"), *LOGGED, order=["check_time", "check_type"])


@pytest.mark.parametrize("cuts", [[], ["2026-03-27 07:10:00", "2026-03-27 09:00:00", "2026-03-27 11:59:59"]])
def test_equals_batch_runs_at_each_hour(spark, child, tmp_path, cuts):
    made, known = readings(child), devices(child, *KNOWN)
    edges = ["1900-01-01", *cuts, "2999-01-01"]
    frames = [made.filter(f"ingested_at > '{a}' and ingested_at <= '{b}'") for a, b in zip(edges, edges[1:])]
    tables = Warehouse(child, str(tmp_path / "out"))
    stream = source(child, tmp_path, frames, S.raw_schema())
    stream_quality_log(stream, known, tables, str(tmp_path / "cp"), str(FIRST)).awaitTermination()
    last = max(r[0] for r in rows(made, "ingested_at")) - timedelta(hours=3)
    hours = [FIRST + timedelta(hours=h) for h in range(24) if FIRST + timedelta(hours=h) < last]
    assert len(hours) > 2
    assert logged(tables) == batch_log(spark, made, known, hours)


def test_silence_is_logged_for_hours_without_any_reading(spark, child, tmp_path):
    made = raw(child, [{"ingested_at": "2026-03-27 07:55:00"}, {"ingested_at": "2026-03-27 18:00:00"}])
    known = devices(child, ("D1", True), ("D2", True))
    tables = Warehouse(child, str(tmp_path / "out"))
    stream = source(child, tmp_path, [made], S.raw_schema())
    stream_quality_log(stream, known, tables, str(tmp_path / "cp"), "2026-03-27 07:30:00").awaitTermination()
    hours = [datetime(2026, 3, 27, h) for h in range(8, 15)]
    assert logged(tables) == batch_log(spark, made, known, hours)
    gaps = rows(tables.read("quality_stream").filter("check_type = 'INGESTION_GAP'"), "check_time", "metric_value")
    assert [int(n) for _, n in gaps] == [1, 2, 2, 2, 2, 2, 2]


def test_state_survives_a_restart(spark, child, tmp_path):
    made, known = readings(child), devices(child, *KNOWN)
    tables = Warehouse(child, str(tmp_path / "out"))
    for low, high in (("1900-01-01", "2026-03-27 09:20:00"), ("2026-03-27 09:20:00", "2999-01-01")):
        made.filter(f"ingested_at > '{low}' and ingested_at <= '{high}'").write.mode("append").parquet(str(tmp_path / "in"))
        stream = child.readStream.schema(S.raw_schema()).parquet(str(tmp_path / "in"))
        stream_quality_log(stream, known, tables, str(tmp_path / "cp"), str(FIRST)).awaitTermination()
    last = max(r[0] for r in rows(made, "ingested_at")) - timedelta(hours=3)
    hours = [FIRST + timedelta(hours=h) for h in range(24) if FIRST + timedelta(hours=h) < last]
    assert logged(tables) == batch_log(spark, made, known, hours)


def test_needs_utc(spark, tmp_path):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Taipei")
    stream = other.readStream.schema(S.raw_schema()).parquet(str(tmp_path))
    with pytest.raises(ValueError):
        stream_quality_log(stream, devices(other), Warehouse(other, str(tmp_path)), str(tmp_path / "cp"), str(FIRST))

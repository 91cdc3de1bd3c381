import random
from datetime import datetime, timedelta

import pytest
from helpers import raw, rows
from pyspark.sql import functions as F

from wattframe import schemas as S
from wattframe.operators.clean import dedupe_readings
from wattframe.plans.pipeline import absorb, days_from_raw, hours_from_raw, readings_from_raw, run_pipeline, run_quality
from wattframe.sources.tables import Warehouse

TICKS = ["2026-03-27 10:20:00", "2026-03-27 10:30:00", "2026-03-28 09:00:00", "2026-04-02 00:10:00"]


def story(seed):
    """Readings with copies, late arrivals, bad values, resets and long silences."""
    chance, made = random.Random(seed), []
    start = datetime(2026, 3, 27, 8)
    for device in ("D1", "D2", "D3"):
        time, meter = start, 0.0
        while time < datetime(2026, 4, 2):
            meter = 0.0 if chance.random() < 0.05 else meter + chance.random() * 5
            delay = timedelta(seconds=5) if chance.random() < 0.8 else timedelta(hours=chance.randint(1, 30))
            row = {"device_id": device, "collected_at": str(time), "ingested_at": str(time + delay),
                   "energy_kwh": round(meter, 2), "active_power": round(chance.random() * 9, 2)}
            fault = chance.random()
            if fault < 0.1:
                row.update(active_power=None)
            elif fault < 0.2:
                made.append({**row, "ingested_at": str(time + delay + timedelta(minutes=15)),
                             "energy_kwh": round(meter + 1, 2)})
            elif fault < 0.25:
                row.update(quality_flag="ANOMALY")
            made.append(row)
            time += timedelta(minutes=chance.choices([1, 7, 50, 600, 4000], [40, 30, 23, 5, 2])[0])
    return made


def run(spark, folder, made, ticks, grain):
    tables = Warehouse(spark, str(folder), grain=grain)
    everything, since = raw(spark, made), "1900-01-01"
    for tick in ticks:
        tables.append("raw", everything.filter((F.col("ingested_at") > since) & (F.col("ingested_at") <= tick)))
        run_pipeline(tables, tick)
        since = tick
    return tables


def content(tables, name):
    layer = S.LAYERS[name]
    return rows(tables.read(name), *layer.schema().names, order=layer.grain)


@pytest.mark.parametrize("seed, grain", [(1, "day"), (2, "hour")])
def test_ticks_equal_one_lazy_run(spark, tmp_path, seed, grain):
    made = story(seed)
    tables = run(spark, tmp_path, made, TICKS, grain)
    landed = raw(spark, made).filter(F.col("ingested_at") <= TICKS[-1])
    for name, expected in (("readings", readings_from_raw(landed, TICKS[-1])),
                           ("hourly", hours_from_raw(landed, TICKS[-1])),
                           ("daily", days_from_raw(landed, TICKS[-1]))):
        layer = S.LAYERS[name]
        assert content(tables, name) == rows(expected, *layer.schema().names, order=layer.grain), name
    assert tables.read("raw").filter("not is_processed").isEmpty()


def test_repeating_a_run_changes_nothing(spark, tmp_path):
    made = story(3)[:60]
    tables = run(spark, tmp_path, made, TICKS[-1:], "day")
    before = {name: content(tables, name) for name in ("readings", "tails", "hourly", "daily", "raw")}
    run_pipeline(tables, TICKS[-1])
    landed = raw(spark, made).filter(F.col("ingested_at") <= TICKS[-1])
    absorb(tables, tables.stage("again", dedupe_readings(landed, TICKS[-1])))
    assert before == {name: content(tables, name) for name in before}


def test_rollups_keep_energy_and_counts(spark, tmp_path):
    tables = run(spark, tmp_path, story(4)[:80], TICKS[-1:], "day")
    def total(name, column):
        return tables.read(name).agg(F.sum(column)).collect()[0][0]
    assert total("hourly", "energy_kwh") == total("readings", "energy_delta") == total("daily", "total_energy_kwh")
    assert total("daily", "reading_count") == tables.read("readings").count()


def test_duplicate_that_arrives_later_replaces_for_good(spark, tmp_path):
    first = {"collected_at": "2026-03-27 10:00:00", "active_power": 10}
    late = {**first, "ingested_at": "2026-03-27 10:25:00", "active_power": 20}
    tables = run(spark, tmp_path, [first, late], [*TICKS[:2], TICKS[2]], "day")
    assert rows(tables.read("hourly"), "avg_power_kw") == [(20,)]


def test_rows_that_arrive_during_a_run_wait_for_the_next(spark, tmp_path, monkeypatch):
    made = story(5)[:80]
    tables = Warehouse(spark, str(tmp_path))
    middle = sorted(r["ingested_at"] for r in made)[40]
    first, second = (raw(spark, made).filter(F.col("ingested_at") <= middle),
                     raw(spark, made).filter(F.col("ingested_at") > middle))
    tables.append("raw", first)
    files = set(tables.unconsumed())

    def arriving(wh, winners):
        wh.append("raw", second)
        absorb(wh, winners)

    monkeypatch.setattr("wattframe.plans.pipeline.absorb", arriving)
    run_pipeline(tables, TICKS[-1])
    monkeypatch.undo()
    stored = set(tables.unconsumed())
    assert stored and not stored & files
    run_pipeline(tables, TICKS[-1])
    assert tables.unconsumed() == []
    assert tables.read("raw").filter("not is_processed").isEmpty()
    expected = readings_from_raw(raw(spark, made), TICKS[-1])
    names = S.LAYERS["readings"].schema().names
    assert content(tables, "readings") == rows(expected, *names, order=S.FACT_GRAIN)


def test_quality_log_grows_by_six(spark, tmp_path):
    tables = Warehouse(spark, str(tmp_path))
    devices = spark.createDataFrame([("D1", "S1", True)], "device_id string, site_id string, is_active boolean")
    tables.append("devices", devices)
    tables.append("raw", raw(spark, [{}]))
    for _ in range(2):
        run_quality(tables, "2026-03-27 10:05:00")
    assert tables.read("quality_log").count() == 12


def test_missing_layer_is_empty_and_bad_grain_is_refused(spark, tmp_path):
    assert Warehouse(spark, str(tmp_path)).read("daily").isEmpty()
    with pytest.raises(ValueError):
        Warehouse(spark, str(tmp_path), grain="week")


def test_partition_bounds_prune_folders(spark, tmp_path):
    tables = Warehouse(spark, str(tmp_path))
    tables.append("raw", raw(spark, [{"ingested_at": f"2026-03-{d} 00:00:00"} for d in range(10, 20)]))
    found = tables.read("raw", since=20260318)
    assert found.count() == 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingested_part" in plan


@pytest.mark.parametrize("grain", ["day", "hour"])
def test_recent_reads_only_the_partitions_in_reach(spark, tmp_path, grain):
    tables = Warehouse(spark, str(tmp_path), grain=grain)
    tables.append("raw", raw(spark, [{"ingested_at": f"2026-03-27 {h:02}:30:00"} for h in range(24)]))
    found = tables.recent("raw", "2026-03-27 23:59:00", "2 hours")
    assert found.count() == (24 if grain == "day" else 3)
    assert tables.recent("raw", "2026-03-27 23:59:00", "2 hours", "day").count() == 24
    assert "PartitionFilters: [isnotnull(ingested_part" in found._jdf.queryExecution().executedPlan().toString()
    assert tables.recent("raw", "2026-03-29 02:00:00", "2 hours").isEmpty()

"""Anomaly figures that merge, and readings that wait for their device."""

import random

import pytest
from helpers import raw, rows
from pyspark.sql import functions as F

from wattframe import schemas as S
from wattframe.operators import quality as Q
from wattframe.plans.pipeline import run_pipeline
from wattframe.sources.tables import Warehouse

LATER = "2026-12-31"


def powers(seed, days):
    """Large means with small deviations, a constant device, nulls, and one reading far off on each day."""
    chance, made = random.Random(seed), []
    for day in range(1, days + 1):
        for i in range(20):
            at = f"2026-03-{day:02} {i:02}:00:00"
            made += [{"device_id": "D1", "active_power": round(1e6 + chance.random(), 2), "collected_at": at},
                     {"device_id": "D2", "active_power": 5, "collected_at": at},
                     {"device_id": "D3", "active_power": None if i % 3 else i, "collected_at": at}]
        made.append({"device_id": "D1", "active_power": 2e6, "collected_at": f"2026-03-{day:02} 21:30:00"})
        made.append({"device_id": "D1", "active_power": 2e6, "collected_at": f"2026-03-{day:02} 22:30:00",
                     "quality_flag": S.ANOMALY})
    return [{"id": n, **r} for n, r in enumerate(made, 1)]


def test_merged_figures_equal_those_of_all_rows(spark):
    made = raw(spark, powers(1, 6)).withColumn("day", F.to_date("collected_at"))
    merged = {r[0]: r[1:] for r in rows(Q.merged_figures(Q.power_figures(made, "day")), "device_id", "mean", "deviation")}
    power = F.col("active_power").cast("double")
    full = made.groupBy("device_id").agg(F.avg(power).alias("mean"), F.stddev_samp(power).alias("deviation"))
    for device, mean, deviation in rows(full, "device_id", "mean", "deviation"):
        assert merged[device][0] == pytest.approx(mean, rel=1e-12)
        assert merged[device][1] == pytest.approx(deviation, rel=1e-9, abs=1e-12)
    assert merged["D2"][1] == 0
    lone = Q.merged_figures(Q.power_figures(raw(spark, [{}]), "collected_at"))
    assert rows(lone, "mean", "deviation") == [(10.0, None)]
    assert Q.merged_figures(Q.power_figures(made.limit(0), "day")).count() == 0


def test_runs_flag_as_the_full_scan_does(spark, tmp_path):
    made = powers(2, 3)
    tables = Warehouse(spark, str(tmp_path))
    for day in (1, 2, 3):
        tables.append("raw", raw(spark, [r for r in made if r["collected_at"].startswith(f"2026-03-{day:02}")]))
        landed = tables.read("raw", marked=False).filter(f"day(collected_at) = {day}").drop("ingested_part")
        wanted = Q.flag_anomalies(tables.read("raw", marked=False).drop("ingested_part")).join(
            landed.select("id", F.col("quality_flag").alias("given")), "id")
        wanted = rows(wanted.filter("quality_flag <> given"), "id", "z")
        run_pipeline(tables, LATER, z=3.0)
        found = rows(tables.read("anomalies").filter(f"day(collected_at) = {day}"), "id", "z")
        assert [i for i, _ in found] == [i for i, _ in wanted] and len(found) == 1
        assert found[0][1] == pytest.approx(wanted[0][1], rel=1e-9)
    assert tables.read("readings").filter("active_power = 2000000").isEmpty()
    assert rows(tables.read("readings").groupBy("device_id").count(), "device_id", "count") == [
        ("D1", 60), ("D2", 60), ("D3", 21)]


def test_a_repeated_run_counts_nothing_twice(spark, tmp_path):
    tables = Warehouse(spark, str(tmp_path))
    tables.append("raw", raw(spark, powers(3, 1)))
    files = tables.unconsumed()
    run_pipeline(tables, LATER, z=3.0)
    before = [rows(tables.read(n), *S.LAYERS[n].schema().names) for n in ("power_days", "anomalies", "readings")]
    run_pipeline(tables, LATER, files=files, z=3.0)
    assert before == [rows(tables.read(n), *S.LAYERS[n].schema().names) for n in ("power_days", "anomalies", "readings")]


def test_fresh_rows_are_not_shuffled_to_meet_stored_figures(spark, tmp_path):
    """Figures beyond Spark's own limit, here one byte, still reach the rows where these are read."""
    session = spark.newSession()
    made = raw(session, powers(4, 2))
    made.write.parquet(str(tmp_path / "rows"))
    Q.merged_figures(Q.power_figures(made, "collected_at")).write.parquet(str(tmp_path / "figures"))
    found = {}
    for limit in ("1", "-1"):
        session.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        scored = Q.power_scores(session.read.parquet(str(tmp_path / "rows")),
                                session.read.parquet(str(tmp_path / "figures")))
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert ("hashpartitioning" in plan) == (limit == "-1") == ("SortMergeJoin" in plan)
        found[limit] = rows(scored, "id", "z")
    assert found["1"] == found["-1"] and len(found["1"]) == made.count()


def test_a_run_writes_its_fresh_rows_once(spark, tmp_path):
    """What a run stages beside its winners are figures of devices and the anomalies alone."""
    tables = Warehouse(spark, str(tmp_path))
    tables.append("raw", raw(spark, powers(5, 2)))
    run_pipeline(tables, LATER, z=3.0)
    staged = {f.name: spark.read.parquet(str(f)).count() for f in (tmp_path / "_staged").iterdir() if f.name != "winners"}
    assert staged["hits"] == tables.read("anomalies").count() == 2
    assert max(staged.values()) <= 3


def test_tails_keep_the_later_reading_and_the_newer_of_equal_times(spark, tmp_path):
    def at(clock, energy, landed, **more):
        return {"collected_at": f"2026-03-01 {clock}", "energy_kwh": energy, "ingested_at": f"2026-03-0{landed} 23:00:00", **more}

    first = [at("10:40:00", 5, 1), at("11:40:00", 6, 1), at("12:40:00", 7, 1)]
    second = [at("10:40:00", 8, 2), at("11:20:00", 9, 2), at("12:50:00", None, 2), at("13:10:00", 11, 2)]
    tables = Warehouse(spark, str(tmp_path))
    for n, made in enumerate((first, second)):
        tables.append("raw", raw(spark, [{"id": 10 * n + i, **r} for i, r in enumerate(made)]))
        run_pipeline(tables, LATER)
    found = rows(tables.read("tails").selectExpr("date_format(reading_time, 'HH:mm') at", "cast(energy_kwh as int) energy"),
                 "at", "energy")
    assert found == [("10:40", 8), ("11:40", 6), ("12:50", None), ("13:10", 11)]


DAILY = S.daily_schema().names


@pytest.mark.parametrize("order", [("r1", "r2", "d"), ("d", "r1", "r2"), ("r1", "d", "r2"), ("r2", "r1", "d")], ids="-".join)
def test_any_order_of_arrival_gives_the_same_days(spark, tmp_path, order):
    readings = [{"id": n, "device_id": d, "collected_at": f"2026-03-{1 + n % 3:02} {n % 24:02}:00:00", "energy_kwh": n}
                for n, d in enumerate(["A", "B", "B", None, "NEVER"] * 8, 1)]
    first, second = readings[:20], readings[20:] + [{**readings[1], "id": 99, "energy_kwh": 7,
                                                     "ingested_at": "2026-03-05 00:00:00"}]
    known = spark.createDataFrame([("A", True)], "device_id string, is_active boolean")
    later = spark.createDataFrame([("B", True)], "device_id string, is_active boolean")
    tables = Warehouse(spark, str(tmp_path))
    tables.append("devices", known)
    for step in order:
        tables.append(*{"r1": ("raw", raw(spark, first)), "r2": ("raw", raw(spark, second)), "d": ("devices", later)}[step])
        run_pipeline(tables, LATER, gate=True)
    plain = Warehouse(spark, str(tmp_path / "plain"))
    plain.append("raw", raw(spark, [r for r in first + second if r["device_id"] != "NEVER"]))
    run_pipeline(plain, LATER)
    assert rows(tables.read("daily"), *DAILY, order=S.DAY_GRAIN) == rows(plain.read("daily"), *DAILY, order=S.DAY_GRAIN)
    assert {r[0] for r in rows(tables.read("waiting"), "device_id")} == {"NEVER"}
    assert tables.read("waiting").count() == 8


def test_waiting_rows_are_not_doubled_by_a_repeated_run(spark, tmp_path):
    tables = Warehouse(spark, str(tmp_path))
    tables.append("devices", spark.createDataFrame([("A", True)], "device_id string, is_active boolean"))
    tables.append("raw", raw(spark, [{"device_id": "B"}, {"device_id": "A"}]))
    files = tables.unconsumed()
    for _ in range(2):
        run_pipeline(tables, LATER, files=files, gate=True)
    assert rows(tables.read("waiting"), "device_id") == [("B",)] and rows(tables.read("readings"), "device_id") == [("A",)]

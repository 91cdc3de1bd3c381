from decimal import Decimal as D

from helpers import DAY, NOW, one, raw, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe.operators import audit as A
from wattframe.operators import quality as Q


def devices(spark, *items):
    return spark.createDataFrame(list(items), "device_id string, is_active boolean")


def metric(df):
    return dict(rows(df, "check_type", "metric_value"))


def test_reading_checks_count_each_violation(spark):
    made = raw(spark, [
        {"active_power": None}, {"active_power": -1}, {"active_power": 0},
        {"collected_at": DAY + "10:20:01", "ingested_at": DAY + "10:00:00"},
        *({"voltage_avg": v} for v in (180, 260, 179.99, 260.01, None)),
        {"active_power": None, "ingested_at": DAY + "08:20:00"}])
    assert metric(Q.reading_checks(made, NOW)) == {
        "NULL_POWER": 1, "NEGATIVE_POWER": 1, "VOLTAGE_RANGE": 2, "FUTURE_TIMESTAMP": 1, "DUPLICATE_RATE": 7}
    assert metric(Q.reading_checks(made, NOW, None))["NULL_POWER"] == 2


def test_an_earlier_time_sees_what_had_landed_by_then(spark):
    made = raw(spark, [{"active_power": None, "ingested_at": DAY + "10:15:00"},
                       {"active_power": None, "ingested_at": DAY + "10:20:01"}])
    for lookback in ("2 hours", None):
        assert metric(Q.reading_checks(made, NOW, lookback))["NULL_POWER"] == 1
    late = raw(spark, [{"ingested_at": DAY + "10:20:01"}])
    assert metric(Q.ingestion_gap(devices(spark, ("D1", True)), late, NOW)) == {"INGESTION_GAP": 1}


def test_duplicate_keys_with_a_null_member_count(spark):
    made = raw(spark, [{"device_id": None}, {"device_id": None}, {"device_id": "D2"}])
    assert metric(Q.reading_checks(made, NOW))["DUPLICATE_RATE"] == 1


def test_empty_table_has_zero_metrics(spark):
    assert set(metric(Q.reading_checks(raw(spark, [{}]).filter("id < 0"), NOW)).values()) == {0}


def test_gap_counts_silent_active_devices(spark):
    known = devices(spark, ("D1", True), ("D2", False), ("D3", True))
    made = raw(spark, [{"device_id": "D3", "ingested_at": DAY + "10:15:00"},
                       {"device_id": "D1", "ingested_at": DAY + "10:10:00"}])
    assert rows(Q.silent_devices(known, made, NOW), "device_id") == [("D1",)]
    assert metric(Q.ingestion_gap(known, made, NOW)) == {"INGESTION_GAP": 1}


def test_threshold_is_included(spark):
    metrics = spark.createDataFrame([("NULL_POWER", 10), ("VOLTAGE_RANGE", 6)], "check_type string, metric_value long")
    log = rows(Q.quality_log(metrics, NOW), "check_type", "status", "metric_value", "threshold_value", "site_id")
    assert log == [("NULL_POWER", "PASS", D("10.0000"), D("10.0000"), None),
                   ("VOLTAGE_RANGE", "FAIL", D("6.0000"), D("5.0000"), None)]


def test_all_six_checks_are_logged(spark):
    log = Q.run_checks(devices(spark, ("D1", True)), raw(spark, [{}]), NOW)
    assert log.count() == 6 and log.filter("status = 'PASS'").count() == 6


def test_anomaly_beyond_three_deviations(spark):
    made = raw(spark, [*({"active_power": 10 + i % 2} for i in range(30)), {"active_power": 500},
                       {"device_id": "D2", "active_power": 500}, {"device_id": "D2", "active_power": None}])
    flagged = Q.flag_anomalies(made).filter("quality_flag = 'ANOMALY'")
    assert rows(flagged, "id") == [(31,)]


def test_anomaly_keeps_other_flags(spark):
    made = raw(spark, [*({"active_power": 10 + i % 2} for i in range(30)),
                       {"active_power": 500, "quality_flag": "REJECTED_FUTURE"}])
    assert Q.flag_anomalies(made).filter("quality_flag = 'ANOMALY'").isEmpty()


def test_audit_of_every_constraint(spark):
    made = raw(spark, [{}, {}, {"device_id": "D9", "active_power": None}, {"device_id": None, "active_power": 123.45}])
    parents = devices(spark, ("D1", True))
    contract = A.Contract(unique=["device_id", "collected_at"], not_null=["device_id", "active_power"],
                          references={"device_id": parents}, decimals={"active_power": T.DecimalType(4, 2)})
    assert rows(A.audit(made, contract), "constraint", "subject", "violations") == [
        ("decimal", "active_power", 1), ("not_null", "active_power", 1), ("not_null", "device_id", 1),
        ("reference", "device_id", 1), ("unique", "device_id,collected_at", 1)]


def test_quarantine_splits_every_row_once(spark):
    made = raw(spark, [{}, {}, {"device_id": "D9"}, {"device_id": None}])
    kept, orphans = A.quarantine(made, "device_id", devices(spark, ("D1", True)))
    assert rows(kept, "id") == [(1,), (2,), (4,)] and rows(orphans, "id") == [(3,)]


def test_checks_scan_raw_once(spark, tmp_path):
    raw(spark, [{}]).write.parquet(str(tmp_path / "raw"))
    plan = Q.reading_checks(spark.read.parquet(str(tmp_path / "raw")), NOW)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert text.count("FileScan") == 1 and "GreaterThan(ingested_at" in text


def test_gap_over_no_devices_is_zero(spark):
    assert one(Q.ingestion_gap(devices(spark, ("D1", True)).filter(F.lit(False)), raw(spark, [{}]), NOW),
               "metric_value") == 0

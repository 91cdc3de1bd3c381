from helpers import DAY, NOW, raw, rows

from wattframe.operators.clean import dedupe_readings, mark_processed, mark_rejected, settle

CASES = [
    {"id": 1},
    {"id": 2, "device_id": "D2", "active_power": None},
    {"id": 3, "device_id": "D3", "active_power": -1},
    {"id": 4, "device_id": "D4", "collected_at": DAY + "10:20:01"},
    {"id": 5, "device_id": "D5", "quality_flag": "ANOMALY", "active_power": None},
    {"id": 6, "device_id": "D6", "quality_flag": None},
    {"id": 7, "device_id": "D7", "collected_at": NOW},
    {"id": 8, "device_id": "D8", "active_power": 0},
    {"id": 9, "device_id": "D9", "is_processed": True, "active_power": -5},
]


def test_only_clean_readings_survive(spark):
    kept = rows(dedupe_readings(raw(spark, CASES), NOW), "raw_reading_id")
    assert kept == [(1,), (7,), (8,)]


def test_rejection_reasons_and_precedence(spark):
    marked = rows(mark_rejected(raw(spark, CASES), NOW), "id", "is_processed", "quality_flag")
    assert marked == [
        (1, False, "RAW"), (2, True, "REJECTED_NULL"), (3, True, "REJECTED_NEGATIVE"),
        (4, True, "REJECTED_FUTURE"), (5, True, "ANOMALY"), (6, False, None), (7, False, "RAW"),
        (8, False, "RAW"), (9, True, "RAW")]


def test_null_flag_with_a_bad_value_is_rejected(spark):
    bad = raw(spark, [{"quality_flag": None, "active_power": -1}])
    assert rows(mark_rejected(bad, NOW), "is_processed", "quality_flag") == [(True, "REJECTED_NEGATIVE")]


def test_latest_ingested_duplicate_wins_and_ties_fall_to_the_higher_id(spark):
    copies = raw(spark, [
        {"id": 1, "ingested_at": DAY + "10:00:05", "active_power": 1},
        {"id": 2, "ingested_at": DAY + "10:00:04", "active_power": 2},
        {"id": 3, "device_id": "D2", "active_power": 3},
        {"id": 4, "device_id": "D2", "active_power": 4}])
    assert rows(dedupe_readings(copies, NOW), "device_id", "raw_reading_id") == [("D1", 1), ("D2", 4)]


def test_winners_are_marked_by_id_losers_only_by_settle(spark):
    copies = raw(spark, [{"id": 1}, {"id": 2}, {"id": 3, "device_id": "D2", "quality_flag": None}])
    winners = dedupe_readings(copies, NOW)
    assert rows(mark_processed(copies, winners), "id", "is_processed") == [(1, False), (2, True), (3, False)]
    settled = settle(copies, NOW)
    assert rows(settled, "id", "is_processed") == [(1, True), (2, True), (3, False)]
    assert dedupe_readings(settled, NOW).isEmpty()


def test_settle_equals_rejection_plus_consumption(spark):
    settled = rows(settle(raw(spark, CASES), NOW), "id", "is_processed", "quality_flag")
    assert [r[1] for r in settled] == [True, True, True, True, True, False, True, True, True]
    assert [r[2] for r in settled] == [
        r[2] for r in rows(mark_rejected(raw(spark, CASES), NOW), "id", "is_processed", "quality_flag")]


def test_copies_are_reduced_before_the_shuffle(spark):
    plan = dedupe_readings(raw(spark, CASES), NOW)._jdf.queryExecution().executedPlan().toString()
    before = plan.rindex("Exchange hashpartitioning")
    assert plan.count("WindowGroupLimit") == 2 and plan.rindex("WindowGroupLimit") > before

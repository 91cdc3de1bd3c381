from decimal import Decimal as D

import pytest
from helpers import DAY, fact, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wattframe.operators.delta import energy_delta

SLOW = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def deltas(df):
    return rows(df, "device_id", "reading_time", "energy_delta", order=["device_id", "reading_time"])


def values(df):
    return [r[2] for r in deltas(df)]


def test_difference_with_reset(spark):
    made = fact(spark, [("D1", DAY + f"10:0{i}:00", e) for i, e in enumerate((100, 101.5, 1, 2))])
    assert values(energy_delta(made)) == [None, D("1.5000"), None, D("1.0000")]


def test_predecessor_in_an_earlier_hour_or_day(spark):
    made = fact(spark, [("D1", "2026-03-20 23:59:00", 5), ("D1", DAY + "10:59:00", 7), ("D1", DAY + "11:00:00", 8),
                        ("D2", DAY + "11:00:00", 1)])
    assert values(energy_delta(made)) == [None, D("2.0000"), D("1.0000"), None]


def test_null_counter_breaks_the_difference_on_both_sides(spark):
    made = fact(spark, [("D1", DAY + "09:59:00", 1), ("D1", DAY + "10:00:00", None), ("D1", DAY + "11:00:00", 3),
                        ("D1", DAY + "11:01:00", 4)])
    assert values(energy_delta(made)) == [None, None, None, D("1.0000")]


NOW = DAY + "10:20:00"
SPREAD = [("D1", DAY + "07:00:00", 1), ("D1", DAY + "08:10:00", 2), ("D1", DAY + "08:30:00", 4),
          ("D1", DAY + "10:00:00", 7)]


def test_lookback_with_and_without_carry_in(spark):
    made = fact(spark, SPREAD)
    assert values(energy_delta(made, NOW, "2 hours")) == [None, None, D("2.0000"), D("3.0000")]
    assert values(energy_delta(made, NOW, "2 hours", carry_in=False)) == [None, None, None, D("3.0000")]


def test_fill_only_null_keeps_stale_values(spark):
    made = fact(spark, SPREAD).withColumn("energy_delta", F.lit(9).cast("decimal(10,4)"))
    assert values(energy_delta(made, NOW, "2 hours", fill_only_null=True)) == [D("9.0000")] * 4
    assert values(energy_delta(made, NOW, "2 hours")) == [D("9.0000"), D("9.0000"), D("2.0000"), D("3.0000")]


def test_late_row_changes_both_neighbours(spark):
    before = [("D1", DAY + "10:00:00", 1), ("D1", DAY + "10:10:00", 5)]
    assert values(energy_delta(fact(spark, before))) == [None, D("4.0000")]
    after = [*before, ("D1", DAY + "10:05:00", 2)]
    assert values(energy_delta(fact(spark, after))) == [None, D("1.0000"), D("3.0000")]


@SLOW
@given(st.lists(st.tuples(st.sampled_from("AB"), st.integers(0, 600), st.integers(0, 50)), min_size=1, max_size=40))
def test_sliced_equals_plain_lag(spark, readings):
    unique = {(d, m): e for d, m, e in readings}
    made = fact(spark, [(d, f"2026-03-{20 + m // 60 // 4} {m // 60:02}:{m % 60:02}:00", e)
                        for (d, m), e in unique.items()])
    plain = F.col("energy_kwh") - F.lag("energy_kwh").over(W.partitionBy("device_id").orderBy("reading_time"))
    expected = made.withColumn("energy_delta", F.when(plain >= 0, plain).cast("decimal(10,4)"))
    assert deltas(energy_delta(made)) == deltas(expected)


def test_no_window_over_whole_devices_of_readings(spark):
    made = fact(spark, SPREAD)
    plan = energy_delta(made)._jdf.queryExecution().executedPlan().toString()
    lag = next(line for line in plan.splitlines() if "Window [lag" in line)
    assert "hour_start" in lag


def test_overflow_of_the_column_raises(spark):
    made = fact(spark, [("D1", DAY + "10:00:00", 0), ("D1", DAY + "10:01:00", 10_000_000)])
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        energy_delta(made).collect()

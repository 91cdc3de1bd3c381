import json
from datetime import datetime
from decimal import Decimal as D

import pytest
from helpers import rows
from pyspark.sql import functions as F

from wattframe.functions import safe_double, utc_naive
from wattframe.sources.feed import CHANNELS, Channel, channel_table, decode_feed, feed_rejects, new_since, parse_feed, read_feed

NOW = "2026-03-27 10:20:00"


@pytest.mark.parametrize("text, value", [
    ("1.5", 1.5), (" 12 ", 12.0), ("1e3", 1000.0), ("-.5", -0.5), ("1.", 1.0), ("1_000", 1000.0), ("+7", 7.0),
    ("nan", None), ("inf", None), ("-Infinity", None), ("", None), ("abc", None), (None, None), ("1.0d", None),
    ("1f", None), ("0x10", None), ("1__0", None), ("_1", None), ("1e999", None), ("1,5", None)])
def test_safe_double(spark, text, value):
    assert spark.createDataFrame([(text,)], "t string").select(safe_double(F.col("t"))).collect()[0][0] == value


@pytest.mark.parametrize("text, value", [
    ("2026-03-27T10:00:00Z", datetime(2026, 3, 27, 10)), ("2026-03-27T10:00:00+08:00", datetime(2026, 3, 27, 2)),
    ("2026-03-27T10:00:00.25-02:30", datetime(2026, 3, 27, 12, 30, 0, 250000)),
    ("2026-03-27T10:00:00", datetime(2026, 3, 27, 10)), ("1969-12-31T23:00:00-02:00", datetime(1970, 1, 1, 1)),
    ("2026-03-27", datetime(2026, 3, 27)), ("yesterday", None), (None, None)])
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_utc_naive_in_any_session_zone(spark, text, value, zone):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", zone)
    made = other.createDataFrame([(text,)], "t string").select(utc_naive(F.col("t")))
    assert made.collect()[0][0] == value


def response(*feeds):
    return json.dumps({"channel": {"id": 1}, "feeds": list(feeds)}, indent=1)


FEEDS = [{"created_at": "2026-03-27T10:00:00Z", "field1": "12.5", "field2": " 3 ", "field3": "nan", "field9": "1"},
         {"created_at": "2026-03-27T18:01:00+08:00", "field2": None, "field4": "1.2345", "field6": 0.5}]


def test_landed_files_become_raw_rows(spark, tmp_path):
    for name, text in (("a", response(*FEEDS)), ("b", response()), ("c", json.dumps({"channel": {}}))):
        folder = tmp_path / "channel_id=972755"
        folder.mkdir(exist_ok=True)
        (folder / f"{name}.json").write_text(text)
    decoded = decode_feed(read_feed(spark, str(tmp_path)), channel_table(spark, CHANNELS), NOW)
    assert rows(decoded, "site_id", "device_id", "collected_at", "energy_kwh", "active_power", "voltage_avg",
                "current_avg", "power_factor", "demand_kw", "is_processed", "quality_flag", "ingested_at",
                order=["collected_at"]) == [
        ("SITE_EXT_01", "DEV_EXT_PZEM", datetime(2026, 3, 27, 10), D("12.50"), D("3.00"), None, None, None, None,
         False, "RAW", datetime(2026, 3, 27, 10, 20)),
        ("SITE_EXT_01", "DEV_EXT_PZEM", datetime(2026, 3, 27, 10, 1), None, None, None, D("1.235"), D("0.5000"),
         None, False, "RAW", datetime(2026, 3, 27, 10, 20))]


def test_each_channel_has_its_own_mapping(spark):
    channels = channel_table(spark, (Channel(1, "S1", "D1", {"field1": "active_power"}),
                                     Channel(2, "S1", "D2", {"field1": "energy_kwh"})))
    payloads = spark.createDataFrame([(c, response({"created_at": "2026-03-27T10:00:00Z", "field1": "7"}))
                                      for c in (1, 2, 3)], "channel_id long, payload string")
    assert rows(decode_feed(parse_feed(payloads), channels, NOW), "device_id", "active_power", "energy_kwh") == [
        ("D1", D("7.00"), None), ("D2", None, D("7.00"))]


def test_entries_are_kept_or_rejected_with_a_reason(spark):
    time = "2026-03-27T10:00:00Z"
    payloads = spark.createDataFrame([
        (972755, response({"created_at": time, "field3": "230"}, {"created_at": "yesterday", "field3": "1e9"},
                          {"field3": "230"}, {"created_at": time, "field3": "1e9"}, {"created_at": time, "field3": "n/a"})),
        (1, response({"created_at": "yesterday"}, {})), (972755, response()), (972755, "{}"), (972755, '{"feeds": [null]}'),
        (None, response({"created_at": time}))], "channel_id long, payload string")
    feed, channels = parse_feed(payloads), channel_table(spark)
    assert rows(decode_feed(feed, channels, NOW), "voltage_avg", order=["voltage_avg"]) == [(None,), (D("230.00"),)]
    made = rows(feed_rejects(feed, channels, NOW), "channel_id", "reason", order=["reason", "channel_id"])
    assert made == [(972755, "BAD_TIME"), (972755, "BAD_TIME"), (972755, "NUMBER_TOO_LARGE"),
                    (None, "UNKNOWN_CHANNEL"), (1, "UNKNOWN_CHANNEL"), (1, "UNKNOWN_CHANNEL")]


def test_ingest_stores_rejects(spark, tmp_path):
    from wattframe.plans.ingest import ingest_responses
    from wattframe.sources.tables import Warehouse
    tables = Warehouse(spark, str(tmp_path))
    payloads = spark.createDataFrame([(972755, response(*FEEDS, {"created_at": "?", "field2": "5"}))],
                                     "channel_id long, payload string")
    ingest_responses(tables, parse_feed(payloads), channel_table(spark), NOW)
    assert tables.read("raw").count() == 2
    assert rows(tables.read("feed_rejects"), "channel_id", "entry", "reason", "ingested_at") == [
        (972755, '{"created_at":"?","field2":"5"}', "BAD_TIME", datetime(2026, 3, 27, 10, 20))]


def test_same_response_gives_same_ids(spark):
    payloads = spark.createDataFrame([(972755, response(*FEEDS))], "channel_id long, payload string")
    once, again = (rows(decode_feed(parse_feed(payloads), channel_table(spark), when), "id") for when in (NOW, "2027-01-01"))
    assert once == again and len(set(once)) == 2


def test_broken_response_fails_unless_permitted(spark):
    payloads = spark.createDataFrame([(972755, "{")], "channel_id long, payload string")
    with pytest.raises(Exception, match="MALFORMED"):
        parse_feed(payloads).collect()
    assert decode_feed(parse_feed(payloads, mode="PERMISSIVE"), channel_table(spark), NOW).isEmpty()


def test_payload_is_parsed_once(spark):
    payloads = spark.createDataFrame([(972755, response(*FEEDS))], "channel_id long, payload string")
    plan = decode_feed(parse_feed(payloads), channel_table(spark), NOW)._jdf.queryExecution().executedPlan()
    assert plan.toString().count("from_json") <= 1


def test_small_channel_table_is_broadcast(spark, tmp_path):
    (tmp_path / "channel_id=972755").mkdir()
    (tmp_path / "channel_id=972755" / "a.json").write_text(response(*FEEDS))
    plan = decode_feed(read_feed(spark, str(tmp_path)), channel_table(spark), NOW)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_high_water_mark_is_strict_and_per_key(spark):
    kinds = "site_id string, device_id string, collected_at timestamp_ntz"
    at = datetime(2026, 3, 27, 10)
    existing = spark.createDataFrame([("S1", "D1", at), ("S1", "D1", datetime(2026, 3, 1))], kinds)
    batch = spark.createDataFrame([("S1", "D1", at), ("S1", "D1", datetime(2026, 3, 27, 10, 1)),
                                   ("S1", "D2", datetime(2020, 1, 1))], kinds)
    assert rows(new_since(batch, existing), "device_id", "collected_at") == [
        ("D1", datetime(2026, 3, 27, 10, 1)), ("D2", datetime(2020, 1, 1))]


def test_ingest_appends_only_what_is_new(spark, tmp_path):
    from helpers import raw
    from wattframe.plans.ingest import ingest_responses
    from wattframe.sources.tables import Warehouse
    tables = Warehouse(spark, str(tmp_path))
    known = {"site_id": "SITE_EXT_01", "device_id": "DEV_EXT_PZEM", "collected_at": "2026-03-27 10:00:00"}
    tables.append("raw", raw(spark, [known, {}]))

    def land(*times):
        feeds = [{"created_at": f"2026-03-27T{t}:00Z", "field2": "5"} for t in times]
        payloads = spark.createDataFrame([(972755, response(*feeds))], "channel_id long, payload string")
        ingest_responses(tables, parse_feed(payloads), channel_table(spark), NOW)
        return [r[0].strftime("%H:%M") for r in rows(
            tables.read("raw").filter("device_id = 'DEV_EXT_PZEM'"), "collected_at")]

    assert land("09:59", "10:00", "10:01") == ["10:00", "10:01"]
    assert land("10:01") == ["10:00", "10:01"]
    assert land("10:01", "10:02") == ["10:00", "10:01", "10:02"]
    assert rows(tables.read("high_water"), "device_id", "collected_at") == [
        ("D1", datetime(2026, 3, 27, 10)), ("DEV_EXT_PZEM", datetime(2026, 3, 27, 10, 2))]

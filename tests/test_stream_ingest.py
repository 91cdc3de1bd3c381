"""The feed as a stream against one batch run for each response, in any split."""

import json
import os
import random
from datetime import datetime

import pytest
from helpers import raw, rows
from pyspark.sql import functions as F

from wattframe import schemas as S
from wattframe.plans.ingest import ingest_responses
from wattframe.session import streaming_session
from wattframe.sources.feed import Channel, channel_table, parse_feed, read_feed
from wattframe.sources.tables import Warehouse
from wattframe.streaming.ingest import response_stream, stream_ingest

NOW = "2026-03-27 10:20:00"
CHANNELS = (Channel(1, "S1", "D1", {"field1": "energy_kwh", "field2": "active_power"}),
            Channel(2, "S1", "D2", {"field1": "active_power"}), Channel(3, "S1", "D1", {"field2": "energy_kwh"}))
READ = [*S.RAW_GRAIN, "ingested_at", *S.MEASURES, "is_processed", "quality_flag", "id"]


@pytest.fixture(scope="module")
def child(spark):
    return streaming_session(spark)


def sent(chance, number):
    """(channel, text) of a response: out of order, repeated, broken, empty or with odd entries."""
    entries = [{"created_at": f"2026-03-27T10:{min(59, 4 * number + chance.randrange(9)):02}:00Z", "field1": str(chance.randrange(9)),
                "field2": chance.choice(["1.5", "n/a", None])} for _ in range(chance.randrange(1, 5))]
    entries += chance.choice([[], [], [{"created_at": "?", "field1": "1"}], [{"field1": "1e99", "created_at": "2026-03-27"}], [None]])
    text = json.dumps({"feeds": entries})
    return chance.choice([1, 1, 2, 3, 9]), chance.choice([text] * 6 + ["{", "", "[1", '{"feeds": 5}', "{}"])


def land(folder, responses):
    for number, (channel, text) in enumerate(responses):
        place = folder / f"channel_id={channel}"
        place.mkdir(parents=True, exist_ok=True)
        (place / f"r{number:04}.json").write_text(text)
        os.utime(place / f"r{number:04}.json", (1_000_000 + number, 1_000_000 + number))


def content(tables):
    # A broken text has no line of its own in the comparison of entries: engines may trim it.
    return (rows(tables.read("raw"), *READ), rows(tables.read("feed_rejects").fillna("-"), "channel_id", "reason", "source"))


@pytest.mark.parametrize("files", [1000, 1, 4])
def test_any_split_equals_one_batch_run_for_each_response(spark, child, tmp_path, files):
    chance = random.Random(3)
    responses = [sent(chance, n) for n in range(14)]
    land(tmp_path / "in", responses)
    known = {"site_id": "S1", "device_id": "D2", "collected_at": "2026-03-27 10:20:00"}
    one, other = (Warehouse(child, str(tmp_path / n)) for n in ("batch", "stream"))
    for tables in (one, other):
        tables.append("raw", raw(spark, [known]))
    kinds = "channel_id long, payload string, source string"
    if files == 1000:  # the batch runs take long and are the same for each split
        for number, (channel, text) in enumerate(responses):
            single = spark.createDataFrame([(channel, text, f"r{number:04}.json")], kinds)
            ingest_responses(one, parse_feed(single, mode="PERMISSIVE"), channel_table(spark, CHANNELS), NOW)
        test_any_split_equals_one_batch_run_for_each_response.wanted = content(one)
    stream = response_stream(child, str(tmp_path / "in"), maxFilesPerTrigger=str(files))
    stream_ingest(stream, channel_table(child, CHANNELS), other, str(tmp_path / "cp"), lambda: NOW).awaitTermination()
    wanted = getattr(test_any_split_equals_one_batch_run_for_each_response, "wanted", None)
    if wanted is None:
        pytest.skip("runs after the first split")
    assert len(wanted[0]) > 4 and {r[1] for r in wanted[1]} >= {"BAD_JSON", "UNKNOWN_CHANNEL"}
    assert content(other) == wanted


def test_marks_are_state_and_survive_a_restart(spark, child, tmp_path):
    tables = Warehouse(child, str(tmp_path / "out"))

    def run(number, *times):
        place = tmp_path / "in/channel_id=2"
        place.mkdir(parents=True, exist_ok=True)
        entries = [{"created_at": f"2026-03-27T{t}:00Z", "field1": "5"} for t in times]
        (place / f"{number}.json").write_text(json.dumps({"feeds": entries}))
        stream = response_stream(child, str(tmp_path / "in"))
        stream_ingest(stream, channel_table(child, CHANNELS), tables, str(tmp_path / "cp"), lambda: NOW).awaitTermination()
        return [r[0].strftime("%H:%M") for r in rows(tables.read("raw"), "collected_at")]

    assert run(1, "10:02", "10:01", "10:01") == ["10:01", "10:01", "10:02"]
    assert run(2, "10:02", "10:03", "09:00") == ["10:01", "10:01", "10:02", "10:03"]
    assert tables.read("high_water").isEmpty()


def test_a_broken_file_loses_nothing_else(spark, tmp_path):
    good = json.dumps({"feeds": [{"created_at": "2026-03-27T10:00:00Z", "field1": "5"}]}, indent=1)
    for name, text in (("a", good), ("b", '{"feeds": [{"created_at"'), ("c", ""), ("d", "no json")):
        (tmp_path / "in/channel_id=2").mkdir(parents=True, exist_ok=True)
        (tmp_path / f"in/channel_id=2/{name}.json").write_text(text)
    tables = Warehouse(spark, str(tmp_path / "out"))
    ingest_responses(tables, read_feed(spark, str(tmp_path / "in")), channel_table(spark, CHANNELS), NOW)
    assert rows(tables.read("raw"), "device_id", "collected_at") == [("D2", datetime(2026, 3, 27, 10))]
    kept = rows(tables.read("feed_rejects"), "channel_id", "reason", "source", "entry")
    assert [r[:3] for r in kept] == [(2, "BAD_JSON", "b.json"), (2, "BAD_JSON", "d.json")]
    assert kept[1][3] == "no json"
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        read_feed(spark, str(tmp_path / "in"), "FAILFAST").collect()


def test_each_number_is_read_once(spark):
    from wattframe.plans import catalog
    plan = catalog.QUERIES["ingest_feed"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("RLIKE") <= 5  # two for numbers, the rest for the time's zone

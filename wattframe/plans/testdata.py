"""The given tables seen as meter data.

Each event becomes one raw reading by a projection alone: no join, no shuffle,
and it works on a stream as on a table.  The column texts are valid in Spark
and in other SQL engines alike; only the cast to a time without zone differs,
which ``{ts}`` stands for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattframe.session import fit_shuffles

# Fixed values.  Thirty days fold into three at minute grain, which makes duplicates.
MINUTE = "cast(floor(((day(ts) - 1) * 1440 + hour(ts) * 60 + minute(ts)) / 10) as bigint)"
DAY_MINUTE = f"({MINUTE} % 1440)"
START = "cast('2024-01-01' as {ts})"

RAW = {
    "id": "event_id",
    "site_id": "user_id % 25",
    "device_id": "user_id",
    "collected_at": f"{START} + interval '1' minute * ({MINUTE}"
                    " + case when event_id % 211 = 17 then 7200 else 0 end)",
    "ingested_at": f"{START} + interval '1' minute * {MINUTE} + interval '1' second * (event_id % 5)",
    "voltage_avg": "cast(case when event_id % 500 = 9 then 300 else 205 + event_id % 41 end as decimal(8,2))",
    "current_avg": "cast(1 + event_id % 97 as decimal(10,3))",
    "active_power": "cast(case when event_id % 125 = 3 then null when event_id % 167 = 5"
                    " then -value else value end as decimal(12,2))",
    "reactive_power": "cast(event_id % 313 as decimal(12,2))",
    "power_factor": "cast(case event_id % 4 when 0 then 0.9050 when 1 then 0.9125 when 2 then 0.9417"
                    " else 0.9869 end as decimal(5,4))",
    "frequency": "cast(case event_id % 3 when 0 then 59.95 when 1 then 60.00 else 60.04 end as decimal(5,2))",
    "energy_kwh": f"cast({DAY_MINUTE} * (1 + user_id % 7) + event_id % 13 as decimal(14,2))",
    "demand_kw": "cast(value as decimal(10,2))",
    "is_processed": "false",
    "quality_flag": "case when event_id % 200 = 13 then 'ANOMALY' else 'RAW' end",
}

SITES = {
    "site_id": "cast(n_nationkey as bigint)",
    "site_name": "n_name",
    "site_type": "case when n_nationkey % 3 = 0 then 'factory' when n_nationkey % 3 = 1"
                 " then 'office' else 'warehouse' end",
    "region": "r_name",
    "city": "n_name",
    "capacity_kw": "cast(n_nationkey * 100 as decimal(10,2))",
    "created_at": START,
}

DEVICES = {
    "device_id": "s_suppkey",
    "site_id": "s_suppkey % 25",
    "device_name": "s_name",
    "device_type": "case when s_suppkey % 4 = 0 then 'main_meter' else 'sub_meter' end",
    "rated_power_kw": "cast(s_acctbal as decimal(10,2))",
    "is_active": "s_suppkey % 10 <> 9",
    "created_at": START,
}


# The columns read here; a declared schema spares a look into the files.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
}


def select_list(columns: dict[str, str], ts: str) -> list[str]:
    return [f"{text.replace('{ts}', ts)} as {name}" for name, text in columns.items()]


def _view(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*select_list(columns, "timestamp_ntz"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def as_raw(events: DataFrame) -> DataFrame:
    return _view(events, RAW)


def raw(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    fit_shuffles(events)
    return as_raw(events)


def raw_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as a file stream.

    A file stream takes a folder or a pattern; the pattern here matches the
    table whether it is one file or a folder of files.
    """
    return as_raw(spark.readStream.schema(TABLES["events"]).parquet(f"{folder}/event[s].parquet"))


def sites(spark: SparkSession, folder: str) -> DataFrame:
    nations, regions = table(spark, folder, "nation"), table(spark, folder, "region")
    return _view(nations.join(regions, nations.n_regionkey == regions.r_regionkey), SITES)


def devices(spark: SparkSession, folder: str) -> DataFrame:
    return _view(table(spark, folder, "supplier"), DEVICES)

"""Column types, keys and layout of every table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

NTZ = T.TimestampNTZType()
LONG = T.LongType()
STRING = T.StringType()


def _dec(precision: int, scale: int) -> T.DecimalType:
    return T.DecimalType(precision, scale)


# Precision and scale of the measured columns.
MEASURES = {
    "voltage_avg": _dec(8, 2),
    "current_avg": _dec(10, 3),
    "active_power": _dec(12, 2),
    "reactive_power": _dec(12, 2),
    "power_factor": _dec(5, 4),
    "frequency": _dec(5, 2),
    "energy_kwh": _dec(14, 2),
    "demand_kw": _dec(10, 2),
}

# The quality-flag vocabulary.
RAW = "RAW"
ANOMALY = "ANOMALY"
REJECTED_NULL = "REJECTED_NULL"
REJECTED_NEGATIVE = "REJECTED_NEGATIVE"
REJECTED_FUTURE = "REJECTED_FUTURE"


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


def casts(schema: T.StructType, given: list[str] | None = None, as_is: list[str] = ()) -> list[str]:
    """Select expressions that bring columns into the types of ``schema``.

    Columns not ``given`` become NULL; those named in ``as_is`` keep their type.
    """
    return [f.name if f.name in as_is else
            f"cast({f.name if given is None or f.name in given else 'null'} as {f.dataType.simpleString()})"
            f" as {f.name}" for f in schema]


def raw_schema(key: T.DataType = STRING) -> T.StructType:
    return _struct(("id", LONG), ("site_id", key), ("device_id", key),
                   ("collected_at", NTZ), ("ingested_at", NTZ), *MEASURES.items(),
                   ("is_processed", T.BooleanType()), ("quality_flag", STRING))


def fact_schema(key: T.DataType = STRING) -> T.StructType:
    return _struct(("site_id", key), ("device_id", key), ("reading_time", NTZ),
                   *MEASURES.items(), ("energy_delta", _dec(10, 4)), ("raw_reading_id", LONG))


def tails_schema(key: T.DataType = STRING) -> T.StructType:
    return _struct(("site_id", key), ("device_id", key), ("hour_start", NTZ),
                   ("reading_time", NTZ), ("energy_kwh", MEASURES["energy_kwh"]))


def hourly_schema(key: T.DataType = STRING) -> T.StructType:
    return _struct(("site_id", key), ("device_id", key), ("hour_start", NTZ),
                   ("avg_power_kw", _dec(12, 2)), ("max_power_kw", _dec(12, 2)),
                   ("min_power_kw", _dec(12, 2)), ("energy_kwh", _dec(12, 4)),
                   ("avg_pf", _dec(5, 4)), ("avg_voltage", _dec(8, 2)),
                   ("reading_count", T.IntegerType()))


def daily_schema(key: T.DataType = STRING) -> T.StructType:
    return _struct(("site_id", key), ("device_id", key), ("reading_date", T.DateType()),
                   ("total_energy_kwh", _dec(14, 4)), ("peak_demand_kw", _dec(10, 2)),
                   ("avg_power_kw", _dec(12, 2)), ("max_power_kw", _dec(12, 2)),
                   ("min_power_kw", _dec(12, 2)), ("avg_pf", _dec(5, 4)),
                   ("avg_voltage", _dec(8, 2)), ("reading_count", T.IntegerType()))


def site_days_schema(key: T.DataType = STRING) -> T.StructType:
    return _struct(("site_id", key), ("reading_date", T.DateType()), ("bucket", LONG),
                   ("total_energy_kwh", _dec(24, 4)), ("peak_demand_kw", _dec(10, 2)),
                   ("power_sum", _dec(22, 2)), ("power_count", LONG), ("devices", T.BinaryType()))


def numbers_schema(key: T.DataType = STRING) -> T.StructType:
    return _struct(("device_id", key), ("number", LONG))


def power_schema(key: T.DataType = STRING) -> T.StructType:
    return _struct(("device_id", key), ("n", LONG), ("mean", T.DoubleType()), ("squares", T.DoubleType()))


def anomalies_schema(key: T.DataType = STRING) -> T.StructType:
    return _struct(("id", LONG), ("site_id", key), ("device_id", key), ("collected_at", NTZ), ("ingested_at", NTZ),
                   ("active_power", MEASURES["active_power"]), ("z", T.DoubleType()))


def sites_schema(key: T.DataType = STRING) -> T.StructType:
    return _struct(("site_id", key), ("site_name", STRING), ("site_type", STRING),
                   ("region", STRING), ("city", STRING), ("capacity_kw", _dec(10, 2)),
                   ("created_at", NTZ))


def devices_schema(key: T.DataType = STRING) -> T.StructType:
    return _struct(("device_id", key), ("site_id", key), ("device_name", STRING),
                   ("device_type", STRING), ("rated_power_kw", _dec(10, 2)),
                   ("is_active", T.BooleanType()), ("created_at", NTZ))


def log_schema(key: T.DataType = STRING) -> T.StructType:
    return _struct(("check_time", NTZ), ("check_type", STRING), ("site_id", key),
                   ("device_id", key), ("status", STRING), ("metric_value", _dec(14, 4)),
                   ("threshold_value", _dec(14, 4)), ("message", STRING))


def marks_schema(key: T.DataType = STRING) -> T.StructType:
    return _struct(("site_id", key), ("device_id", key), ("collected_at", NTZ))


def ledger_schema(key: T.DataType = STRING) -> T.StructType:
    return _struct(("file", STRING), ("as_of", NTZ))


def rejects_schema(key: T.DataType = STRING) -> T.StructType:
    return _struct(("channel_id", LONG), ("entry", STRING), ("reason", STRING), ("source", STRING), ("ingested_at", NTZ))


def windows_schema(key: T.DataType = STRING) -> T.StructType:
    return _struct(("window_start", NTZ), ("window_end", NTZ), ("null_power", LONG),
                   ("negative_power", LONG), ("voltage_range", LONG), ("future_timestamp", LONG))


DEVICE = ["site_id", "device_id"]
RAW_GRAIN = [*DEVICE, "collected_at"]
FACT_GRAIN = [*DEVICE, "reading_time"]
HOUR_GRAIN = [*DEVICE, "hour_start"]
DAY_GRAIN = [*DEVICE, "reading_date"]


@dataclass(frozen=True)
class Layer:
    """One stored table: its schema, grain, and the time column that places a row."""

    name: str
    schema: object
    grain: list[str]
    time: str | None = None
    part: str | None = None


# ``part`` holds a day (yyyymmdd) or an hour (yyyymmddhh) as a number, so a
# lookback is a range of folders and a run rewrites only the parts it touches.
# The daily table is placed by its own date.
LAYERS = {
    layer.name: layer for layer in (
        Layer("raw", raw_schema, ["id"], "ingested_at", "ingested_part"),
        Layer("readings", fact_schema, FACT_GRAIN, "reading_time", "reading_part"),
        Layer("tails", tails_schema, HOUR_GRAIN, "hour_start", "reading_part"),
        Layer("hourly", hourly_schema, HOUR_GRAIN, "hour_start", "reading_part"),
        Layer("daily", daily_schema, DAY_GRAIN, None, "reading_date"),
        Layer("site_days", site_days_schema, ["site_id", "reading_date", "bucket"], None, "reading_date"),
        Layer("device_numbers", numbers_schema, ["device_id"]),
        Layer("power_days", power_schema, ["device_id"], None, "ingested_part"),
        Layer("anomalies", anomalies_schema, ["id"], "ingested_at", "ingested_part"),
        Layer("waiting", raw_schema, ["id"]),
        Layer("quality_windows", windows_schema, ["window_start"], "window_start", "window_part"),
        Layer("quality_log", log_schema, []),
        Layer("quality_stream", log_schema, ["check_time", "check_type"], "check_time", "check_part"),
        Layer("feed_rejects", rejects_schema, [], "ingested_at", "ingested_part"),
        Layer("high_water", marks_schema, DEVICE),
        Layer("ledger", ledger_schema, ["file"]),
        Layer("sites", sites_schema, ["site_id"]),
        Layer("devices", devices_schema, ["device_id"]),
    )
}

"""Small readings and result helpers."""

from decimal import Decimal

from pyspark.sql import functions as F

from wattframe import schemas as S

NOW = "2026-03-27 10:20:00"
DAY = "2026-03-27 "


def dec(value):
    return None if value is None else Decimal(str(value))


def raw(spark, rows):
    """Raw rows from dicts; what a dict leaves out gets a plain value."""
    full = []
    for number, row in enumerate(rows, 1):
        base = {"id": number, "site_id": "S1", "device_id": "D1", "collected_at": DAY + "10:00:00",
                "ingested_at": None, "active_power": 10, "energy_kwh": None, "voltage_avg": 220,
                "power_factor": 0.9, "is_processed": False, "quality_flag": S.RAW, **row}
        base["ingested_at"] = base["ingested_at"] or base["collected_at"]
        full.append({k: str(v) if v is not None and k not in ("id", "is_processed") else v
                     for k, v in base.items()})
    kinds = ("id long, site_id string, device_id string, collected_at string, ingested_at string,"
             " active_power string, energy_kwh string, voltage_avg string, power_factor string,"
             " is_processed boolean, quality_flag string")
    names = [part.split()[0] for part in kinds.split(",")]
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in full], kinds)
    return df.selectExpr(*S.casts(S.raw_schema(), df.columns))


def fact(spark, rows):
    """Fact rows from (device, time, energy) or (device, time, energy, power)."""
    from wattframe.operators.clean import dedupe_readings
    made = [{"device_id": r[0], "collected_at": r[1], "energy_kwh": r[2],
             "active_power": r[3] if len(r) > 3 else 10} for r in rows]
    return dedupe_readings(raw(spark, made), "2099-01-01")


def rows(df, *columns, order=None):
    picked = df.select(*columns)
    return [tuple(r) for r in (picked.orderBy(*(order or columns)).collect())]


def one(df, column):
    return df.select(F.col(column)).collect()[0][0]

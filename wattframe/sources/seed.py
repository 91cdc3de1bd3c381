"""Seed rows of the two dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe import schemas as S
from wattframe.functions import Instant, ntz
from wattframe.sources.small import small_table

# site_id, site_name, site_type, region, city, capacity_kw.
SITES = [
    ("SITE_TPE_01", "台北信義廠區", "factory", "北區", "台北市", 2000),
    ("SITE_TPE_02", "台北內湖辦公室", "office", "北區", "台北市", 500),
    ("SITE_HSC_01", "新竹科學園區廠", "factory", "北區", "新竹市", 5000),
    ("SITE_TXG_01", "台中工業區廠房", "factory", "中區", "台中市", 3000),
    ("SITE_KHH_01", "高雄前鎮倉儲", "warehouse", "南區", "高雄市", 1000),
    ("SITE_KHH_02", "高雄楠梓加工區", "factory", "南區", "高雄市", 4000),
    ("SITE_EXT_01", "外部感測站（PZEM-004T）", "external", "外部", "Remote", None),
]

# device_id, site_id, device_name, device_type, rated_power_kw.
DEVICES = [
    ("DEV_TPE01_MAIN", "SITE_TPE_01", "主電錶", "main_meter", 2000),
    ("DEV_TPE01_L1", "SITE_TPE_01", "產線一電錶", "sub_meter", 800),
    ("DEV_TPE01_L2", "SITE_TPE_01", "產線二電錶", "sub_meter", 800),
    ("DEV_TPE01_AC", "SITE_TPE_01", "空調總錶", "sub_meter", 400),
    ("DEV_TPE02_MAIN", "SITE_TPE_02", "主電錶", "main_meter", 500),
    ("DEV_TPE02_FL3", "SITE_TPE_02", "3F辦公區", "sub_meter", 200),
    ("DEV_TPE02_SRV", "SITE_TPE_02", "機房電錶", "sub_meter", 150),
    ("DEV_HSC01_MAIN", "SITE_HSC_01", "主電錶", "main_meter", 5000),
    ("DEV_HSC01_FAB", "SITE_HSC_01", "無塵室電錶", "sub_meter", 2500),
    ("DEV_HSC01_CHL", "SITE_HSC_01", "冰水主機電錶", "sub_meter", 1500),
    ("DEV_TXG01_MAIN", "SITE_TXG_01", "主電錶", "main_meter", 3000),
    ("DEV_TXG01_CNC", "SITE_TXG_01", "CNC加工區", "sub_meter", 1800),
    ("DEV_KHH01_MAIN", "SITE_KHH_01", "主電錶", "main_meter", 1000),
    ("DEV_KHH02_MAIN", "SITE_KHH_02", "主電錶", "main_meter", 4000),
    ("DEV_KHH02_SMT", "SITE_KHH_02", "SMT產線電錶", "sub_meter", 2000),
    ("DEV_EXT_PZEM", "SITE_EXT_01", "PZEM-004T 電力監測模組", "iot_sensor", None),
]


def _frame(spark: SparkSession, rows: list[tuple], names: list[str], schema, created_at: Instant) -> DataFrame:
    df = small_table(spark, rows, names).withColumns(
        {"is_active": F.lit(True), "created_at": ntz(created_at)})
    return df.selectExpr(*S.casts(schema))


def seed_sites(spark: SparkSession, created_at: Instant) -> DataFrame:
    names = ["site_id", "site_name", "site_type", "region", "city", "capacity_kw"]
    return _frame(spark, SITES, names, S.sites_schema(), created_at)


def seed_devices(spark: SparkSession, created_at: Instant) -> DataFrame:
    """All seed devices are active."""
    names = ["device_id", "site_id", "device_name", "device_type", "rated_power_kw"]
    return _frame(spark, DEVICES, names, S.devices_schema(), created_at)

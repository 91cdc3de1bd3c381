"""Every operator as a query over the given tables, and its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe import schemas as S
from wattframe.functions import ntz
from wattframe.operators import audit as A
from wattframe.operators import quality as Q
from wattframe.operators import reads as R
from wattframe.operators.clean import dedupe_readings, mark_processed, mark_rejected, settle
from wattframe.operators.delta import energy_delta
from wattframe.operators.merge import upsert
from wattframe.operators.rollup import daily, hourly
from wattframe.plans import testdata as D
from wattframe.plans.pipeline import (days_from_raw, hours_from_raw, readings_from_raw, run_pipeline, run_quality,
                                      tails_from_raw)
from wattframe.plans.serving import devices_seen, newest_days, newest_hours, site_summary
from wattframe.session import shared_folder, streaming_session
from wattframe.sources.feed import METER_FIELDS, decode_feed, feed_rejects, new_since, parse_feed
from wattframe.sources.tables import Warehouse
from wattframe.streaming import checks, ingest, jobs

AS_OF = "2024-01-04 00:00:00"
MIDWAY = "2024-01-03 12:20:00"
EARLIER = "2024-01-02 08:30:00"
SITE, DEVICE = 7, 22
KEY = T.LongType()


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and whole numbers as longs, for comparison across engines."""
    def kind(f: T.StructField) -> str:
        if isinstance(f.dataType, T.DecimalType):
            return f"cast({f.name} as double) as {f.name}"
        return f"cast({f.name} as bigint) as {f.name}" if isinstance(f.dataType, T.IntegralType) else f.name
    return df.selectExpr(*map(kind, df.schema))


# Batch operators

def _dedupe(spark, folder):
    return plain(dedupe_readings(D.raw(spark, folder), AS_OF))


def _mark_rejected(spark, folder):
    return mark_rejected(D.raw(spark, folder), AS_OF).select("id", "is_processed", "quality_flag")


def _mark_processed(spark, folder):
    raw = D.raw(spark, folder)
    return mark_processed(raw, dedupe_readings(raw, AS_OF)).select("id", "is_processed", "quality_flag")


def _settle(spark, folder):
    return settle(D.raw(spark, folder), AS_OF).select("id", "is_processed", "quality_flag")


def _delta(spark, folder):
    return plain(readings_from_raw(D.raw(spark, folder), AS_OF).select(
        *S.FACT_GRAIN, "energy_kwh", "energy_delta", "raw_reading_id"))


def _delta_literal(spark, folder):
    fact = dedupe_readings(D.raw(spark, folder), MIDWAY)
    literal = energy_delta(fact, MIDWAY, "2 hours", carry_in=False, fill_only_null=True)
    return plain(literal.select(*S.FACT_GRAIN, "energy_kwh", "energy_delta"))


def _delta_recent(spark, folder):
    """Only the last two hours are filled, but their first readings see their predecessors."""
    raw = D.raw(spark, folder)
    filled = energy_delta(dedupe_readings(raw, MIDWAY), MIDWAY, "2 hours", tails=tails_from_raw(raw, MIDWAY))
    return plain(filled.select(*S.FACT_GRAIN, "energy_kwh", "energy_delta"))


def _hourly(spark, folder):
    return plain(hours_from_raw(D.raw(spark, folder), AS_OF))


def _hourly_window(aligned: bool):
    def query(spark, folder):
        fact = readings_from_raw(D.raw(spark, folder), MIDWAY, keep_hour=True)
        return plain(hourly(fact, MIDWAY, aligned=aligned))
    return query


def _daily(spark, folder):
    return plain(days_from_raw(D.raw(spark, folder), AS_OF))


def _daily_window(aligned: bool):
    def query(spark, folder):
        return plain(daily(hours_from_raw(D.raw(spark, folder), MIDWAY), MIDWAY, aligned=aligned))
    return query


def _upsert_hourly(spark, folder):
    """The table of an earlier run, replaced by the last three hours of a later one."""
    raw = D.raw(spark, folder)
    later = hourly(readings_from_raw(raw, MIDWAY, keep_hour=True), MIDWAY)
    earlier = hours_from_raw(raw, "2024-01-03 10:05:00")
    return plain(upsert(earlier, later, S.HOUR_GRAIN))


def _pipeline(*ticks: str):
    """Stored tables built by one run per tick over the rows ingested by then."""
    def query(spark, folder):
        tables = Warehouse(spark, shared_folder(spark), KEY)
        rows, since = D.raw(spark, folder), None
        for tick in ticks:
            landed = rows.filter(F.col("ingested_at") <= ntz(tick))
            if since:
                landed = landed.filter(F.col("ingested_at") > ntz(since))
            tables.append("raw", landed)
            run_pipeline(tables, tick)
            since = tick
        return plain(tables.read("daily"))
    return query


def _stored(read: Callable[[Warehouse], DataFrame]):
    """A read from the layers of a warehouse that two runs have filled."""
    def query(spark, folder):
        tables = Warehouse(spark, shared_folder(spark), KEY)
        tables.append("sites", D.sites(spark, folder))
        rows = D.raw(spark, folder)
        for low, high in ((None, MIDWAY), (MIDWAY, AS_OF)):
            landed = rows.filter(F.col("ingested_at") <= ntz(high))
            tables.append("raw", landed if low is None else landed.filter(F.col("ingested_at") > ntz(low)))
            run_pipeline(tables, high)
        return plain(read(tables))
    return query


def _run_anomalies(spark, folder):
    """Anomalies listed by two runs; each row is judged by the figures of all that had landed by its run."""
    tables, rows = Warehouse(spark, shared_folder(spark), KEY), D.raw(spark, folder)
    for low, high in ((None, MIDWAY), (MIDWAY, AS_OF)):
        landed = rows.filter(F.col("ingested_at") <= ntz(high))
        tables.append("raw", landed if low is None else landed.filter(F.col("ingested_at") > ntz(low)))
        run_pipeline(tables, high, z=2.0)
    return tables.read("anomalies").select("id", "device_id", F.round("z", 4).alias("z"))


def _gated_days(spark, folder):
    """Half of the devices become known only after the first run; some never do."""
    tables, rows = Warehouse(spark, shared_folder(spark), KEY), D.raw(spark, folder)
    late = F.col("device_id") % 2 == 1
    for known, low, high in ((D.devices(spark, folder).filter(~late), None, MIDWAY),
                             (D.devices(spark, folder).filter(late), MIDWAY, AS_OF)):
        tables.append("devices", known)
        landed = rows.filter(F.col("ingested_at") <= ntz(high))
        tables.append("raw", landed if low is None else landed.filter(F.col("ingested_at") > ntz(low)))
        run_pipeline(tables, high, gate=True)
    return plain(tables.read("daily"))


def _overlapping(spark, folder):
    """Rows that arrive while a run is under way, after it has listed its files, are taken by the next."""
    tables = Warehouse(spark, shared_folder(spark), KEY)
    rows = D.raw(spark, folder)
    tables.append("raw", rows.filter(F.col("ingested_at") <= ntz(MIDWAY)))
    listed = tables.unconsumed()
    tables.append("raw", rows.filter((F.col("ingested_at") > ntz(MIDWAY)) & (F.col("ingested_at") <= ntz(AS_OF))))
    run_pipeline(tables, AS_OF, files=listed)
    run_pipeline(tables, AS_OF)
    return plain(tables.read("daily"))


# Checks

def _check(name: str, lookback: str | None):
    def query(spark, folder):
        return Q.reading_checks(D.raw(spark, folder), MIDWAY, lookback, [name])
    return query


def _all_checks(spark, folder):
    return Q.reading_checks(D.raw(spark, folder), AS_OF, None)


def _gap(spark, folder):
    return Q.ingestion_gap(D.devices(spark, folder), D.raw(spark, folder), MIDWAY)


def _silent(spark, folder):
    return Q.silent_devices(D.devices(spark, folder), D.raw(spark, folder), MIDWAY).select("device_id", "site_id")


def _log(spark, folder):
    log = Q.run_checks(D.devices(spark, folder), D.raw(spark, folder), MIDWAY)
    return plain(log.drop("site_id", "device_id"))


def _log_stored(spark, folder):
    """The log table after two runs; each sees what had been ingested by its time."""
    tables = Warehouse(spark, shared_folder(spark), KEY)
    tables.append("devices", D.devices(spark, folder))
    tables.append("raw", D.raw(spark, folder))
    for tick in (EARLIER, MIDWAY):
        run_quality(tables, tick)
    return plain(tables.read("quality_log").drop("site_id", "device_id"))


def _anomalies(spark, folder):
    scored = Q.flag_anomalies(D.raw(spark, folder))
    return scored.select("id", "quality_flag", F.round("z", 4).alias("z"))


def _audit_unique(spark, folder):
    return A.duplicate_keys(D.raw(spark, folder), S.RAW_GRAIN)


def _audit_orphans(spark, folder):
    return A.orphan_keys(D.raw(spark, folder), "device_id", D.devices(spark, folder))


def _quarantine(spark, folder):
    return A.tag_orphans(D.raw(spark, folder), "device_id", D.devices(spark, folder)).select(
        "id", "device_id", "is_orphan")


def _audit_nulls(spark, folder):
    return A.null_counts(D.raw(spark, folder), S.raw_schema().names)


def _audit_contract(spark, folder):
    contract = A.Contract(unique=S.RAW_GRAIN, not_null=["active_power", "voltage_avg"],
                          references={"site_id": D.sites(spark, folder), "device_id": D.devices(spark, folder)},
                          decimals={"active_power": T.DecimalType(4, 2), "voltage_avg": T.DecimalType(8, 2)})
    return A.audit(D.raw(spark, folder), contract)


# Reads

def _days(spark, folder):
    return days_from_raw(D.raw(spark, folder), AS_OF)


def _find_hourly(**params):
    return lambda spark, folder: plain(R.find_hourly(hours_from_raw(D.raw(spark, folder), AS_OF), **params))


def _find_daily(**params):
    return lambda spark, folder: plain(R.find_daily(_days(spark, folder), **params))


def _summary(**params):
    return lambda spark, folder: plain(R.site_daily_summary(
        _days(spark, folder), D.sites(spark, folder), **params))


def _camel(spark, folder):
    return R.camel_case(plain(R.list_sites(D.sites(spark, folder))))


# Feed

def _feed_payloads(spark, folder, *more):
    """Each event as one response of its own channel; some numbers are unreadable."""
    raw = D.raw(spark, folder)
    power = (F.when(F.col("id") % 50 == 1, "nan").when(F.col("id") % 50 == 2, "n/a")
             .when(F.col("id") % 50 == 3, F.concat(F.lit(" "), F.col("demand_kw").cast("string"), F.lit("0 ")))
             .otherwise(F.col("demand_kw").cast("string")))
    stamp = F.concat(F.date_format("collected_at", "yyyy-MM-dd'T'HH:mm:ss"),
                     F.when(F.col("id") % 2 == 0, "Z").otherwise("+08:00"))
    entry = F.struct(stamp.alias("created_at"), F.col("energy_kwh").cast("string").alias("field1"),
                     power.alias("field2"), F.col("voltage_avg").cast("string").alias("field3"))
    return raw.select(F.col("device_id").alias("channel_id"),
                      F.to_json(F.struct(F.array(entry).alias("feeds"))).alias("payload"), *more)


def _channels(spark, folder):
    """Every customer is a channel."""
    source_of = {column: field for field, column in METER_FIELDS.items()}
    pairs = [F.lit(text) for pair in source_of.items() for text in pair]
    return D.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("channel_id"), (F.col("c_custkey") % 25).alias("site_id"),
        F.col("c_custkey").alias("device_id"), F.create_map(*pairs).alias("source_of"))


def _ingest_feed(spark, folder):
    decoded = decode_feed(parse_feed(_feed_payloads(spark, folder)), _channels(spark, folder), AS_OF)
    return plain(decoded.select(*S.RAW_GRAIN, "ingested_at", "energy_kwh", "active_power", "voltage_avg",
                                "current_avg", "reactive_power", "is_processed", "quality_flag"))


def _ingest_rejects(spark, folder):
    """Two entries per event: some times and numbers are unreadable, some channels unknown, some feeds missing."""
    case = F.col("id") % 7
    stamp = F.date_format("collected_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    good = F.struct(stamp.alias("created_at"), F.lit("230").alias("field3"))
    odd = F.struct(F.when(case == 0, "yesterday").otherwise(stamp).alias("created_at"),
                   F.when(case == 1, "1e9").otherwise("n/a").alias("field3"))
    payloads = D.raw(spark, folder).select(
        F.when(case == 2, -1).otherwise(F.col("device_id")).alias("channel_id"),
        F.when(case == 3, "{}").otherwise(F.to_json(F.struct(F.array(good, odd).alias("feeds")))).alias("payload"))
    rejects = feed_rejects(parse_feed(payloads), _channels(spark, folder), AS_OF)
    return rejects.select("channel_id", F.get_json_object("entry", "$.created_at").alias("created_at"), "reason")


def _broken_payloads(spark, folder):
    """Some responses are cut short, some are no JSON at all, and one is missing."""
    case = F.col("id") % 97
    sent = _feed_payloads(spark, folder, "id", "ingested_at").withColumn("source", F.lpad(F.col("id").cast("string"), 12, "0"))
    return sent.withColumn("payload", F.when(case == 5, F.expr("substr(payload, 1, length(payload) - 3)"))
                           .when(case == 6, "<html>").when(case == 7, None).otherwise(F.col("payload")))


def _ingest_broken(spark, folder):
    responses = parse_feed(_broken_payloads(spark, folder), mode="PERMISSIVE")
    rejects = feed_rejects(responses, _channels(spark, folder), AS_OF)
    kept = decode_feed(responses, _channels(spark, folder), AS_OF).groupBy("device_id").agg(
        F.count("*").alias("entries")).withColumn("reason", F.lit("KEPT"))
    lost = rejects.groupBy(F.col("channel_id").alias("device_id"), "reason").agg(F.count("source").alias("entries"))
    return kept.unionByName(lost)


def _run_ingest(spark, folder, tables, checkpoint):
    """The responses as landed JSON lines, read back as a stream."""
    landing = f"{tables.root}/_landing"
    sent = _broken_payloads(spark, folder).withColumnRenamed("ingested_at", "received_at")
    sent.select("channel_id", "payload", "source", "received_at").write.json(landing)
    landed = spark.readStream.schema(
        "channel_id long, payload string, source string, received_at timestamp_ntz").json(landing)
    ingest.stream_ingest(landed, _channels(spark, folder), tables, checkpoint, lambda: AS_OF).awaitTermination()
    return "raw"


def _ingest_incremental(spark, folder):
    raw = D.raw(spark, folder)
    return new_since(raw, raw.filter(F.col("ingested_at") <= ntz(MIDWAY))).select("id", *S.RAW_GRAIN)


# Streams: the events table is the source, stored tables the sink

def _streaming(run: Callable[[SparkSession, str, Warehouse, str], str]):
    """Runs a stream over all files at hand, then returns the table it wrote."""
    def query(spark, folder):
        child, root = streaming_session(spark), shared_folder(spark)
        name = run(child, folder, Warehouse(child, root, KEY), f"{root}/_checkpoint")
        return plain(Warehouse(spark, root, KEY).read(name))
    return query


def _run_clean(spark, folder, tables, checkpoint):
    jobs.stream_clean(D.raw_stream(spark, folder), tables, checkpoint, lambda: AS_OF).awaitTermination()
    return "readings"


def _run_delta(spark, folder, tables, checkpoint):
    jobs.stream_energy_delta(D.raw_stream(spark, folder), tables, checkpoint, lambda: AS_OF).awaitTermination()
    return "readings"


def _run_hourly(spark, folder, tables, checkpoint):
    """Reads the stored readings, deltas included, as a stream of files."""
    tables.append("readings", readings_from_raw(D.raw(spark, folder), AS_OF))
    source = spark.readStream.schema(tables.schema("readings")).parquet(tables.path("readings"))
    jobs.stream_hourly(source, tables, checkpoint, D.sites(spark, folder)).awaitTermination()
    return "hourly"


def _run_quality(spark, folder, tables, checkpoint):
    jobs.stream_quality(D.raw_stream(spark, folder), tables, checkpoint).awaitTermination()
    return "quality_windows"


def _run_quality_log(spark, folder, tables, checkpoint):
    checks.stream_quality_log(D.raw_stream(spark, folder), D.devices(spark, folder), tables, checkpoint,
                              EARLIER).awaitTermination()
    return "quality_stream"


def _site_names(spark, folder):
    """Raw stream enriched with its site names, written by the file sink."""
    child, root = streaming_session(spark), shared_folder(spark)
    named = jobs.with_site_name(D.raw_stream(child, folder), D.sites(child, folder))
    writer = named.select("id", "site_id", "site_name").writeStream.format("parquet")
    writer = writer.option("path", f"{root}/named").option("checkpointLocation", f"{root}/_checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("id bigint, site_id bigint, site_name string").parquet(f"{root}/named")


def _columns(query, *names):
    return lambda spark, folder: query(spark, folder).select(*names)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "site_daily_summary": _summary(),
    "site_daily_summary_range": _summary(start="2024-01-02", end="2024-01-03", limit=20),
    "site_daily_summary_site": _summary(site_id=SITE),
    "dedupe_readings": _dedupe,
    "mark_rejected": _mark_rejected,
    "mark_processed": _mark_processed,
    "settle_raw": _settle,
    "energy_delta": _delta,
    "energy_delta_recent": _delta_recent,
    "energy_delta_literal": _delta_literal,
    "hourly_energy": _hourly,
    "hourly_energy_recent": _hourly_window(True),
    "hourly_energy_literal": _hourly_window(False),
    "daily_energy": _daily,
    "daily_energy_recent": _daily_window(True),
    "daily_energy_literal": _daily_window(False),
    "upsert_hourly": _upsert_hourly,
    "pipeline_daily": _pipeline(AS_OF),
    "pipeline_daily_incremental": _pipeline(MIDWAY, AS_OF),
    "pipeline_overlapping_ingest": _overlapping,
    "dq_null_power": _check("NULL_POWER", "2 hours"),
    "dq_negative_power": _check("NEGATIVE_POWER", "2 hours"),
    "dq_voltage_range": _check("VOLTAGE_RANGE", "2 hours"),
    "dq_future_timestamp": _check("FUTURE_TIMESTAMP", "2 hours"),
    "dq_duplicates": _check("DUPLICATE_RATE", "2 hours"),
    "dq_all_history": _all_checks,
    "dq_ingestion_gap": _gap,
    "dq_silent_devices": _silent,
    "dq_log": _log,
    "dq_log_stored": _log_stored,
    "flag_anomalies": _anomalies,
    "audit_unique": _audit_unique,
    "audit_orphans": _audit_orphans,
    "audit_nulls": _audit_nulls,
    "audit_quarantine": _quarantine,
    "audit_contract": _audit_contract,
    "list_sites": lambda spark, folder: plain(R.list_sites(D.sites(spark, folder))),
    "list_sites_camel": _camel,
    "get_site": lambda spark, folder: plain(R.get_site(D.sites(spark, folder), SITE)),
    "list_devices": lambda spark, folder: plain(R.list_devices(D.devices(spark, folder), SITE)),
    "get_device": lambda spark, folder: plain(R.get_device(D.devices(spark, folder), DEVICE)),
    "find_hourly": _find_hourly(),
    "find_hourly_filtered": _find_hourly(site_id=DEVICE % 25, device_id=DEVICE, start="2024-01-01", end="2024-01-02"),
    "find_daily": _find_daily(start="2024-01-01", end="2024-01-02", limit=50),
    "find_daily_from": _find_daily(start="2024-01-02"),
    "find_daily_to": _find_daily(end="2024-01-02", site_id=SITE),
    "pipeline_anomalies": _run_anomalies,
    "pipeline_gated": _gated_days,
    "find_hourly_stored": _stored(newest_hours),
    "find_hourly_stored_filtered": _stored(lambda tables: newest_hours(
        tables, site_id=DEVICE % 25, device_id=DEVICE, start="2024-01-01", end="2024-01-02")),
    "find_daily_stored": _stored(lambda tables: newest_days(tables, start="2024-01-01", end="2024-01-02", limit=50)),
    "site_summary_stored": _stored(site_summary),
    "site_devices_seen": _stored(lambda tables: devices_seen(tables, "2024-01-02", "2024-01-03")),
    "ingest_feed": _ingest_feed,
    "ingest_rejects": _ingest_rejects,
    "ingest_broken": _ingest_broken,
    "ingest_incremental": _ingest_incremental,
    "stream_clean": _columns(_streaming(_run_clean), *S.FACT_GRAIN, *S.MEASURES, "raw_reading_id"),
    "stream_energy_delta": _columns(_streaming(_run_delta), *S.FACT_GRAIN, "energy_kwh", "energy_delta",
                                    "raw_reading_id"),
    "stream_hourly": _columns(_streaming(_run_hourly), *S.hourly_schema().names),
    "stream_quality": _columns(_streaming(_run_quality), *S.windows_schema().names),
    "stream_ingest": _columns(_streaming(_run_ingest), *S.RAW_GRAIN, "ingested_at", "energy_kwh", "active_power",
                              "voltage_avg", "current_avg", "is_processed", "quality_flag"),
    "stream_quality_log": _columns(_streaming(_run_quality_log), "check_time", "check_type", "status", "metric_value",
                                   "threshold_value", "message"),
    "stream_site_names": _site_names,
}


# SQL counterparts

def _select(columns: dict[str, str]) -> str:
    return ", ".join(D.select_list(columns, "timestamp"))


def _mean(column: str, factor: int, kind: str) -> str:
    """Mean of non-negative decimals, exactly rounded half up."""
    return (f"cast(cast((2 * sum(cast({column} * {factor} as hugeint)) + count({column}))"
            f" // (2 * count({column})) as double) / {factor} as {kind})")


def _ctes(as_of: str, hour_filter: str = "true", day_filter: str = "true") -> str:
    """raw, sites, devices, fact, reading, hours and days as seen at ``as_of``."""
    return f"""
with raw as (select {_select(D.RAW)} from events),
sites as (select {_select(D.SITES)} from nation join region on n_regionkey = r_regionkey),
devices as (select {_select(D.DEVICES)} from supplier),
ranked as (
  select *, row_number() over (partition by site_id, device_id, collected_at
                               order by ingested_at desc, id desc) as rn
  from raw
  where not is_processed and quality_flag <> 'ANOMALY' and active_power is not null
    and active_power >= 0 and collected_at <= timestamp '{as_of}'),
fact as (
  select site_id, device_id, collected_at as reading_time, voltage_avg, current_avg, active_power,
         reactive_power, power_factor, frequency, energy_kwh, demand_kw, id as raw_reading_id
  from ranked where rn = 1),
stepped as (
  select *, energy_kwh - lag(energy_kwh) over (partition by site_id, device_id order by reading_time) as step
  from fact),
reading as (
  select * exclude (step), cast(case when step >= 0 then step end as decimal(10,4)) as energy_delta from stepped),
hours as (
  select site_id, device_id, date_trunc('hour', reading_time) as hour_start,
         {_mean('active_power', 100, 'decimal(12,2)')} as avg_power_kw,
         max(active_power) as max_power_kw, min(active_power) as min_power_kw,
         cast(sum(coalesce(energy_delta, 0)) as decimal(12,4)) as energy_kwh,
         {_mean('power_factor', 10000, 'decimal(5,4)')} as avg_pf,
         {_mean('voltage_avg', 100, 'decimal(8,2)')} as avg_voltage,
         cast(count(*) as bigint) as reading_count
  from reading where {hour_filter}
  group by site_id, device_id, date_trunc('hour', reading_time)),
days as (
  select site_id, device_id, cast(hour_start as date) as reading_date,
         cast(sum(energy_kwh) as decimal(14,4)) as total_energy_kwh,
         max(max_power_kw) as peak_demand_kw,
         {_mean('avg_power_kw', 100, 'decimal(12,2)')} as avg_power_kw,
         max(max_power_kw) as max_power_kw, min(min_power_kw) as min_power_kw,
         {_mean('avg_pf', 10000, 'decimal(5,4)')} as avg_pf,
         {_mean('avg_voltage', 100, 'decimal(8,2)')} as avg_voltage,
         cast(sum(reading_count) as bigint) as reading_count
  from hours where {day_filter}
  group by site_id, device_id, cast(hour_start as date))
"""


def _doubles(*names: str) -> str:
    return ", ".join(f"cast({n} as double) as {n}" for n in names)


MEASURES = _doubles(*S.MEASURES)
HOURS = ("site_id, device_id, hour_start, reading_count, "
         + _doubles("avg_power_kw", "max_power_kw", "min_power_kw", "energy_kwh", "avg_pf", "avg_voltage"))
DAYS = ("site_id, device_id, reading_date, reading_count, "
        + _doubles("total_energy_kwh", "peak_demand_kw", "avg_power_kw", "max_power_kw", "min_power_kw",
                   "avg_pf", "avg_voltage"))
SITE_LIST = "site_id, site_name, site_type, region, city, created_at, " + _doubles("capacity_kw")
DEVICE_LIST = ("device_id, site_id, device_name, device_type, is_active, created_at, "
               + _doubles("rated_power_kw"))
DELTAS = "site_id, device_id, reading_time, raw_reading_id, " + _doubles("energy_kwh", "energy_delta")


def _summary_sql(where: str = "true", limit: int = 200) -> str:
    return _ctes(AS_OF) + f"""
select d.site_id, s.site_name, d.reading_date,
       cast(sum(d.total_energy_kwh) as double) as total_energy_kwh,
       cast(max(d.peak_demand_kw) as double) as peak_demand_kw,
       cast(sum(d.avg_power_kw) as double) / count(d.avg_power_kw) as avg_power_kw,
       count(distinct d.device_id) as device_count
from days d join sites s on d.site_id = s.site_id
where {where}
group by d.site_id, s.site_name, d.reading_date
order by d.reading_date desc, d.site_id limit {limit}"""


def _check_sql(name: str, metric: str, recent: str) -> str:
    return f"select '{name}' as check_type, cast({metric} as bigint) as metric_value from raw where {recent}"


def _check_metrics(as_of: str) -> dict[str, str]:
    return {
        "NULL_POWER": "count(*) filter (where active_power is null)",
        "NEGATIVE_POWER": "count(*) filter (where active_power < 0)",
        "VOLTAGE_RANGE": "count(*) filter (where voltage_avg < 180 or voltage_avg > 260)",
        "FUTURE_TIMESTAMP": f"count(*) filter (where collected_at > timestamp '{as_of}')",
        "DUPLICATE_RATE": "count(*) - count(distinct (site_id, device_id, collected_at))",
    }


def _within(as_of: str, lookback: str) -> str:
    return f"ingested_at > timestamp '{as_of}' - interval '{lookback}' and ingested_at <= timestamp '{as_of}'"


def _silent_sql(as_of: str) -> str:
    """Active devices, less those heard of."""
    heard = f"select device_id as heard from raw where {_within(as_of, '10 minutes')} group by device_id"
    return f"from devices left join ({heard}) on device_id = heard where is_active and heard is null"


def _gap_sql(as_of: str) -> str:
    return f"select 'INGESTION_GAP' as check_type, count(distinct device_id) as metric_value {_silent_sql(as_of)}"


def _checks_sql(as_of: str, recent: str) -> str:
    return " union all ".join(_check_sql(n, m, recent) for n, m in _check_metrics(as_of).items())


def _one_check(name: str) -> str:
    return _ctes(MIDWAY) + _check_sql(name, _check_metrics(MIDWAY)[name], _within(MIDWAY, "2 hours"))


# Check names, largest passing metrics and messages, written out apart from those under test.
LIMITS = """
    ('NULL_POWER', 10, 'Readings with null active_power'),
    ('NEGATIVE_POWER', 10, 'Readings with negative active_power (sensor wiring error)'),
    ('VOLTAGE_RANGE', 5, 'Readings with voltage outside 180-260V'),
    ('FUTURE_TIMESTAMP', 5, 'Readings with collected_at in the future (clock drift)'),
    ('DUPLICATE_RATE', 20, 'Duplicate readings per (site, device, time) in last 2 hours'),
    ('INGESTION_GAP', 3, 'Devices with no data in the last 10 minutes')"""


def _log_sql(as_of: str) -> str:
    return _ctes(as_of) + f"""
select timestamp '{as_of}' as check_time, check_type,
       case when metric_value <= threshold then 'PASS' else 'FAIL' end as status,
       cast(metric_value as double) as metric_value, cast(threshold as double) as threshold_value, message
from ({_checks_sql(as_of, _within(as_of, "2 hours"))} union all {_gap_sql(as_of)})
join (values {LIMITS}) as limits(check_type, threshold, message) using (check_type)"""


def _nulls_sql() -> str:
    return _ctes(AS_OF) + " union all ".join(
        f"select '{c}' as column_name, count(*) filter (where {c} is null) as null_rows from raw"
        for c in S.raw_schema().names)


CONTRACT_SQL = _ctes(AS_OF) + """
select 'unique' as "constraint", 'site_id,device_id,collected_at' as subject,
       count(*) - count(distinct (site_id, device_id, collected_at)) as violations from raw
union all select 'not_null', 'active_power', count(*) filter (where active_power is null) from raw
union all select 'not_null', 'voltage_avg', count(*) filter (where voltage_avg is null) from raw
union all select 'reference', 'site_id', count(*) from raw where site_id not in (select site_id from sites)
union all select 'reference', 'device_id', count(*) from raw where device_id not in (select device_id from devices)
union all select 'decimal', 'active_power', count(*) filter (where abs(active_power) >= 100) from raw
union all select 'decimal', 'voltage_avg', count(*) filter (where abs(voltage_avg) >= 1000000) from raw"""

ANOMALY_SQL = _ctes(AS_OF) + """, scored as (
  select id, quality_flag as flag,
         (cast(active_power as double) - avg(cast(active_power as double)) over d)
           / nullif(stddev_samp(cast(active_power as double)) over d, 0) as score
  from raw window d as (partition by device_id))
select id, case when abs(score) > 3 and flag = 'RAW' then 'ANOMALY' else flag end as quality_flag,
       round(score, 4) as z
from scored"""

FEED_ROWS = f"""
select site_id, device_id,
       case when id % 2 = 0 then collected_at else collected_at - interval '8 hours' end as collected_at,
       timestamp '{AS_OF}' as ingested_at,
       cast(energy_kwh as double) as energy_kwh,
       case when id % 50 in (1, 2) then null else cast(demand_kw as double) end as active_power,
       cast(voltage_avg as double) as voltage_avg, cast(null as double) as current_avg,
       cast(null as double) as reactive_power, false as is_processed, 'RAW' as quality_flag
from raw"""

FEED_SQL = _ctes(AS_OF) + FEED_ROWS

BROKEN_SQL = _ctes(AS_OF) + """
select device_id, case when id % 97 in (5, 6) then 'BAD_JSON' else 'KEPT' end as reason, count(*) as entries
from raw where id % 97 <> 7 group by all"""

# A reading of a response counts if it is later than all of the responses before it.
STREAMED_FEED_SQL = _ctes(AS_OF) + ", feed as (" + FEED_ROWS.replace("select ", "select id, raw.ingested_at as received_at, ", 1) + """),
passed as (
  select *, max(collected_at) over (partition by site_id, device_id order by received_at, id
                                    rows between unbounded preceding and 1 preceding) as mark
  from feed where id % 97 not in (5, 6, 7))
select site_id, device_id, collected_at, ingested_at, energy_kwh, active_power, voltage_avg, current_avg,
       is_processed, quality_flag from passed where mark is null or collected_at > mark"""

REJECTS_SQL = _ctes(AS_OF) + """
select case when id % 7 = 2 then -1 else device_id end as channel_id,
       case when id % 7 = 0 then 'yesterday' else strftime(collected_at, '%Y-%m-%dT%H:%M:%SZ') end as created_at,
       case id % 7 when 0 then 'BAD_TIME' when 1 then 'NUMBER_TOO_LARGE' else 'UNKNOWN_CHANNEL' end as reason
from raw, (values (1), (2)) as entries(n)
where id % 7 = 2 or (id % 7 < 2 and n = 2)"""

INCREMENTAL_SQL = _ctes(AS_OF) + f"""
select r.id, r.site_id, r.device_id, r.collected_at from raw r
left join (select site_id, device_id, max(collected_at) as mark from raw
           where ingested_at <= timestamp '{MIDWAY}' group by site_id, device_id) m
  on r.site_id = m.site_id and r.device_id = m.device_id
where m.mark is null or r.collected_at > m.mark"""

WINDOWS_SQL = _ctes(AS_OF) + """
select window_start, window_start + interval '2 hours' as window_end,
       count(*) filter (where active_power is null) as null_power,
       count(*) filter (where active_power < 0) as negative_power,
       count(*) filter (where voltage_avg < 180 or voltage_avg > 260) as voltage_range,
       count(*) filter (where collected_at > window_start + interval '2 hours') as future_timestamp
from (select *, date_trunc('hour', ingested_at) - interval '1 hour' * back as window_start
      from raw, (values (0), (1)) as shifts(back))
group by window_start"""

# Each full hour that the watermark, three hours behind the last reading, has passed.
HOURLY_LOG_SQL = _ctes(AS_OF) + f""", ticks as (
  select unnest(generate_series(date_trunc('hour', timestamp '{EARLIER}') + interval '1 hour',
                                (select max(ingested_at) from raw) - interval '3 hours 1 millisecond',
                                interval '1 hour')) as t),
landed as (select * from ticks join raw on ingested_at > t - interval '2 hours' and ingested_at <= t),
metrics as (
  select t, check_type, metric_value from (
    select t, count(id) filter (where active_power is null) as "NULL_POWER",
           count(id) filter (where active_power < 0) as "NEGATIVE_POWER",
           count(id) filter (where voltage_avg < 180 or voltage_avg > 260) as "VOLTAGE_RANGE",
           count(id) filter (where collected_at > t) as "FUTURE_TIMESTAMP",
           count(id) - count(distinct (site_id, device_id, collected_at)) filter (where id is not null)
             as "DUPLICATE_RATE"
    from ticks left join landed using (t) group by t)
  unpivot (metric_value for check_type in
           ("NULL_POWER", "NEGATIVE_POWER", "VOLTAGE_RANGE", "FUTURE_TIMESTAMP", "DUPLICATE_RATE"))
  union all
  select t, 'INGESTION_GAP', (select count(distinct device_id) from devices where is_active)
                             - count(distinct device_id)
  from ticks left join (
    select l.t, l.device_id from landed l join devices d on l.device_id = d.device_id and d.is_active
    where l.ingested_at > l.t - interval '10 minutes') using (t)
  group by t)
select t as check_time, check_type, case when metric_value <= threshold then 'PASS' else 'FAIL' end as status,
       cast(metric_value as double) as metric_value, cast(threshold as double) as threshold_value, message
from metrics join (values {LIMITS}) as limits(check_type, threshold, message) using (check_type)"""


HOUR_CUT = f"reading_time > timestamp '{MIDWAY}' - interval '3 hours'"
HOUR_CUT_ALIGNED = f"reading_time >= date_trunc('hour', timestamp '{MIDWAY}' - interval '3 hours')"
DAY_CUT = f"hour_start > timestamp '{MIDWAY}' - interval '2 days'"
DAY_CUT_ALIGNED = f"hour_start >= date_trunc('day', timestamp '{MIDWAY}' - interval '2 days')"


def _upsert_sql() -> str:
    """Hours as of the earlier run, with the later run's hours in their place."""
    later = _ctes(MIDWAY, HOUR_CUT_ALIGNED) + "select * from hours"
    return _ctes("2024-01-03 10:05:00") + f""", later as ({later})
select {HOURS} from hours h
where not exists (select 1 from later l where l.site_id = h.site_id and l.device_id = h.device_id
                    and l.hour_start = h.hour_start)
union all select {HOURS} from later"""


DAYS_SQL = _ctes(AS_OF) + f"select {DAYS} from days"

ORACLES: dict[str, str] = {
    "site_daily_summary": _summary_sql(),
    "site_daily_summary_range": _summary_sql(
        "d.reading_date >= date '2024-01-02' and d.reading_date <= date '2024-01-03'", 20),
    "site_daily_summary_site": _summary_sql(f"d.site_id = {SITE}"),
    "dedupe_readings": _ctes(AS_OF) + f"""
select site_id, device_id, reading_time, raw_reading_id, {MEASURES} from fact""",
    "mark_rejected": _ctes(AS_OF) + f"""
select id,
       quality_flag = 'ANOMALY' or active_power is null or active_power < 0
         or collected_at > timestamp '{AS_OF}' as is_processed,
       case when quality_flag = 'ANOMALY' then 'ANOMALY'
            when active_power is null then 'REJECTED_NULL'
            when active_power < 0 then 'REJECTED_NEGATIVE'
            when collected_at > timestamp '{AS_OF}' then 'REJECTED_FUTURE'
            else quality_flag end as quality_flag
from raw""",
    "mark_processed": _ctes(AS_OF) + """
select id, id in (select raw_reading_id from fact) as is_processed, quality_flag from raw""",
    "settle_raw": _ctes(AS_OF) + f"""
select id, true as is_processed,
       case when quality_flag = 'ANOMALY' then 'ANOMALY'
            when active_power is null then 'REJECTED_NULL'
            when active_power < 0 then 'REJECTED_NEGATIVE'
            when collected_at > timestamp '{AS_OF}' then 'REJECTED_FUTURE'
            else quality_flag end as quality_flag
from raw""",
    "energy_delta": _ctes(AS_OF) + f"select {DELTAS} from reading",
    "energy_delta_recent": _ctes(MIDWAY) + f"""
select site_id, device_id, reading_time, cast(energy_kwh as double) as energy_kwh,
       cast(case when reading_time > timestamp '{MIDWAY}' - interval '2 hours' then energy_delta end as double)
         as energy_delta
from reading""",
    "energy_delta_literal": _ctes(MIDWAY) + f""", recent as (
  select raw_reading_id, energy_kwh - lag(energy_kwh) over (
           partition by site_id, device_id order by reading_time) as step
  from fact where reading_time > timestamp '{MIDWAY}' - interval '2 hours')
select f.site_id, f.device_id, f.reading_time, cast(f.energy_kwh as double) as energy_kwh,
       cast(case when r.step >= 0 then r.step end as double) as energy_delta
from fact f left join recent r on f.raw_reading_id = r.raw_reading_id""",
    "hourly_energy": _ctes(AS_OF) + f"select {HOURS} from hours",
    "hourly_energy_recent": _ctes(MIDWAY, HOUR_CUT_ALIGNED) + f"select {HOURS} from hours",
    "hourly_energy_literal": _ctes(MIDWAY, HOUR_CUT) + f"select {HOURS} from hours",
    "daily_energy": DAYS_SQL,
    "daily_energy_recent": _ctes(MIDWAY, day_filter=DAY_CUT_ALIGNED) + f"select {DAYS} from days",
    "daily_energy_literal": _ctes(MIDWAY, day_filter=DAY_CUT) + f"select {DAYS} from days",
    "upsert_hourly": _upsert_sql(),
    "pipeline_daily": DAYS_SQL,
    "pipeline_daily_incremental": DAYS_SQL,
    "pipeline_overlapping_ingest": DAYS_SQL,
    "dq_null_power": _one_check("NULL_POWER"),
    "dq_negative_power": _one_check("NEGATIVE_POWER"),
    "dq_voltage_range": _one_check("VOLTAGE_RANGE"),
    "dq_future_timestamp": _one_check("FUTURE_TIMESTAMP"),
    "dq_duplicates": _one_check("DUPLICATE_RATE"),
    "dq_all_history": _ctes(AS_OF) + _checks_sql(AS_OF, "true"),
    "dq_ingestion_gap": _ctes(MIDWAY) + _gap_sql(MIDWAY),
    "dq_silent_devices": _ctes(MIDWAY) + f"select device_id, site_id {_silent_sql(MIDWAY)}",
    "dq_log": _log_sql(MIDWAY),
    "dq_log_stored": f"({_log_sql(EARLIER)}) union all ({_log_sql(MIDWAY)})",
    "flag_anomalies": ANOMALY_SQL,
    "audit_unique": _ctes(AS_OF) + """
select site_id, device_id, collected_at, count(*) as copies from raw
group by site_id, device_id, collected_at having count(*) > 1""",
    "audit_orphans": _ctes(AS_OF) + """
select device_id, count(*) as orphan_rows from raw
where device_id not in (select device_id from devices) group by device_id""",
    "audit_nulls": _nulls_sql(),
    "audit_contract": CONTRACT_SQL,
    "audit_quarantine": _ctes(AS_OF) + """
select id, device_id, device_id not in (select device_id from devices) as is_orphan from raw""",
    "list_sites": _ctes(AS_OF) + f"select {SITE_LIST} from sites order by site_id",
    "list_sites_camel": _ctes(AS_OF) + """
select site_id as "siteId", site_name as "siteName", site_type as "siteType", region, city,
       cast(capacity_kw as double) as "capacityKw", created_at as "createdAt"
from sites order by site_id""",
    "get_site": _ctes(AS_OF) + f"select {SITE_LIST} from sites where site_id = {SITE}",
    "list_devices": _ctes(AS_OF) + f"select {DEVICE_LIST} from devices where site_id = {SITE} order by device_id",
    "get_device": _ctes(AS_OF) + f"select {DEVICE_LIST} from devices where device_id = {DEVICE}",
    "find_hourly": _ctes(AS_OF) + f"""
select {HOURS} from hours order by hour_start desc, site_id, device_id limit 500""",
    "find_hourly_filtered": _ctes(AS_OF) + f"""
select {HOURS} from hours
where site_id = {DEVICE % 25} and device_id = {DEVICE} and hour_start >= timestamp '2024-01-01'
  and hour_start < date '2024-01-02' + interval '1 day'
order by hour_start desc, site_id, device_id limit 500""",
    "find_daily": _ctes(AS_OF) + f"""
select {DAYS} from days where reading_date between date '2024-01-01' and date '2024-01-02'
order by reading_date desc, site_id, device_id limit 50""",
    "find_daily_from": _ctes(AS_OF) + f"""
select {DAYS} from days where reading_date >= date '2024-01-02'
order by reading_date desc, site_id, device_id limit 500""",
    "find_daily_to": _ctes(AS_OF) + f"""
select {DAYS} from days where site_id = {SITE} and reading_date <= date '2024-01-02'
order by reading_date desc, site_id, device_id limit 500""",
    "pipeline_anomalies": _ctes(AS_OF) + f""", judged as (
  select r.id, r.device_id, r.quality_flag, (r.active_power - avg(l.active_power)) / nullif(stddev_samp(l.active_power), 0) as z
  from raw r join raw l on r.device_id = l.device_id
    and l.ingested_at <= case when r.ingested_at <= timestamp '{MIDWAY}' then timestamp '{MIDWAY}'
                              else timestamp '{AS_OF}' end
  group by r.id, r.device_id, r.quality_flag, r.active_power)
select id, device_id, round(z, 4) as z from judged where abs(z) > 2 and quality_flag = 'RAW'""",
    "pipeline_gated": _ctes(AS_OF) + f"select {DAYS} from days where device_id in (select device_id from devices)",
    "site_devices_seen": _ctes(AS_OF) + """
select site_id, count(distinct device_id) as device_count from days
where reading_date between date '2024-01-02' and date '2024-01-03' group by site_id""",
    "ingest_feed": FEED_SQL,
    "ingest_rejects": REJECTS_SQL,
    "ingest_broken": BROKEN_SQL,
    "ingest_incremental": INCREMENTAL_SQL,
    "stream_clean": _ctes(AS_OF) + f"""
select site_id, device_id, reading_time, raw_reading_id, {MEASURES} from fact""",
    "stream_energy_delta": _ctes(AS_OF) + f"select {DELTAS} from reading",
    "stream_hourly": _ctes(AS_OF) + f"select {HOURS} from hours",
    "stream_quality": WINDOWS_SQL,
    "stream_ingest": STREAMED_FEED_SQL,
    "stream_quality_log": HOURLY_LOG_SQL,
    "stream_site_names": _ctes(AS_OF) + """
select r.id, r.site_id, s.site_name from raw r left join sites s on r.site_id = s.site_id""",
}
ORACLES |= {stored: ORACLES[plan] for stored, plan in (
    ("find_hourly_stored", "find_hourly"), ("find_hourly_stored_filtered", "find_hourly_filtered"),
    ("find_daily_stored", "find_daily"), ("site_summary_stored", "site_daily_summary"))}

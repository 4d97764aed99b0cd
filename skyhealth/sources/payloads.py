"""Landed JSON payload scans.

Payloads are read with explicit schemas and flattened with ``explode`` /
``inline`` — no Python parsing. ``read_*`` functions scan files;
``parse_*`` functions take a DataFrame with a JSON string column, so the
same flattening serves files, Kafka values or table columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyhealth.schemas import (HOURLY_COLUMNAR_PAYLOAD, HOURLY_VARIABLES,
                               POLLUTION_SLOTS_PAYLOAD, WEATHER_SLOTS_PAYLOAD)


def read_json(spark: SparkSession, path: str, schema: T.StructType,
              multiline: bool = True) -> DataFrame:
    """JSON file source with an explicit schema; adds the source file path."""
    return (spark.read.schema(schema).option("multiLine", multiline).json(path)
            .withColumn("source_file", F.col("_metadata.file_path")))


def parse_json_column(df: DataFrame, col: str, schema: T.StructType) -> DataFrame:
    """Parse a JSON text column into top-level columns.

    The parse runs inside a generator (``inline`` of a one-element array),
    so each document is parsed exactly once; plain ``from_json(...).field``
    projections get rewritten into one pruned parse per extracted field.
    """
    keep = [c for c in df.columns if c != col]
    return df.select(*keep, F.inline(F.array(F.from_json(F.col(col), schema))))


def epoch_to_date(dt: Column, tz: str = "UTC") -> Column:
    """epoch seconds → calendar date in ``tz``."""
    return F.to_date(F.from_utc_timestamp(F.timestamp_seconds(dt), tz))


def explode_weather_slots(payload: DataFrame, tz: str = "UTC") -> DataFrame:
    """S3: ``list[]`` of 3-hourly slots → one row per slot, units normalised.

    Wind m/s → km/h; missing gust falls back to speed (F15); missing
    temp_max/min fall back to temp; missing rain is 0.
    """
    s = payload.select(*[c for c in payload.columns if c != "list"],
                       F.explode("list").alias("s"))
    speed = F.col("s.wind.speed")
    return s.select(
        *[c for c in payload.columns if c != "list"],
        F.col("s.dt").alias("dt"),
        epoch_to_date(F.col("s.dt"), tz).alias("date"),
        F.col("s.main.temp").alias("temp"),
        F.coalesce("s.main.temp_max", "s.main.temp").alias("temp_max"),
        F.coalesce("s.main.temp_min", "s.main.temp").alias("temp_min"),
        F.col("s.main.feels_like").alias("feels_like"),
        F.col("s.main.humidity").alias("humidity"),
        F.col("s.main.pressure").alias("pressure"),
        (speed * F.lit(3.6)).alias("wind"),
        (F.coalesce(F.col("s.wind.gust"), speed) * F.lit(3.6)).alias("wind_gust"),
        F.col("s.clouds.all").alias("cloud"),
        F.coalesce(F.col("s.rain.3h"), F.lit(0.0)).alias("rain_3h"),
    )


def explode_pollution_slots(payload: DataFrame, tz: str = "UTC") -> DataFrame:
    """``list[].components`` → one row per hourly slot."""
    s = payload.select(*[c for c in payload.columns if c != "list"],
                       F.explode("list").alias("s"))
    return s.select(
        *[c for c in payload.columns if c != "list"],
        F.col("s.dt").alias("dt"),
        epoch_to_date(F.col("s.dt"), tz).alias("date"),
        F.col("s.main.aqi").alias("owm_aqi"),
        F.col("s.components.pm2_5").alias("pm25"),
        F.col("s.components.pm10").alias("pm10"),
        F.col("s.components.o3").alias("ozone"),
        F.col("s.components.no2").alias("nitrogen_dioxide"),
        F.col("s.components.so2").alias("sulphur_dioxide"),
        F.col("s.components.co").alias("carbon_monoxide"),
    )


def explode_hourly_columnar(payload: DataFrame) -> DataFrame:
    """``hourly`` dict of parallel arrays → rows; empty/missing → no rows."""
    keep = [c for c in payload.columns if c != "hourly"]
    n = F.size("hourly.time")
    # A variable the provider omitted becomes NULLs (arrays_zip of a NULL array is NULL).
    arrays = [F.col("hourly.time").alias("time")] + [
        F.coalesce(F.col(f"hourly.{v}"), F.array_repeat(F.lit(None).cast("double"), n)).alias(v)
        for v in HOURLY_VARIABLES]
    zipped = F.arrays_zip(*arrays)
    return (payload.where(F.col("hourly.time").isNotNull())
            .select(*keep, F.inline(zipped)))


def wrap_days(daily: DataFrame, group_keys: list[str], fetched_at: Column) -> DataFrame:
    """K2: daily records → ``{fetched_at, days:[...]}`` JSON per run.

    Each group is one forecast run: at most the three forecast days, so the
    collected array is bounded by construction.
    """
    payload_cols = [c for c in daily.columns if c not in group_keys]
    return (daily.groupBy(*group_keys)
            .agg(F.sort_array(F.collect_list(F.struct(*payload_cols))).alias("days"))
            .select(*group_keys, F.to_json(F.struct(fetched_at.alias("fetched_at"),
                                                    F.col("days"))).alias("payload")))


def unwrap_days(payload: DataFrame, day_schema: T.StructType, col: str = "payload") -> DataFrame:
    """``{fetched_at, days:[...]}`` → one row per day with a typed date."""
    schema = T.StructType([T.StructField("fetched_at", T.StringType(), True),
                           T.StructField("days", T.ArrayType(day_schema), True)])
    keep = [c for c in payload.columns if c != col]
    doc = parse_json_column(payload, col, schema)
    return (doc.select(*keep, "fetched_at", F.explode("days").alias("d"))
            .select(*keep, "fetched_at", "d.*")
            .withColumn("date", F.to_date("date")))


def latest_record_asof(records: DataFrame, calendar: DataFrame, keys: list[str],
                       record_date: str = "date", as_of: str = "as_of") -> DataFrame:
    """For every (key, as_of) day use the record of that day, else the
    latest earlier one (lexicographic file-date order = date order).

    A carry in two levels, so that no key is one window: the last record of
    each month is an aggregate, the carry over a key's months is a window of one
    row a month, and inside a month the days are scanned from that carry. Of
    several records of a day the greatest is used.
    """
    payload = [c for c in records.columns if c not in keys and c != record_date]
    month = lambda d: F.year(d) * 12 + F.month(d)                         # noqa: E731
    rec = records.where(F.col(record_date).isNotNull()).select(
        *keys, F.col(record_date).alias("__d"), F.struct(F.col(record_date).alias("file_date"), *payload).alias("__r"))
    rec = rec.withColumn("__m", month("__d"))
    cal = calendar.select(*keys, F.col(as_of).alias("__d"), month(as_of).alias("__m")).where("__d IS NOT NULL")
    none = F.lit(None).cast(rec.schema["__r"].dataType)
    ends = rec.groupBy(*keys, "__m").agg(F.max("__r").alias("__r"))
    months = ends.unionByName(cal.select(*keys, "__m").distinct().withColumn("__r", none)).groupBy(*keys, "__m").agg(F.max("__r").alias("__r"))
    by_month = Window.partitionBy(*keys).orderBy("__m").rowsBetween(Window.unboundedPreceding, -1)
    carry = months.withColumn("__r", F.last("__r", ignorenulls=True).over(by_month)).where("__r IS NOT NULL")
    # 0: what came before the month, 1: a record, 2: a day that asks.
    rows = (carry.select(*keys, "__m", F.lit(None).cast("date").alias("__d"), F.lit(0).alias("__k"), "__r")
            .unionByName(rec.select(*keys, "__m", "__d", F.lit(1).alias("__k"), "__r"))
            .unionByName(cal.select(*keys, "__m", "__d", F.lit(2).alias("__k"), none.alias("__r"))))
    in_month = (Window.partitionBy(*keys, "__m").orderBy("__d", "__k", "__r")
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    picked = rows.withColumn("__pick", F.last("__r", ignorenulls=True).over(in_month))
    return (picked.where("__k = 2 AND __pick IS NOT NULL")
            .select(*keys, F.col("__d").alias(as_of), "__pick.*"))


__all__ = ["read_json", "parse_json_column", "explode_weather_slots", "explode_pollution_slots",
           "explode_hourly_columnar", "wrap_days", "unwrap_days", "latest_record_asof",
           "latest_landed_record",
           "epoch_to_date", "WEATHER_SLOTS_PAYLOAD", "POLLUTION_SLOTS_PAYLOAD",
           "HOURLY_COLUMNAR_PAYLOAD"]


def latest_landed_record(spark: SparkSession, pattern: str, schema: T.StructType,
                         as_of: str, keys: list[str] | None = None) -> DataFrame:
    """S7 over files: among landed one-record files named ``<prefix>_YYYYMMDD.json``
    take, per key, the file dated ``as_of`` or else the latest earlier one.

    The file date comes from the file name (``_metadata.file_path``); the
    pick is a ``max_by`` aggregate, so it never sorts the landing folder.
    """
    keys = keys or ["site_id"]
    df = read_json(spark, pattern, schema)
    file_day = F.try_to_date(F.nullif(F.regexp_extract("source_file", r"_(\d{8})\.json$", 1), F.lit("")), "yyyyMMdd")
    cand = df.withColumn("file_date", file_day).where(F.col("file_date") <= F.lit(as_of).cast("date"))
    payload = [c for c in cand.columns if c not in keys]
    return (cand.groupBy(*keys).agg(F.max_by(F.struct(*payload), F.col("file_date")).alias("r"))
            .select(*keys, "r.*"))

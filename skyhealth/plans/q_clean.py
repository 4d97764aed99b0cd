"""Step 2: cleaning."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from skyhealth.operators.clean import clean_pollution, clean_weather, typed_conversion
from skyhealth.plans.oracle import PD, WD, with_ctes
from skyhealth.plans.registry import ORACLES, register
from skyhealth.session import scratch_path
from skyhealth.sources.driver import pollution_raw, read_table, weather_raw
from skyhealth.sources import flat_files
from skyhealth.sources.tables import read_named_csv, read_pollution_csv, read_weather_csv, write_table

W_NONCRIT = ["pressure", "cloud_cover", "temp_max", "temp_min", "apparent_temp_max",
             "apparent_temp_min", "apparent_temp_mean", "humidity_max", "humidity_min",
             "wind_max", "wind_gust_max", "precipitation", "rain_sum"]
P_COLS = ["pm25", "pm10", "aqi", "european_aqi", "ozone", "nitrogen_dioxide", "sulphur_dioxide",
          "dust", "uv_index", "carbon_monoxide", "aerosol_optical_depth"]


def _nullif_rule(c, m):
    return f"CASE WHEN dayofyear(date) % {m} = 0 THEN NULL ELSE {c} END AS {c}"


W_RAW = """wraw0 AS (
  SELECT site_id, date, temperature, humidity, {wind}, {pressure}, {cloud}, temp_max, temp_min,
    apparent_temp_max, apparent_temp_min, apparent_temp_mean, humidity_max, humidity_min,
    wind_max, wind_gust_max, precipitation, rain_sum FROM wd),
wraw AS (SELECT * FROM wraw0 UNION ALL SELECT * FROM wraw0 WHERE dayofmonth(date) = 5)""".format(
    wind=_nullif_rule("wind", 31), pressure=_nullif_rule("pressure", 11),
    cloud=_nullif_rule("cloud_cover", 13))

W_CLEAN = """wdedup AS (SELECT DISTINCT * FROM wraw),
wkeep AS (SELECT * FROM wdedup WHERE date IS NOT NULL AND temperature IS NOT NULL
          AND humidity IS NOT NULL AND wind IS NOT NULL),
wmed AS (SELECT site_id, {meds} FROM wkeep GROUP BY site_id),
wclean AS (SELECT k.site_id, k.date, k.temperature, k.humidity, k.wind, {fills}
           FROM wkeep k JOIN wmed m ON k.site_id = m.site_id)""".format(
    meds=", ".join(f"median({c}) AS m_{c}" for c in W_NONCRIT),
    fills=", ".join(f"COALESCE(k.{c}, m.m_{c}) AS {c}" for c in W_NONCRIT))

P_RAW = """praw0 AS (
  SELECT site_id, CASE WHEN dayofyear(date) % 53 = 0 THEN NULL ELSE date END AS date,
    pm25, {pm10}, aqi, european_aqi, {ozone}, nitrogen_dioxide, sulphur_dioxide, {dust},
    uv_index, carbon_monoxide, aerosol_optical_depth, date AS orig_date FROM pd),
praw AS (SELECT * FROM praw0 UNION ALL SELECT * FROM praw0 WHERE dayofmonth(orig_date) = 5)""".format(
    pm10=_nullif_rule("pm10", 7), ozone=_nullif_rule("ozone", 7), dust=_nullif_rule("dust", 9))

P_CLEAN = """pdedup AS (SELECT DISTINCT * FROM praw),
pkeep AS (SELECT * EXCLUDE (orig_date) FROM pdedup WHERE date IS NOT NULL),
pmed AS (SELECT site_id, {meds} FROM pkeep GROUP BY site_id),
pclean AS (SELECT k.site_id, k.date, {fills} FROM pkeep k JOIN pmed m ON k.site_id = m.site_id)""".format(
    meds=", ".join(f"median({c}) AS m_{c}" for c in P_COLS),
    fills=", ".join(f"COALESCE(k.{c}, m.m_{c}) AS {c}" for c in P_COLS))

CLEAN_WEATHER_CHAIN = [WD, W_RAW, W_CLEAN]
CLEAN_POLLUTION_CHAIN = [PD, P_RAW, P_CLEAN]


def clean_weather_df(spark, sf_dir, fill=True):
    return clean_weather(weather_raw(spark, sf_dir), fill=fill)


def clean_pollution_df(spark, sf_dir, fill=True):
    return clean_pollution(pollution_raw(spark, sf_dir), fill=fill)


@register("clean_weather_median_fill", with_ctes(CLEAN_WEATHER_CHAIN, "SELECT * FROM wclean"))
def clean_weather_median_fill(spark, sf_dir):
    return clean_weather_df(spark, sf_dir)


@register("clean_weather_csv_sink", ORACLES["clean_weather_median_fill"])
def clean_weather_csv_sink(spark, sf_dir):
    """K1: cleaned rows overwrite a CSV, read back by header."""
    clean = clean_weather_df(spark, sf_dir)
    path = scratch_path(spark, f"clean-csv-{uuid.uuid4().hex[:12]}")
    write_table(clean, path, "csv", options={"header": "true"})
    return read_named_csv(spark, path, clean.schema)


@register("clean_weather_from_csv", ORACLES["clean_weather_median_fill"])
def clean_weather_from_csv(spark, sf_dir):
    """S1 → P1-P8 over a landed CSV whose columns come in another order."""
    raw = weather_raw(spark, sf_dir)
    path = scratch_path(spark, f"weather-csv-{uuid.uuid4().hex[:12]}")
    write_table(raw.select(*reversed(raw.columns)), path, "csv", options={"header": "true"})
    return clean_weather(read_weather_csv(spark, path).select(*raw.columns))


@register("clean_pollution_from_csv", with_ctes(CLEAN_POLLUTION_CHAIN, "SELECT * FROM pclean"))
def clean_pollution_from_csv(spark, sf_dir):
    """S2 → P1-P8 over a landed CSV whose columns come in another order."""
    raw = pollution_raw(spark, sf_dir)
    path = scratch_path(spark, f"pollution-csv-{uuid.uuid4().hex[:12]}")
    write_table(raw.select(*reversed(raw.columns)), path, "csv", options={"header": "true"})
    return clean_pollution(read_pollution_csv(spark, path).select(*raw.columns))


@register("clean_pollution_median_fill", with_ctes(CLEAN_POLLUTION_CHAIN, "SELECT * FROM pclean"))
def clean_pollution_median_fill(spark, sf_dir):
    return clean_pollution_df(spark, sf_dir)


def events_as_strings(spark, sf_dir):
    """All-string landed view of events (flat-file source, S15) with junk values."""
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_type"),
        F.when(F.col("event_id") % 17 == 0, F.lit("n/a"))
         .otherwise(F.col("value").cast("string")).alias("value"))


@register("typed_conversion_rejects", """
SELECT CAST(event_id AS BIGINT) AS event_id, 'value' AS column_name, 'n/a' AS raw_value
FROM events WHERE event_id % 17 = 0""")
def typed_conversion_rejects(spark, sf_dir):
    raw = events_as_strings(spark, sf_dir)
    _, rejects = typed_conversion(raw, {"event_id": "bigint", "user_id": "bigint",
                                        "value": "double"}, row_id="event_id")
    return rejects.select(F.col("event_id").cast("bigint").alias("event_id"),
                          "column_name", "raw_value")


ARABIC = {"click": "يوم آمن", "view": "خطر معتدل", "purchase": "كمامة", "signup": "غبار، شديد", "error": "تجنب"}
FRENCH = {"click": "journée sûre", "view": "modéré", "purchase": "masque", "signup": "poussière — forte", "error": "à éviter"}
PAGES = {"windows-1256": ARABIC, "windows-1252": FRENCH}
FLAT_TYPES = {"event_id": "bigint", "label": "string", "value": "double"}


def _label_sql():
    per = " ".join(f"WHEN event_id % 2 = {i} AND event_type = '{k}' THEN '{v}'"
                   for i, names in enumerate(PAGES.values()) for k, v in names.items())
    return f"CASE {per} END"


def landed_pages(spark, sf_dir):
    """Events landed as text files in two code pages, half in each: a value
    that is no number now and then, and records cut short."""
    e = read_table(spark, sf_dir, "events")
    found = None
    for i, (page, names) in enumerate(PAGES.items()):
        label = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in names.items()])
        value = F.when(F.col("event_id") % 17 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
        line = F.when(F.col("event_id") % 23 == 0, F.concat_ws(";", "event_id", label)).otherwise(
            F.concat_ws(";", "event_id", label, value))
        path = scratch_path(spark, f"flat-{uuid.uuid4().hex[:12]}")
        flat_files.write_lines(e.where(F.col("event_id") % 2 == i), line, "event_id;label;value", path, page)
        rows = flat_files.read_flat_file(spark, path, FLAT_TYPES, page, sep=";")
        found = rows if found is None else found.unionByName(rows)
    return found


@register("flat_file_rows", f"""
SELECT event_id, {_label_sql()} AS label, value FROM events WHERE event_id % 17 <> 0 AND event_id % 23 <> 0""")
def flat_file_rows(spark, sf_dir):
    """Typed rows of flat files in windows-1256 and windows-1252."""
    return flat_files.accepted(landed_pages(spark, sf_dir))


@register("flat_file_rejects", f"""
SELECT event_id, CASE WHEN event_id % 23 = 0 THEN '_record' ELSE 'value' END AS column_name,
  CASE WHEN event_id % 23 = 0 THEN CAST(event_id AS VARCHAR) || ';' || {_label_sql()} ELSE 'n/a' END AS raw_value
FROM events WHERE event_id % 17 = 0 OR event_id % 23 = 0""")
def flat_file_rejects(spark, sf_dir):
    """The cells that do not convert and the records that are cut short."""
    return flat_files.rejected(landed_pages(spark, sf_dir), "event_id")

"""Step 3: gaps and date sets (J3, J4, U1-U6, A19, W4, W5) and A4."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from skyhealth.operators import gaps
from skyhealth.plans.oracle import avg_dec, with_ctes
from skyhealth.plans.q_clean import (CLEAN_POLLUTION_CHAIN, CLEAN_WEATHER_CHAIN, P_COLS,
                                     clean_pollution_df, clean_weather_df)
from skyhealth.plans.registry import register
from skyhealth.session import scratch_path
from skyhealth.schemas import HOURLY_COLUMNAR_PAYLOAD
from skyhealth.sources.payloads import explode_hourly_columnar, read_json
from skyhealth.sources.driver import HOURLY_VALUE_COLUMNS, hourly_air_quality
from skyhealth.sources.tables import write_if_not_empty

CLEAN_BOTH = CLEAN_WEATHER_CHAIN + CLEAN_POLLUTION_CHAIN

RANGES = """rng AS (
  SELECT w.site_id, GREATEST(w_min, p_min) AS overlap_start, LEAST(w_max, p_max) AS overlap_end
  FROM (SELECT site_id, MIN(date) AS w_min, MAX(date) AS w_max FROM wclean GROUP BY site_id) w
  JOIN (SELECT site_id, MIN(date) AS p_min, MAX(date) AS p_max FROM pclean GROUP BY site_id) p
    ON w.site_id = p.site_id)"""

MISSING = RANGES + """,
expected AS (SELECT site_id, CAST(unnest(generate_series(overlap_start, overlap_end, INTERVAL 1 DAY)) AS DATE) AS date FROM rng),
missing AS (SELECT e.site_id, e.date FROM expected e
            WHERE NOT EXISTS (SELECT 1 FROM pclean p WHERE p.site_id = e.site_id AND p.date = e.date))"""

HOURLY = """hourly AS (
  SELECT CAST(l_orderkey % 4 AS INTEGER) AS site_id,
    CAST(l_shipdate + l_linenumber * INTERVAL 1 HOUR AS DATE) AS date,
    l_quantity * 2 + l_tax AS pm10, l_quantity + l_discount AS pm2_5,
    l_quantity * 10 AS carbon_monoxide, l_quantity + l_tax AS nitrogen_dioxide,
    l_tax * 100 AS sulphur_dioxide, l_quantity * 3 AS ozone,
    l_discount * 5 AS aerosol_optical_depth, l_quantity * 4 AS dust,
    CAST(l_linenumber AS DOUBLE) AS uv_index, l_quantity * 4 + l_discount AS us_aqi,
    l_quantity * 3 AS european_aqi
  FROM lineitem),
hdaily AS (
  SELECT site_id, date, {means} FROM hourly GROUP BY site_id, date)""".format(
    means=", ".join(f"{avg_dec(c)} AS {({'pm2_5': 'pm25', 'us_aqi': 'aqi'}).get(c, c)}"
                    for c in HOURLY_VALUE_COLUMNS))


def _fetched_daily(spark, sf_dir):
    return gaps.hourly_to_daily(hourly_air_quality(spark, sf_dir), HOURLY_VALUE_COLUMNS, scale=2)


def _dated(spark, sf_dir):
    """Both cleaned inputs for what needs their dates alone (no medians)."""
    return clean_weather_df(spark, sf_dir, fill=False), clean_pollution_df(spark, sf_dir, fill=False)


def _missing(spark, sf_dir):
    return gaps.missing_dates(*_dated(spark, sf_dir))


@register("missing_dates", with_ctes(CLEAN_BOTH + [MISSING], "SELECT site_id, date FROM missing"))
def missing_dates(spark, sf_dir):
    return _missing(spark, sf_dir)


@register("missing_date_list", with_ctes(CLEAN_BOTH + [MISSING], "SELECT site_id, date FROM missing"))
def missing_date_list(spark, sf_dir):
    """K3: the list is written where it has rows, and read back."""
    path = scratch_path(spark, f"missing-{uuid.uuid4().hex[:12]}")
    missing = _missing(spark, sf_dir)
    return spark.read.schema(missing.schema).parquet(path) if write_if_not_empty(missing, path, "parquet") else missing.limit(0)


@register("common_dates", with_ctes(CLEAN_BOTH, """
SELECT DISTINCT w.site_id, w.date FROM wclean w JOIN pclean p ON w.site_id = p.site_id AND w.date = p.date"""))
def common_dates(spark, sf_dir):
    return gaps.common_dates(*_dated(spark, sf_dir))


@register("date_overlap_stats", with_ctes(CLEAN_BOTH + [RANGES], """
SELECT w.site_id,
  w.n AS weather_dates, w.mn AS weather_min, w.mx AS weather_max,
  p.n AS pollution_dates, p.mn AS pollution_min, p.mx AS pollution_max,
  (SELECT COUNT(*) FROM (SELECT DISTINCT a.date FROM wclean a JOIN pclean b
     ON a.site_id = b.site_id AND a.date = b.date WHERE a.site_id = w.site_id) c) AS common_dates,
  r.overlap_start, r.overlap_end,
  GREATEST(CAST(r.overlap_end - r.overlap_start AS BIGINT) + 1, 0) AS expected_days,
  GREATEST(CAST(r.overlap_end - r.overlap_start AS BIGINT) + 1, 0)
    - (SELECT COUNT(DISTINCT date) FROM pclean q WHERE q.site_id = w.site_id
         AND q.date BETWEEN r.overlap_start AND r.overlap_end) AS missing_days
FROM (SELECT site_id, COUNT(DISTINCT date) AS n, MIN(date) AS mn, MAX(date) AS mx FROM wclean GROUP BY site_id) w
JOIN (SELECT site_id, COUNT(DISTINCT date) AS n, MIN(date) AS mn, MAX(date) AS mx FROM pclean GROUP BY site_id) p
  ON w.site_id = p.site_id
JOIN rng r ON r.site_id = w.site_id"""))
def date_overlap_stats(spark, sf_dir):
    return gaps.overlap_stats(*_dated(spark, sf_dir))


@register("gap_fetch_chunks", with_ctes(CLEAN_BOTH + [MISSING], """
SELECT site_id, chunk, MIN(date) AS start_date, MAX(date) AS end_date, COUNT(*) AS n_days
FROM (SELECT site_id, date,
        CAST(FLOOR((ROW_NUMBER() OVER (PARTITION BY site_id ORDER BY date) - 1) / 30) AS INTEGER) AS chunk
      FROM missing) t
GROUP BY site_id, chunk"""))
def gap_fetch_chunks(spark, sf_dir):
    return gaps.chunk_dates(_missing(spark, sf_dir))


@register("hourly_daily_mean", with_ctes([HOURLY], "SELECT * FROM hdaily"))
def hourly_daily_mean(spark, sf_dir):
    return _fetched_daily(spark, sf_dir)


@register("hourly_columnar_mean", with_ctes([HOURLY], "SELECT * FROM hdaily"))
def hourly_columnar_mean(spark, sf_dir):
    """Landed documents of a site's hours (500 at most) as parallel arrays
    under ``hourly``; read as JSON files, zipped into rows and averaged."""
    rows = hourly_air_quality(spark, sf_dir)
    batch = F.floor(F.monotonically_increasing_id() / 500)
    docs = rows.withColumn("batch_seq", batch).groupBy("site_id", "batch_seq").agg(
        F.collect_list(F.struct("time", *HOURLY_VALUE_COLUMNS)).alias("h"))
    hourly = F.struct(*[F.col(f"h.{c}").alias(c) for c in ["time", *HOURLY_VALUE_COLUMNS]])
    path = scratch_path(spark, f"hourly-json-{uuid.uuid4().hex[:12]}")
    docs.select("site_id", "batch_seq", hourly.alias("hourly")).write.json(path)
    landed = read_json(spark, path, HOURLY_COLUMNAR_PAYLOAD, multiline=False)
    return gaps.hourly_to_daily(explode_hourly_columnar(landed), HOURLY_VALUE_COLUMNS, scale=2)


GAP_FILL = """fetched AS (
  SELECT h.* FROM hdaily h WHERE EXISTS (SELECT 1 FROM missing m WHERE m.site_id = h.site_id AND m.date = h.date)),
comb AS (
  SELECT site_id, date, {cols}, 0 AS batch FROM pclean
  UNION ALL SELECT site_id, date, {cols}, 1 AS batch FROM fetched),
merged AS (
  SELECT * EXCLUDE (rn, batch) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY site_id, date ORDER BY batch DESC) AS rn FROM comb) t
  WHERE rn = 1),
gmed AS (SELECT site_id, {meds} FROM merged GROUP BY site_id),
gapfilled AS (SELECT k.site_id, k.date, {fills} FROM merged k JOIN gmed m ON k.site_id = m.site_id)""".format(
    cols=", ".join(P_COLS),
    meds=", ".join(f"median({c}) AS m_{c}" for c in P_COLS),
    fills=", ".join(f"COALESCE(k.{c}, m.m_{c}) AS {c}" for c in P_COLS))


@register("gap_fill_merge", with_ctes(CLEAN_BOTH + [MISSING, HOURLY, GAP_FILL],
                                      "SELECT * FROM gapfilled"))
def gap_fill_merge(spark, sf_dir):
    return gaps.gap_fill_merge(clean_pollution_df(spark, sf_dir), _fetched_daily(spark, sf_dir), _missing(spark, sf_dir))


@register("gap_still_missing", with_ctes(CLEAN_BOTH + [MISSING, HOURLY], """
SELECT m.site_id, m.date FROM missing m
WHERE NOT EXISTS (SELECT 1 FROM hdaily h WHERE h.site_id = m.site_id AND h.date = m.date)"""))
def gap_still_missing(spark, sf_dir):
    return gaps.still_missing(_missing(spark, sf_dir), _fetched_daily(spark, sf_dir))


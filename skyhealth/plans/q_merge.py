"""Step 7: table maintenance."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from skyhealth.operators import merge as M
from skyhealth.plans.daily import gold_features
from skyhealth.plans.oracle import GOLD_CHAIN, GOLD_COLS, JOINED, live_case, with_ctes
from skyhealth.plans.q_rules import LIVE_SQL, live_rows
from skyhealth.plans import jobs
from skyhealth.plans.registry import ORACLES, register
from skyhealth.session import cut_lineage, scratch_path
from skyhealth.sources.tables import drop_versions, publish, write_table
from skyhealth.schemas import GOLD_COLUMNS, POLLUTION_COLUMNS, WEATHER_COLUMNS
from skyhealth.sources.driver import forecast_log

LIVE_GOLD = """live_gold AS (
  SELECT site_id, date, temperature, humidity, wind, pressure, cloud_cover,
    CAST(NULL AS DOUBLE) AS sunshine_duration, temp_max, temp_min, apparent_temp_max,
    apparent_temp_min, apparent_temp_mean, humidity_max, humidity_min, wind_max, wind_gust_max,
    precipitation, CAST(NULL AS DOUBLE) AS rain_sum, CAST(NULL AS DOUBLE) AS dew_point,
    CAST(NULL AS DOUBLE) AS shortwave_radiation, CAST(NULL AS DOUBLE) AS vapour_pressure_deficit,
    pm25, pm10, aqi, CAST(NULL AS DOUBLE) AS european_aqi, ozone, nitrogen_dioxide, sulphur_dioxide,
    CAST(NULL AS DOUBLE) AS dust, CAST(NULL AS DOUBLE) AS uv_index,
    CAST(NULL AS DOUBLE) AS carbon_monoxide, CAST(NULL AS DOUBLE) AS aerosol_optical_depth,
    heat_index, pollution_level, respiratory_stress, uv_risk, temp_range, heat_stress_peak,
    dust_risk_index, rain_wash_effect, {cat} AS health_category, source
  FROM live)""".format(cat=live_case())

MERGE_CHAIN = GOLD_CHAIN + [LIVE_SQL, LIVE_GOLD]

FLOG = """flog AS (
  SELECT CAST(ts AS DATE) AS forecast_date, CAST(user_id % 3 + 1 AS INTEGER) AS forecast_horizon,
    ts AS generated_at, event_id, 'v2.1' AS model_version, cat AS predicted_category,
    value / 500 AS confidence,
    CASE WHEN cat = 'Safe Air Day' THEN value / 500 ELSE (1.0 - value / 500) / 4 END AS prob_safe,
    CASE WHEN cat = 'Moderate Risk Day' THEN value / 500 ELSE (1.0 - value / 500) / 4 END AS prob_moderate,
    CASE WHEN cat = 'High Respiratory Risk Day' THEN value / 500 ELSE (1.0 - value / 500) / 4 END AS prob_high_resp,
    CASE WHEN cat = 'Mask Recommended Day' THEN value / 500 ELSE (1.0 - value / 500) / 4 END AS prob_mask,
    CASE WHEN cat = 'Avoid Outdoor Activity Day' THEN value / 500 ELSE (1.0 - value / 500) / 4 END AS prob_avoid,
    k / 4 + 10 AS temperature, k AS humidity, k / 2 AS wind, value / 10 AS pm25, value / 2 AS aqi,
    k / 4 + 10 + k * 0.33 - k / 2 * 0.70 AS heat_index,
    value / 10 * 0.5 + value / 2 * 0.2 AS pollution_level, value / 10 * 0.4 AS respiratory_stress,
    k % 9 AS temp_range, k / 4 + 12 AS heat_stress_peak, k / 2 * (1 - k / 100) AS dust_risk_index,
    k % 5 AS rain_wash_effect
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
          CASE event_type WHEN 'click' THEN 'Safe Air Day' WHEN 'view' THEN 'Moderate Risk Day'
            WHEN 'purchase' THEN 'High Respiratory Risk Day' WHEN 'signup' THEN 'Mask Recommended Day'
            WHEN 'error' THEN 'Avoid Outdoor Activity Day' END AS cat
        FROM events) e)"""

FLOG_ORDER = ["generated_at", "event_id"]
FKEYS = ["forecast_date", "forecast_horizon"]


def _hist_and_live(spark, sf_dir):
    return gold_features(spark, sf_dir), live_rows(spark, sf_dir)


@register("partial_refresh", with_ctes(MERGE_CHAIN, f"""
SELECT {GOLD_COLS} FROM (
  SELECT * FROM (
    SELECT {GOLD_COLS} FROM gold WHERE month(date) <= 6
    UNION ALL SELECT * EXCLUDE (source), 'csv' AS source FROM gold WHERE month(date) BETWEEN 7 AND 9
    UNION ALL SELECT * FROM live_gold) cur
  WHERE source = 'api_daily'
  UNION ALL SELECT {GOLD_COLS} FROM gold) t"""))
def partial_refresh(spark, sf_dir):
    hist, live = _hist_and_live(spark, sf_dir)
    m = F.month("date")
    current = (hist.where(m <= 6)
               .unionByName(hist.where(m.between(7, 9)).withColumn("source", F.lit("csv")))
               .unionByName(live, allowMissingColumns=True))
    return M.partial_refresh(current, hist).select(*GOLD_COLUMNS)


@register("insert_if_absent", with_ctes(MERGE_CHAIN, f"""
SELECT {GOLD_COLS} FROM gold UNION ALL SELECT {GOLD_COLS} FROM live_gold"""))
def insert_if_absent(spark, sf_dir):
    hist, live = _hist_and_live(spark, sf_dir)
    target = hist.unionByName(live.where(F.month("date") <= 6), allowMissingColumns=True)
    return M.insert_if_absent(target, live, ["site_id", "date", "source"]).select(*GOLD_COLUMNS)


@register("partitioned_refresh", ORACLES["partial_refresh"])
def partitioned_refresh(spark, sf_dir):
    """K4 over a stored table by source and month: historical partitions are
    overwritten or dropped, live ones keep their files."""
    hist, live = _hist_and_live(spark, sf_dir)
    m = F.month("date")
    old = hist.where(m <= 6).unionByName(hist.where(m.between(7, 9)).withColumn("source", F.lit("csv")))
    old = old.unionByName(live, allowMissingColumns=True).select(*GOLD_COLUMNS)
    path = scratch_path(spark, f"gold-{uuid.uuid4().hex[:12]}")
    write_table(jobs.laid_out(old, live=True), path, partition_by=jobs.GOLD_LAYOUT)
    jobs.refresh_historical(hist, path)
    return spark.read.parquet(path).select(*GOLD_COLUMNS)


@register("partitioned_append", ORACLES["insert_if_absent"])
def partitioned_append(spark, sf_dir):
    """K5/J5 over a stored table, run twice: the anti-join and the write touch
    only the sources and months of the new rows."""
    hist, live = _hist_and_live(spark, sf_dir)
    old = hist.unionByName(live.where(F.month("date") <= 6), allowMissingColumns=True).select(*GOLD_COLUMNS)
    path = scratch_path(spark, f"gold-{uuid.uuid4().hex[:12]}")
    write_table(jobs.laid_out(old, live=True), path, partition_by=jobs.GOLD_LAYOUT)
    rows = cut_lineage(jobs.laid_out(hist.limit(0).unionByName(live, allowMissingColumns=True).select(*GOLD_COLUMNS), live=True))
    for _ in range(2):
        jobs.append_new(spark, rows, path, ["site_id", "date", "source"], jobs.GOLD_LAYOUT)
    return spark.read.parquet(path).select(*GOLD_COLUMNS)


LATEST_AB = """fa AS (SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (
        PARTITION BY forecast_date, forecast_horizon ORDER BY generated_at DESC, event_id DESC) AS rn
      FROM flog WHERE hour(generated_at) < 12) t WHERE rn = 1),
fb AS (SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (
        PARTITION BY forecast_date, forecast_horizon ORDER BY generated_at DESC, event_id DESC) AS rn
      FROM flog WHERE hour(generated_at) >= 12) t WHERE rn = 1)"""


@register("forecast_upsert", with_ctes([FLOG, LATEST_AB], """
SELECT * FROM fb UNION ALL
SELECT * FROM fa WHERE NOT EXISTS (SELECT 1 FROM fb WHERE fb.forecast_date = fa.forecast_date
  AND fb.forecast_horizon = fa.forecast_horizon)"""))
def forecast_upsert(spark, sf_dir):
    log = forecast_log(spark, sf_dir)
    h = F.hour("generated_at")
    target = M.latest_per_key(log.where(h < 12), FKEYS, FLOG_ORDER)
    updates = M.latest_per_key(log.where(h >= 12), FKEYS, FLOG_ORDER)
    return M.upsert(target, updates, FKEYS).select(*log.columns)


@register("forecast_upsert_partial", with_ctes([FLOG, LATEST_AB], """
SELECT fb.* EXCLUDE (model_version), fa.model_version FROM fb LEFT JOIN fa
  ON fb.forecast_date = fa.forecast_date AND fb.forecast_horizon = fa.forecast_horizon
UNION ALL
SELECT fa.* EXCLUDE (model_version), fa.model_version FROM fa WHERE NOT EXISTS (SELECT 1 FROM fb
  WHERE fb.forecast_date = fa.forecast_date AND fb.forecast_horizon = fa.forecast_horizon)"""))
def forecast_upsert_partial(spark, sf_dir):
    """K6 with an update that lacks a column: matched rows keep the target's."""
    log = forecast_log(spark, sf_dir)
    h = F.hour("generated_at")
    target = M.latest_per_key(log.where(h < 12), FKEYS, FLOG_ORDER)
    updates = M.latest_per_key(log.where(h >= 12), FKEYS, FLOG_ORDER).drop("model_version")
    return M.upsert(target, updates, FKEYS).select(*log.columns)


@register("rows_needing_prediction", with_ctes(GOLD_CHAIN, f"""
SELECT {GOLD_COLS} FROM gold g WHERE g.date IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM gold p WHERE p.date <= DATE '1998-06-30' AND p.site_id = g.site_id AND p.date = g.date)"""))
def rows_needing_prediction(spark, sf_dir):
    hist = gold_features(spark, sf_dir)
    predicted = hist.where(F.col("date") <= F.lit("1998-06-30").cast("date")) \
        .select("site_id", "date", "health_category")
    return M.rows_to_insert(hist.where(F.col("date").isNotNull()), predicted, ["site_id", "date"])


@register("table_copy", with_ctes(GOLD_CHAIN, f"SELECT {GOLD_COLS} FROM gold"))
def table_copy(spark, sf_dir):
    src = gold_features(spark, sf_dir).withColumns({
        "id": F.xxhash64("site_id", "date"),
        "date_id": F.date_format("date", "yyyyMMdd").cast("int")})
    path = scratch_path(spark, f"table-copy-{uuid.uuid4().hex[:12]}")
    write_table(M.copy_table(src), path)
    return spark.read.parquet(path).select(*GOLD_COLUMNS)


@register("published_table", ORACLES["partial_refresh"])
def published_table(spark, sf_dir):
    """K7, K8: the feature table is published twice, the second time from its
    own first version; readers go by the catalog's name."""
    hist, live = _hist_and_live(spark, sf_dir)
    name = f"features_{uuid.uuid4().hex[:12]}"
    root = scratch_path(spark, name)
    first = hist.where(F.month("date") <= 6).unionByName(live, allowMissingColumns=True).select(*GOLD_COLUMNS)
    publish(spark, first, name, root)
    kept = publish(spark, M.partial_refresh(spark.table(name), hist).select(*GOLD_COLUMNS), name, root)
    drop_versions(spark, root, [kept])
    return spark.table(name)


@register("delete_by_predicate", with_ctes(MERGE_CHAIN, f"""
SELECT {GOLD_COLS} FROM (SELECT {GOLD_COLS} FROM gold UNION ALL SELECT {GOLD_COLS} FROM live_gold) t
WHERE NOT COALESCE(source = 'api_daily' AND date >= DATE '1998-01-01', FALSE)"""))
def delete_by_predicate(spark, sf_dir):
    hist, live = _hist_and_live(spark, sf_dir)
    table = hist.unionByName(live, allowMissingColumns=True)
    pred = M.is_live() & (F.col("date") >= F.lit("1998-01-01").cast("date"))
    return M.delete_where(table, pred).select(*GOLD_COLUMNS)


@register("source_priority", with_ctes(MERGE_CHAIN, """
SELECT site_id, date, source, health_category, aqi, pm25 FROM live_gold
UNION ALL
SELECT site_id, date, source, health_category, aqi, pm25 FROM gold g
WHERE NOT EXISTS (SELECT 1 FROM live_gold l WHERE l.site_id = g.site_id AND l.date = g.date)"""))
def source_priority(spark, sf_dir):
    hist, live = _hist_and_live(spark, sf_dir)
    return M.prefer_source(hist, live, ["site_id", "date"]).select(
        "site_id", "date", "source", "health_category", "aqi", "pm25")


SILVER_W = ["site_id", "date"] + WEATHER_COLUMNS + ["heat_index", "source"]
SILVER_P = ["site_id", "date"] + POLLUTION_COLUMNS + ["pollution_level", "source"]


def _silver_new(spark, sf_dir, cols):
    hist = gold_features(spark, sf_dir)
    existing = hist.where(F.col("date") < F.lit("1997-01-01").cast("date")).select(*cols)
    return M.rows_to_insert(hist.select(*cols), existing, ["site_id", "date"])


@register("silver_split_weather", with_ctes(GOLD_CHAIN, f"""
SELECT {', '.join(SILVER_W)} FROM gold g WHERE NOT EXISTS (
  SELECT 1 FROM gold e WHERE e.date < DATE '1997-01-01' AND e.site_id = g.site_id AND e.date = g.date)"""))
def silver_split_weather(spark, sf_dir):
    return _silver_new(spark, sf_dir, SILVER_W)


@register("silver_split_pollution", with_ctes(GOLD_CHAIN, f"""
SELECT {', '.join(SILVER_P)} FROM gold g WHERE NOT EXISTS (
  SELECT 1 FROM gold e WHERE e.date < DATE '1997-01-01' AND e.site_id = g.site_id AND e.date = g.date)"""))
def silver_split_pollution(spark, sf_dir):
    return _silver_new(spark, sf_dir, SILVER_P)


__all__ = ["JOINED"]

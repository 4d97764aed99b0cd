"""Step 11: quality checks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from skyhealth.functions.rules import category_expr
from skyhealth.operators import quality as Q
from skyhealth.operators.merge import copy_table
from skyhealth.plans.daily import gold_features
from skyhealth.plans.oracle import GOLD_CHAIN, GOLD_COLS, v1_case, with_ctes
from skyhealth.plans.q_clean import CLEAN_WEATHER_CHAIN
from skyhealth.plans.q_merge import LIVE_GOLD
from skyhealth.plans.q_rules import LIVE_SQL, live_rows
from skyhealth.plans.registry import register
from skyhealth.session import scratch_path
from skyhealth.sources.tables import write_table
from skyhealth.schemas import WEATHER_COLUMNS, WEATHER_RENAMES
from skyhealth.sources.driver import weather_raw

LABELS = f"""labels AS (SELECT site_id, date, health_category AS rule_label,
  {v1_case()} AS model_label FROM (
    SELECT *, temperature + 0.33 * humidity - 0.70 * wind AS hi1 FROM gold) g0)"""
# v1 labels use the v1 heat index (no zero fill) in place of the gold one.
LABELS = LABELS.replace("COALESCE(NULLIF(heat_index, 0), 0)", "COALESCE(NULLIF(hi1, 0), 0)")


def _labels(spark, sf_dir):
    g = gold_features(spark, sf_dir)
    v1 = g.withColumn("heat_index", F.col("temperature") + F.lit(0.33) * F.col("humidity")
                      - F.lit(0.70) * F.col("wind"))
    return v1.select("site_id", "date", F.col("health_category").alias("rule_label"),
                     category_expr(v1, "v1").alias("model_label"))


@register("confusion_matrix", with_ctes(GOLD_CHAIN + [LABELS], """
SELECT rule_label, model_label, COUNT(*) AS days FROM labels GROUP BY 1, 2"""))
def confusion_matrix(spark, sf_dir):
    return Q.confusion(_labels(spark, sf_dir), "rule_label", "model_label")


@register("label_agreement", with_ctes(GOLD_CHAIN + [LABELS], """
SELECT COUNT(*) AS days, COUNT(*) FILTER (WHERE rule_label = model_label) AS agree_days,
  round_even(round_even(COUNT(*) FILTER (WHERE rule_label = model_label) / COUNT(*) * 100, 10), 4) AS agreement_pct
FROM labels"""))
def label_agreement(spark, sf_dir):
    return Q.agreement(_labels(spark, sf_dir), "rule_label", "model_label")


def _r(x):
    return f"round_even(round_even({x}, 10), 6)"


REPORT = f"""conf AS (SELECT rule_label, model_label, COUNT(*) AS days FROM labels GROUP BY 1, 2),
t AS (SELECT rule_label AS label, SUM(days) AS support,
        SUM(CASE WHEN rule_label = model_label THEN days ELSE 0 END) AS tp FROM conf GROUP BY 1),
p AS (SELECT model_label AS label, SUM(days) AS predicted FROM conf GROUP BY 1),
per0 AS (SELECT COALESCE(t.label, p.label) AS label, COALESCE(support, 0) AS support,
           COALESCE(tp, 0) AS tp, COALESCE(predicted, 0) AS predicted
         FROM t FULL OUTER JOIN p ON t.label = p.label),
per1 AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS prec,
           CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rec FROM per0),
per AS (SELECT *, CASE WHEN prec + rec > 0 THEN 2.0 * prec * rec / (prec + rec) ELSE 0.0 END AS f1 FROM per1),
tot AS (SELECT SUM(support) AS n, SUM(tp) AS tp, COUNT(*) AS k, SUM(prec) AS sp, SUM(rec) AS sr,
          SUM(f1) AS sf, SUM(prec * support) AS wp, SUM(rec * support) AS wr, SUM(f1 * support) AS wf FROM per)"""


@register("classification_report", with_ctes(GOLD_CHAIN + [LABELS, REPORT], f"""
SELECT label, {_r('prec')} AS precision, {_r('rec')} AS recall, {_r('f1')} AS f1_score,
  CAST(support AS BIGINT) AS support FROM per
UNION ALL SELECT 'accuracy', NULL, NULL, {_r('tp / n')}, CAST(n AS BIGINT) FROM tot
UNION ALL SELECT 'macro avg', {_r('sp / k')}, {_r('sr / k')}, {_r('sf / k')}, CAST(n AS BIGINT) FROM tot
UNION ALL SELECT 'weighted avg', {_r('wp / n')}, {_r('wr / n')}, {_r('wf / n')}, CAST(n AS BIGINT) FROM tot"""))
def classification_report(spark, sf_dir):
    conf = Q.confusion(_labels(spark, sf_dir), "rule_label", "model_label")
    return Q.classification_report(conf)


@register("duplicate_keys", with_ctes(GOLD_CHAIN + [LIVE_SQL, LIVE_GOLD], """
SELECT site_id, date, COUNT(*) AS n FROM (
  SELECT site_id, date FROM gold UNION ALL SELECT site_id, date FROM live_gold) t
GROUP BY site_id, date HAVING COUNT(*) > 1"""))
def duplicate_keys(spark, sf_dir):
    """A12 on the feature table after live rows were appended (T9 fan-out)."""
    table = gold_features(spark, sf_dir).unionByName(live_rows(spark, sf_dir),
                                                      allowMissingColumns=True)
    return Q.duplicate_keys(table, ["site_id", "date"])


@register("row_count_match", with_ctes(GOLD_CHAIN + [LIVE_SQL, LIVE_GOLD], """
SELECT table_name, source_rows, target_rows, source_rows = target_rows AS match FROM (
  SELECT 'environmental_features' AS table_name, (SELECT COUNT(*) FROM gold) AS source_rows,
    (SELECT COUNT(*) FROM (SELECT DISTINCT site_id, date FROM gold)) AS target_rows
  UNION ALL SELECT 'live_rows', (SELECT COUNT(*) FROM live_gold),
    (SELECT COUNT(*) FROM (SELECT DISTINCT site_id, date FROM live_gold)))"""))
def row_count_match(spark, sf_dir):
    """Each table is copied (written), read back and compared by rows and content."""
    pairs = {}
    for name, table in (("environmental_features", gold_features(spark, sf_dir)), ("live_rows", live_rows(spark, sf_dir))):
        path = scratch_path(spark, f"copy-{name}-{uuid.uuid4().hex[:12]}")
        write_table(copy_table(table), path)
        pairs[name] = (table, spark.read.parquet(path))
    return Q.row_count_match(pairs, checksum=True).select("table_name", "source_rows", "target_rows", "match")


def _nulls_sql(table):
    return f"(SELECT CAST(SUM(len(list_filter([{', '.join(f'CAST({c.strip()} AS VARCHAR)' for c in GOLD_COLS.split(','))}], lambda x: x IS NULL))) AS BIGINT) FROM {table})"


@register("observed_copies", with_ctes(GOLD_CHAIN + [LIVE_SQL, LIVE_GOLD], f"""
SELECT *, TRUE AS match FROM (
  SELECT 'environmental_features' AS table_name, (SELECT COUNT(*) FROM gold) AS source_rows, (SELECT COUNT(*) FROM gold) AS target_rows,
    {_nulls_sql('gold')} AS source_nulls, {_nulls_sql('gold')} AS target_nulls
  UNION ALL SELECT 'live_rows', (SELECT COUNT(*) FROM live_gold), (SELECT COUNT(*) FROM live_gold),
    {_nulls_sql('live_gold')}, {_nulls_sql('live_gold')})"""))
def observed_copies(spark, sf_dir):
    """Each table is measured by the write that copies it, and the
    copy against that."""
    gold = gold_features(spark, sf_dir)
    live = gold.limit(0).unionByName(live_rows(spark, sf_dir), allowMissingColumns=True).select(*gold.columns)
    copies = {}
    for name, table in (("environmental_features", gold), ("live_rows", live)):
        path = scratch_path(spark, f"observed-{name}-{uuid.uuid4().hex[:12]}")
        copies[name] = (Q.observed_copy(table, path), spark.read.parquet(path))
    return Q.copies_match(spark, copies)


PROFILE_COLS = ["temperature", "humidity", "wind", "pressure", "cloud_cover", "temp_max",
                "temp_min", "humidity_min", "wind_max", "precipitation"]


@register("profile_numeric", with_ctes(CLEAN_WEATHER_CHAIN, """
SELECT site_id, column_name, COUNT(value) AS count, COUNT(*) FILTER (WHERE value IS NULL) AS null_count,
  round_even(round_even(AVG(value), 10), 6) AS mean,
  round_even(round_even(STDDEV_SAMP(value), 10), 6) AS std, MIN(value) AS min,
  round_even(round_even(quantile_cont(value, 0.25), 10), 6) AS q25,
  round_even(round_even(quantile_cont(value, 0.5), 10), 6) AS q50,
  round_even(round_even(quantile_cont(value, 0.75), 10), 6) AS q75, MAX(value) AS max
FROM (SELECT site_id, unnest([{names}]) AS column_name, unnest([{cols}]) AS value FROM wraw) u
GROUP BY site_id, column_name""".replace("{cols}", ", ".join(PROFILE_COLS))
    .replace("{names}", ", ".join(f"'{c}'" for c in PROFILE_COLS))))
def profile_numeric(spark, sf_dir):
    """A18 on the raw (dirty, renamed) weather file."""
    raw = weather_raw(spark, sf_dir)
    raw = raw.withColumnsRenamed({k: v for k, v in WEATHER_RENAMES.items() if k in raw.columns})
    return Q.profile(raw, [c for c in PROFILE_COLS if c in WEATHER_COLUMNS])


@register("rule_model_matrix", with_ctes(GOLD_CHAIN + [LIVE_SQL, LIVE_GOLD, LABELS], """
SELECT ef.health_category AS rule_label, rp.model_label, COUNT(*) AS days
FROM (SELECT site_id, date, health_category FROM gold
      UNION ALL SELECT site_id, date, health_category FROM live_gold) ef
JOIN labels rp ON rp.site_id = ef.site_id AND rp.date = ef.date
GROUP BY 1, 2"""))
def rule_model_matrix(spark, sf_dir):
    """J8 + A9: feature table (historical and live rows) joined to the
    prediction table on (site, date); a date holding both a historical and a
    live row fans out, as in the warehouse check (T9)."""
    ef = gold_features(spark, sf_dir).unionByName(live_rows(spark, sf_dir),
                                                   allowMissingColumns=True)
    rp = _labels(spark, sf_dir).select("site_id", "date", "model_label")
    j = ef.select("site_id", "date", "health_category").join(rp, ["site_id", "date"], "inner")
    return Q.confusion(j, "health_category", "model_label")

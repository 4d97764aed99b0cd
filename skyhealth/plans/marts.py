"""Reporting marts.

Dashboard questions as aggregates. Per-site/per-window scalars (max date,
totals) are joined as tiny aggregates, never through the driver.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyhealth.functions.aqi import severity
from skyhealth.functions.columns import round_half_away, round_half_even, stable_round
from skyhealth.functions.constants import (CATEGORIES, NO_FORECAST, NO_SAFE_DAY, SAFE,
                                           SAFE_SHARE_WARNING_PCT)


def category_dim(spark) -> DataFrame:
    """The five-row category dimension (fixed domain)."""
    return spark.createDataFrame([(c, i) for i, c in enumerate(CATEGORIES)],
                                 "health_category string, category_order int")


def category_distribution(df: DataFrame, keys: Sequence[str] = ("site_id",),
                          col: str = "health_category") -> DataFrame:
    """Count and share (1 dp) of every category per key, zero-count
    categories included; flags keys whose Safe share exceeds 15 %."""
    keys = list(keys)
    counts = df.groupBy(*keys, col).agg(F.count(F.lit(1)).alias("days"))
    # Every key gets all five categories: explode the fixed domain per key
    # (no cross join).
    domain_arr = F.explode(F.array(*[F.lit(c) for c in CATEGORIES])).alias(col)
    domain = (counts.select(*keys).distinct().select(*keys, domain_arr) if keys
              else df.sparkSession.range(1).select(domain_arr))
    full = domain.join(counts, keys + [col], "left").fillna(0, subset=["days"])
    tot = Window.partitionBy(*keys) if keys else Window.partitionBy()
    full = full.withColumn("total", F.sum("days").over(tot))
    full = full.withColumn("pct", round_half_even(F.col("days") / F.col("total") * 100, 1))
    safe_pct = F.max(F.when(F.col(col) == SAFE, F.col("days") / F.col("total") * 100)).over(tot)
    return full.withColumn("safe_share_warning", safe_pct > SAFE_SHARE_WARNING_PCT).drop("total")


def range_kpis(df: DataFrame, start: str, end: str, keys: Sequence[str] = ("site_id",)) -> DataFrame:
    """P11 + A7: inclusive date range filter (pushed to the scan) and KPIs."""
    r = df.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    r6 = lambda c: stable_round(c, 6)
    return r.groupBy(*keys).agg(
        r6(F.avg("aqi")).alias("avg_aqi"), F.max("aqi").alias("max_aqi"),
        r6(F.avg("pm25")).alias("avg_pm25"), F.max("pm25").alias("max_pm25"),
        r6(F.avg("temperature")).alias("avg_temperature"),
        F.max("temperature").alias("max_temperature"),
        r6(F.avg("humidity")).alias("avg_humidity"),
        F.count(F.lit(1)).alias("records"))


def coverage(tables: dict[str, DataFrame], date_col: dict[str, str] | None = None) -> DataFrame:
    """MIN(date), MAX(date), COUNT(*) per table, stacked."""
    out = None
    for name, t in tables.items():
        d = (date_col or {}).get(name, "date")
        row = t.agg(F.min(d).alias("min_date"), F.max(d).alias("max_date"),
                    F.count(F.lit(1)).alias("row_count")).withColumn("table_name", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out.select("table_name", "min_date", "max_date", "row_count")


def month_bucket(d: Column) -> Column:
    """``YYYY-MM``."""
    return F.date_format(d, "yyyy-MM")


def monthly_avg(df: DataFrame, keys: Sequence[str] = ("site_id",)) -> DataFrame:
    """A10: monthly mean AQI and PM2.5."""
    return df.groupBy(*keys, month_bucket(F.col("date")).alias("month")).agg(
        stable_round(F.avg("aqi"), 6).alias("avg_aqi"),
        stable_round(F.avg("pm25"), 6).alias("avg_pm25"))


def monthly_category_days(df: DataFrame, keys: Sequence[str] = ("site_id",)) -> DataFrame:
    """Days per month and category (stacked-bar data)."""
    return df.groupBy(*keys, month_bucket(F.col("date")).alias("month"), "health_category") \
        .agg(F.count(F.lit(1)).alias("days"))


def by_horizon(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Conditional averages per horizon (CALCULATE(..., horizon = k))."""
    h = F.col("forecast_horizon")
    aggs = []
    for k in (1, 2, 3):
        aggs.append(stable_round(F.avg(F.when(h == k, F.col("aqi"))), 6).alias(f"avg_aqi_d{k}"))
    aggs += [stable_round(F.avg(F.when(h == 1, F.col("confidence"))), 6).alias("avg_confidence_d1"),
             round_half_away(stable_round(F.avg(F.when(h == 1, F.col("pm25"))), 10), 1).alias("pm25_d1"),
             round_half_away(stable_round(F.avg(F.when(h == 1, F.col("heat_index"))), 10), 1).alias("heat_index_d1")]
    return df.groupBy(*keys).agg(*aggs)


def selected_category(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SELECTEDVALUE(category) per horizon: the value when exactly one
    distinct category is in context, else "No forecast available"."""
    h, cat = F.col("forecast_horizon"), F.col("predicted_category")
    aggs = []
    for k, name in ((1, "tomorrow_category"), (2, "day2_category"), (3, "day3_category")):
        only = F.count_distinct(F.when(h == k, cat)) == 1
        aggs.append(F.coalesce(F.when(only, F.max(F.when(h == k, cat))), F.lit(NO_FORECAST))
                    .alias(name))
    return df.groupBy(*keys).agg(*aggs)


def worst_category(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lowest severity over the categories in context (1 = worst)."""
    return df.groupBy(*keys).agg(F.min(severity(F.col("predicted_category"))).alias("worst_severity"))


def days_until_safe(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First horizon with a Safe forecast, as text."""
    first = F.min(F.when(F.col("predicted_category") == SAFE, F.col("forecast_horizon")))
    return df.groupBy(*keys).agg(
        F.coalesce(F.concat(F.lit("Day +"), first.cast("string")), F.lit(NO_SAFE_DAY))
        .alias("days_until_safe"))


def relative_windows(df: DataFrame, presets: Sequence[int] = (7, 30, 90, 180, 365),
                     keys: Sequence[str] = ("site_id",)) -> DataFrame:
    """Presets "last N days" back from each key's max date, both ends
    inclusive (N + 1 days). One pass: conditional aggregates per preset on
    the rows themselves (no row multiplication), then the per-key result is
    unpivoted to one row per preset."""
    keys = list(keys)
    # Each key's last day is an aggregate, joined back: no key is one window.
    rows = df.select(*keys, "date", "aqi")
    ends = rows.groupBy(*[F.col(k).alias(f"__key_{k}") for k in keys]).agg(F.max("date").alias("__max"))
    same = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys])
    j = rows.join(ends, same)
    aggs = []
    for n in presets:
        inside = F.col("date") >= F.date_sub(F.col("__max"), n)
        aggs += [F.count_if(inside).alias(f"days_{n}"),
                 F.min(F.when(inside, F.col("date"))).alias(f"from_{n}"),
                 F.max(F.when(inside, F.col("date"))).alias(f"to_{n}"),
                 stable_round(F.avg(F.when(inside, F.col("aqi"))), 6).alias(f"aqi_{n}")]
    wide = j.groupBy(*keys).agg(*aggs)
    per = F.explode(F.array(*[F.struct(F.lit(n).alias("preset_days"),
                                       F.col(f"days_{n}").alias("days"),
                                       F.col(f"from_{n}").alias("from_date"),
                                       F.col(f"to_{n}").alias("to_date"),
                                       F.col(f"aqi_{n}").alias("avg_aqi")) for n in presets]))
    return wide.select(*keys, per.alias("p")).select(*keys, "p.*").where(F.col("days") > 0)


def card_label(d: Column) -> Column:
    """``Mon 05 Jan`` day label."""
    return F.date_format(d, "EEE dd MMM")


def percent_label(x: Column) -> Column:
    """0.873 → ``87%``; NULL → ``N/A``."""
    return F.coalesce(F.concat(round_half_away(x * 100, 0).cast("int").cast("string"), F.lit("%")),
                      F.lit("N/A"))


def measure_label(x: Column, unit: str = "", decimals: int = 1) -> Column:
    """a measure for display — ``23.4 °C``, ``87 µg/m³``; NULL → ``N/A``.
    Rounded half away from zero on the scaled value (report-tool ROUND)."""
    text = F.format_number(round_half_away(x, decimals), decimals)
    text = F.regexp_replace(text, ",", "")
    return F.coalesce(F.concat(text, F.lit(f" {unit}" if unit else "")), F.lit("N/A"))

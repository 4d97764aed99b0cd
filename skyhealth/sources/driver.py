"""Deterministic derivation of environmental inputs from the driver tables.

The benchmark tables hold no weather, so daily weather is derived from
``lineitem`` and daily air quality from ``orders`` (both keyed by
``site_id = orderkey % 4`` and the calendar day), intra-day slots and the
forecast log from ``events``. All of it is ordinary aggregation with
map-side partial aggregation: the shuffle carries one partial row per
(site, day) per input partition, whatever the input size.

Means are computed as ``sum(decimal) / count`` so the value is bit-exact and
independent of summation order (the DuckDB oracle does the same).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

N_SITES = 4
N_SLOT_SITES = 10


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def exact_sum(c: str, scale: int = 2) -> Column:
    """Exact sum of a fixed-point-valued double column (``scale`` decimals):
    the values are summed as 64-bit integers in units of 10^-scale, so the
    result is the same in any order and on any partitioning."""
    unit = float(10 ** scale)
    return F.sum(F.rint(F.col(c) * F.lit(unit)).cast("long")).cast("double") / F.lit(unit)


def exact_avg(c: str, scale: int = 2) -> Column:
    """Order-independent mean of a fixed-point-valued double column."""
    return exact_sum(c, scale) / F.count(c).cast("double")


def weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily weather per (site_id, date) from lineitem."""
    li = read_table(spark, sf_dir, "lineitem")
    g = (li.select(
            (F.col("l_orderkey") % N_SITES).cast("int").alias("site_id"),
            F.col("l_shipdate").cast("date").alias("date"),
            "l_quantity", "l_discount", "l_tax", "l_returnflag",
            "l_linenumber", "l_extendedprice")
         .groupBy("site_id", "date")
         .agg(exact_avg("l_quantity").alias("q_avg"),
              F.max("l_quantity").alias("q_max"),
              F.min("l_quantity").alias("q_min"),
              exact_avg("l_discount").alias("d_avg"),
              F.min("l_discount").alias("d_min"),
              F.max("l_discount").alias("d_max"),
              exact_avg("l_tax").alias("t_avg"),
              F.max("l_tax").alias("t_max"),
              F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("n_r"),
              exact_avg("l_linenumber").alias("ln_avg"),
              exact_avg("l_extendedprice").alias("p_avg")))
    return g.select(
        "site_id", "date",
        F.col("q_avg").alias("temperature"),
        (F.col("d_avg") * 1000).alias("humidity"),
        (F.col("t_avg") * 600).alias("wind"),
        (F.col("ln_avg") + 1000).alias("pressure"),
        (F.col("p_avg") / 1000).alias("cloud_cover"),
        F.col("q_max").alias("temp_max"),
        F.col("q_min").alias("temp_min"),
        (F.col("q_avg") * 2).alias("apparent_temp_max"),
        (F.col("q_min") * 2).alias("apparent_temp_min"),
        (F.col("q_avg") * 1.5).alias("apparent_temp_mean"),
        (F.col("d_max") * 1000).alias("humidity_max"),
        (F.col("d_min") * 1000).alias("humidity_min"),
        (F.col("t_max") * 600).alias("wind_max"),
        (F.col("t_max") * 900).alias("wind_gust_max"),
        (F.col("n_r") * 0.25).alias("precipitation"),
        (F.col("n_r") * 0.2).alias("rain_sum"),
    )


def pollution_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily air quality per (site_id, date) from orders."""
    o = read_table(spark, sf_dir, "orders")
    g = (o.select(
            (F.col("o_orderkey") % N_SITES).cast("int").alias("site_id"),
            F.col("o_orderdate").cast("date").alias("date"),
            "o_totalprice", "o_custkey")
         .groupBy("site_id", "date")
         .agg(exact_avg("o_totalprice").alias("p_avg"),
              F.max("o_totalprice").alias("p_max"),
              F.min("o_totalprice").alias("p_min"),
              F.count(F.lit(1)).alias("n"),
              F.max("o_custkey").alias("c_max")))
    return g.select(
        "site_id", "date",
        (F.col("p_avg") / 10000).alias("pm25"),
        (F.col("p_max") / 10000).alias("pm10"),
        (F.col("p_avg") / 2500).alias("aqi"),
        (F.col("p_avg") / 3000).alias("european_aqi"),
        (F.col("p_min") / 1000).alias("ozone"),
        (F.col("p_avg") / 8000).alias("nitrogen_dioxide"),
        (F.col("p_min") / 50000).alias("sulphur_dioxide"),
        (F.col("p_max") / 2480).alias("dust"),
        (F.col("c_max") % 12).cast("double").alias("uv_index"),
        (F.col("p_avg") / 1000).alias("carbon_monoxide"),
        (F.col("n") / 40.0).alias("aerosol_optical_depth"),
    )


def dirty(df: DataFrame, null_rules: dict) -> DataFrame:
    """Dirty-data overlay: NULL out columns on a day-of-year rule and
    duplicate every row falling on the 5th of a month (raw-file defects)."""
    doy = F.dayofyear("date")
    df = df.withColumns({c: F.when(doy % m == 0, F.lit(None).cast("double")).otherwise(F.col(c))
                         for c, m in null_rules.items()})
    copies = F.when(F.dayofmonth("date") == 5, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.withColumn("__copy", F.explode(copies)).drop("__copy")


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed raw weather in its source shape: raw names, tz-suffixed date strings."""
    from skyhealth.schemas import WEATHER_RENAMES
    w = dirty(weather_daily(spark, sf_dir), {"wind": 31, "pressure": 11, "cloud_cover": 13})
    back = {v: k for k, v in WEATHER_RENAMES.items()}
    cols = [F.col("site_id"),
            F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit(" 00:00:00+00:00")).alias("date")]
    cols += [F.col(c).alias(back[c]) for c in w.columns if c in back]
    return w.select(*cols)


def pollution_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed raw air quality: raw names (pm2_5, us_aqi), ISO date strings
    (unparseable on day-of-year multiples of 53)."""
    p = dirty(pollution_daily(spark, sf_dir), {"pm10": 7, "ozone": 7, "dust": 9})
    return p.select(
        "site_id",
        F.when(F.dayofyear("date") % 53 == 0, F.lit("n/a"))
        .otherwise(F.date_format("date", "yyyy-MM-dd")).alias("date"),
        F.col("pm25").alias("pm2_5"), "pm10", F.col("aqi").alias("us_aqi"),
        "european_aqi", "ozone", "nitrogen_dioxide", "sulphur_dioxide", "dust",
        "uv_index", "carbon_monoxide", "aerosol_optical_depth")


def event_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intra-day slot rows from events: one slot per event.

    ``run_date = date(ts) - event_id % 6`` gives horizons 0..5 so the horizon
    filter rejects rows at both ends.
    """
    e = read_table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    k = F.get_json_object("props", "$.k").cast("double")
    return e.select(
        (F.col("user_id") % N_SLOT_SITES).cast("int").alias("site_id"),
        F.col("event_id"),
        ts.alias("ts"),
        F.unix_timestamp(ts).alias("dt"),
        F.date_sub(ts.cast("date"), (F.col("event_id") % 6).cast("int")).alias("run_date"),
        F.col("event_type"),
        F.col("value"),
        k.alias("k"),
    )


HOURLY_VALUE_COLUMNS = ["pm10", "pm2_5", "carbon_monoxide", "nitrogen_dioxide",
                        "sulphur_dioxide", "ozone", "aerosol_optical_depth", "dust",
                        "uv_index", "us_aqi", "european_aqi"]


def hourly_air_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly air-quality rows (the gap-fill source) from lineitem.

    ``time`` is a local ISO string ``yyyy-MM-ddTHH:mm``; every measure is a
    2-decimal fixed-point value, so daily means can be computed exactly.
    """
    li = read_table(spark, sf_dir, "lineitem")
    ts = F.col("l_shipdate").cast("timestamp") + F.make_interval(
        hours=F.col("l_linenumber").cast("int"))
    q = F.col("l_quantity")
    return li.select(
        (F.col("l_orderkey") % N_SITES).cast("int").alias("site_id"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm").alias("time"),
        (q * 2 + F.col("l_tax")).alias("pm10"),
        (q + F.col("l_discount")).alias("pm2_5"),
        (q * 10).alias("carbon_monoxide"),
        (q + F.col("l_tax")).alias("nitrogen_dioxide"),
        (F.col("l_tax") * 100).alias("sulphur_dioxide"),
        (q * 3).alias("ozone"),
        (F.col("l_discount") * 5).alias("aerosol_optical_depth"),
        (q * 4).alias("dust"),
        F.col("l_linenumber").cast("double").alias("uv_index"),
        (q * 4 + F.col("l_discount")).alias("us_aqi"),
        (q * 3).alias("european_aqi"),
    )


def weather_slot_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed weather-forecast document per event: ``{site_id, run_date,
    list:[slot]}`` as JSON text, in the provider's nested shape (m/s wind,
    optional gust and rain). Measures are integers or dyadic fractions."""
    s = event_slots(spark, sf_dir)
    k = F.col("k")
    temp = (k % 40 + 5)
    slot = F.struct(
        F.col("dt").alias("dt"),
        F.struct(temp.alias("temp"), (temp + F.col("event_id") % 3).alias("temp_max"),
                 (temp - F.col("event_id") % 2).alias("temp_min"),
                 (temp + 1).alias("feels_like"), k.alias("humidity"),
                 (k % 20 + 1000).alias("pressure")).alias("main"),
        F.struct((k * 2.5).alias("speed"),
                 F.when(F.col("event_type") != "error", k * 3.75).alias("gust")).alias("wind"),
        F.struct((k % 100).alias("all")).alias("clouds"),
        F.when(F.col("event_type") == "purchase",
               F.struct(((k % 8) * 0.25).alias("3h"))).alias("rain"),
    )
    return s.select(F.col("event_id"), F.to_json(F.struct(
        F.col("site_id"), F.col("run_date"), F.array(slot).alias("list"))).alias("payload"))


def pollution_slot_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed air-pollution-forecast document per event (``list[].components``)."""
    s = event_slots(spark, sf_dir)
    k = F.col("k")
    slot = F.struct(
        F.col("dt").alias("dt"),
        F.struct((F.col("event_id") % 5 + 1).cast("int").alias("aqi")).alias("main"),
        F.struct(F.when(F.col("event_type") != "signup", k).alias("pm2_5"),
                 (k + 5).alias("pm10"), (k * 2).alias("o3"), (k % 30).alias("no2"),
                 (k % 7).alias("so2"), (k * 10).alias("co")).alias("components"),
    )
    return s.select(F.col("event_id"), F.to_json(F.struct(
        F.col("site_id"), F.col("run_date"), F.array(slot).alias("list"))).alias("payload"))


EVENT_CATEGORY = {"click": "Safe Air Day", "view": "Moderate Risk Day",
                  "purchase": "High Respiratory Risk Day", "signup": "Mask Recommended Day",
                  "error": "Avoid Outdoor Activity Day"}


def forecast_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast prediction log from events: every event is one generated
    forecast for (forecast_date, horizon); many versions per key."""
    e = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    cat = None
    for et, c in EVENT_CATEGORY.items():
        cat = F.when(F.col("event_type") == et, F.lit(c)) if cat is None else \
            cat.when(F.col("event_type") == et, F.lit(c))
    conf = F.col("value") / 500
    other = (F.lit(1.0) - conf) / 4
    probs = {name: F.when(cat == c, conf).otherwise(other) for c, name in [
        ("Safe Air Day", "prob_safe"), ("Moderate Risk Day", "prob_moderate"),
        ("High Respiratory Risk Day", "prob_high_resp"), ("Mask Recommended Day", "prob_mask"),
        ("Avoid Outdoor Activity Day", "prob_avoid")]}
    return e.select(
        F.col("ts").cast("date").alias("forecast_date"),
        (F.col("user_id") % 3 + 1).cast("int").alias("forecast_horizon"),
        F.col("ts").cast("timestamp").alias("generated_at"),
        F.col("event_id"),
        F.lit("v2.1").alias("model_version"),
        cat.alias("predicted_category"),
        conf.alias("confidence"),
        *[v.alias(n) for n, v in probs.items()],
        (k / 4 + 10).alias("temperature"),
        k.alias("humidity"),
        (k / 2).alias("wind"),
        (F.col("value") / 10).alias("pm25"),
        (F.col("value") / 2).alias("aqi"),
        (k / 4 + 10 + k * 0.33 - k / 2 * 0.70).alias("heat_index"),
        (F.col("value") / 10 * 0.5 + F.col("value") / 2 * 0.2).alias("pollution_level"),
        (F.col("value") / 10 * 0.4).alias("respiratory_stress"),
        (k % 9).alias("temp_range"),
        (k / 4 + 12).alias("heat_stress_peak"),
        (k / 2 * (1 - k / 100)).alias("dust_risk_index"),
        (k % 5).alias("rain_wash_effect"),
    )

"""Step 13: streaming landing (X1, X2), read back as batch results."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from skyhealth.plans.oracle import with_ctes
from skyhealth.plans.q_slots import SLOT_CHAIN
from skyhealth.plans.registry import register
from skyhealth.session import cut_lineage, scratch_path
from skyhealth.sources.driver import pollution_slot_payloads, weather_slot_payloads
from skyhealth.streaming.rollup import daily_events, run_document_rollup, run_insert_if_absent, run_rollup


@register("stream_daily_rollup", """
SELECT CAST(ts AS DATE) AS date, CAST(user_id % 10 AS INTEGER) AS site_id, COUNT(*) AS n_slots,
  CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / CAST(COUNT(value) AS DOUBLE) AS mean_value,
  MAX(value) AS max_value, MIN(value) AS min_value,
  SUM(CASE WHEN event_type = 'purchase'
      THEN (CAST(json_extract_string(props, '$.k') AS DOUBLE) % 8) * 0.25 ELSE 0.0 END) AS precipitation
FROM events GROUP BY 1, 2""")
def stream_daily_rollup(spark, sf_dir):
    out = run_rollup(spark, f"{sf_dir.rstrip('/')}/events*.parquet")
    return spark.read.parquet(out).drop("month")


@register("stream_insert_if_absent", """
SELECT site_id, date, MIN(event_id) AS first_event_id, COUNT(*) AS n_events FROM (
  SELECT DISTINCT CAST(user_id % 10 AS INTEGER) AS site_id, CAST(ts AS DATE) AS date,
    CASE WHEN event_id % 50 <> 0 THEN event_id END AS event_id, ts, event_type, value,
    CASE WHEN event_type = 'purchase' THEN (CAST(json_extract_string(props, '$.k') AS DOUBLE) % 8) * 0.25 ELSE 0.0 END AS rain
  FROM events) e
GROUP BY 1, 2""")
def stream_insert_if_absent(spark, sf_dir):
    """Events land in several files, one a micro-batch: some without an id,
    some again in a later file, and the whole folder a second time."""
    landing = scratch_path(spark, f"landing-{uuid.uuid4().hex[:12]}")
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    events = events.withColumn("event_id", F.when(F.col("event_id") % 50 != 0, F.col("event_id")))
    events.repartition(3, "event_id").write.parquet(landing)
    again = events.where((F.col("event_id") % 7 == 0) | F.col("event_id").isNull())
    again.coalesce(1).write.mode("append").parquet(landing)
    table = run_insert_if_absent(spark, landing, max_files=1)
    return daily_events(spark.read.parquet(run_insert_if_absent(spark, landing, table)))


def _landed_documents(spark, payloads):
    """Documents in four files, one a range of slot days and a day in ten of
    them up to five days late, so in a later file than its days."""
    path = scratch_path(spark, f"documents-{uuid.uuid4().hex[:12]}")
    day = F.to_date(F.timestamp_seconds(F.get_json_object("payload", "$.list[0].dt").cast("long")))
    docs = cut_lineage(payloads.select("payload", F.date_add(day, F.when(F.col("event_id") % 10 == 0, F.lit(5)).otherwise(F.lit(0))).alias("landed")))
    first, last = docs.agg(F.min("landed"), F.max("landed")).first()
    step = F.floor(F.datediff("landed", F.lit(first)) * 4 / ((last - first).days + 1)) if first else F.lit(0)
    for i in range(4):
        docs.where(step == i).select("payload").coalesce(1).write.mode("append").text(path)
    return path


@register("stream_weather_documents", with_ctes(SLOT_CHAIN, "SELECT * FROM wfd"))
def stream_weather_documents(spark, sf_dir):
    """X1, S3 → A1: a file a micro-batch, the watermark at eight days."""
    path = _landed_documents(spark, weather_slot_payloads(spark, sf_dir))
    out = run_document_rollup(spark, path, "weather", "8 days", max_files=1)
    return spark.read.parquet(out).drop("month")


@register("stream_pollution_documents", with_ctes(SLOT_CHAIN, "SELECT * FROM pfd"))
def stream_pollution_documents(spark, sf_dir):
    """X1, S4 → A2."""
    path = _landed_documents(spark, pollution_slot_payloads(spark, sf_dir))
    out = run_document_rollup(spark, path, "pollution", "8 days", max_files=1)
    return spark.read.parquet(out).drop("month")

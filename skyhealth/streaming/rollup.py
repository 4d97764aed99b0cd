"""Incremental landing with Structured Streaming.

X1 rolls intra-day slot records up to daily tumbling windows per site with
a watermark for late slots. X2 appends events idempotently
(insert-if-absent by key) from ``foreachBatch``, so replays never duplicate
an event and late ones are never lost; days are summed on read. Both run with ``trigger(availableNow=True)`` for
scheduled daily jobs; the same code runs continuously with a processing
trigger.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyhealth.operators.merge import rows_to_insert, upsert
from skyhealth.operators.slots import forecast_window, pollution_slots_to_daily, weather_slots_to_daily
from skyhealth.schemas import POLLUTION_SLOTS_PAYLOAD, WEATHER_SLOTS_PAYLOAD
from skyhealth.session import cut_lineage, scratch_path
from skyhealth.sources.payloads import explode_pollution_slots, explode_weather_slots
from skyhealth.sources.tables import read_if_exists, replace_partitions

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("props", T.StringType(), True),
])

N_SLOT_SITES = 10


def slot_stream(spark: SparkSession, path: str, watermark: str | None = "2 days",
                max_files: int | None = None) -> DataFrame:
    """Landed slot records as a stream (file source, explicit schema);
    ``max_files`` bounds the files of a micro-batch."""
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    s = (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)
    ts = F.col("ts").cast("timestamp")          # NTZ → session-zone timestamp (T6)
    k = F.get_json_object("props", "$.k").cast("double")
    slots = (s.select((F.col("user_id") % N_SLOT_SITES).cast("int").alias("site_id"),
                     F.col("event_id"), ts.alias("ts"), F.col("event_type"), F.col("value"),
                     F.when(F.col("event_type") == "purchase", (k % 8) * 0.25)
                     .otherwise(F.lit(0.0)).alias("rain_3h")))
    return slots.withWatermark("ts", watermark) if watermark else slots


def daily_rollup(slots: DataFrame) -> DataFrame:
    """Tumbling one-day windows per site."""
    return (slots.groupBy(F.window("ts", "1 day").alias("w"), "site_id")
            .agg(F.count(F.lit(1)).alias("n_slots"),
                 (F.sum(F.rint(F.col("value") * F.lit(100.0)).cast("long")).cast("double")
                  / F.lit(100.0) / F.count("value").cast("double")).alias("mean_value"),
                 F.max("value").alias("max_value"), F.min("value").alias("min_value"),
                 F.sum("rain_3h").alias("precipitation"))
            .select(F.col("w.start").cast("date").alias("date"), "site_id", "n_slots",
                    "mean_value", "max_value", "min_value", "precipitation"))


def run_rollup(spark: SparkSession, path: str, mode: str = "update",
               watermark: str = "2 days", max_files: int | None = None) -> str:
    """Run X1 to completion (availableNow) and return the output path.

    ``mode="append"`` emits a day only once the watermark has passed it;
    ``"update"`` merges the days and sites a micro-batch changed into the
    table, rewriting only their months. The watermark bounds the state of both.
    """
    run = uuid.uuid4().hex[:12]
    out, ckpt = scratch_path(spark, f"rollup-{run}/out"), scratch_path(spark, f"rollup-{run}/ckpt")
    agg = daily_rollup(slot_stream(spark, path, watermark, max_files))
    w = agg.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True)
    if mode == "append":
        q = w.outputMode("append").format("parquet").option("path", out).start()
    else:
        q = w.outputMode("update").foreachBatch(_merge_batch(out, ["site_id", "date"])).start()
    q.awaitTermination()
    return out


SLOT_DOCUMENTS = {"weather": (WEATHER_SLOTS_PAYLOAD, explode_weather_slots, weather_slots_to_daily),
                  "pollution": (POLLUTION_SLOTS_PAYLOAD, explode_pollution_slots, pollution_slots_to_daily)}


def document_slots(spark: SparkSession, path: str, kind: str, watermark: str, max_files: int | None = None) -> DataFrame:
    """Landed forecast documents (S3, S4; a JSON line each) as a stream of
    their slots, exploded inside the stream, with event time ``ts``."""
    schema, explode, _ = SLOT_DOCUMENTS[kind]
    reader = spark.readStream.schema(schema)
    docs = (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).json(path)
    return explode(docs).withColumn("ts", F.timestamp_seconds("dt")).withWatermark("ts", watermark)


def run_document_rollup(spark: SparkSession, path: str, kind: str, watermark: str = "2 days",
                        max_files: int | None = None) -> str:
    """X1 over landed documents: the daily records of A1 or A2 per site and
    run, as the documents come in; the output path. A day is open until the
    watermark has passed it; a document later than that is too late for it."""
    run = uuid.uuid4().hex[:12]
    out, ckpt = scratch_path(spark, f"documents-{run}/out"), scratch_path(spark, f"documents-{run}/ckpt")
    slots = forecast_window(document_slots(spark, path, kind, watermark, max_files))
    days = slots.withColumn("w", F.window("ts", "1 day"))
    daily = SLOT_DOCUMENTS[kind][2](days, keys=("site_id", "run_date", "w")).drop("w")
    (daily.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True).outputMode("update")
     .foreachBatch(_merge_batch(out, ["site_id", "run_date", "date"])).start().awaitTermination())
    return out


def _merge_batch(target_path: str, keys: list[str]):
    """Upsert of a micro-batch; a replayed batch gives the same table."""
    def fn(batch: DataFrame, _epoch: int) -> None:
        batch = cut_lineage(batch.withColumn("month", F.year("date") * 100 + F.month("date")))
        current = read_if_exists(batch.sparkSession, target_path)
        if current is not None:
            touched = current.join(batch.select("month").distinct(), "month", "left_semi")
            batch = upsert(touched.select(*batch.columns), batch, keys)
        replace_partitions(batch, target_path, ["month"])
    return fn


def keyed_events(slots: DataFrame) -> DataFrame:
    """Events with their ``date``, ``month`` and ``event_key``. An event is its
    event_id on its day (a repeat carries the same ts). A row without event_id
    is told by its whole content: rows that agree in every column are one
    event, any others are different ones. Rows without ts are of month 0."""
    day = F.col("ts").cast("date")
    content = F.sha2(F.to_json(F.struct(*slots.columns), {"ignoreNullFields": "false"}), 256)
    key = F.when(F.col("event_id").isNotNull(), F.concat_ws("@", "event_id", F.coalesce(day.cast("string"), F.lit("-"))))
    return slots.withColumns({"date": day, "month": F.coalesce(F.year(day) * 100 + F.month(day), F.lit(0)),
                              "event_key": F.coalesce(key, content)})


def absent_events(events: DataFrame, target: DataFrame | None) -> DataFrame:
    """The keyed ``events`` that ``target`` (partitioned by month) lacks, each
    once. A key holds its day, so only the months of ``events`` are read."""
    new = events.dropDuplicates(["event_key"])
    if target is None:
        return new
    # One value a month of the calendar that the batch touches.
    months = [r.month for r in events.select("month").distinct().collect()]
    return rows_to_insert(new, target.where(F.col("month").isin(months)), ["month", "event_key"])


def _insert_batch(target_path: str):
    def fn(batch: DataFrame, _epoch: int) -> None:
        # Read for its months and again for its rows: cut once.
        events = cut_lineage(keyed_events(batch))
        new = absent_events(events, read_if_exists(batch.sparkSession, target_path))
        new.write.mode("append").partitionBy("month").parquet(target_path)
    return fn


def run_insert_if_absent(spark: SparkSession, path: str, target_path: str | None = None,
                         max_files: int | None = None) -> str:
    """Stream → per-batch insert-if-absent of events into a parquet table
    partitioned by month, whichever files, order or days they come in. Running
    it again over the same files, or over more of them, adds only events the
    table lacks; a batch cut off in its write is completed by its replay. A
    batch reads and writes only the months it has events of."""
    run = uuid.uuid4().hex[:12]
    target = target_path or scratch_path(spark, f"insert-{run}/table")
    q = (slot_stream(spark, path, None, max_files).writeStream
         .option("checkpointLocation", scratch_path(spark, f"insert-{run}/ckpt"))
         .trigger(availableNow=True).foreachBatch(_insert_batch(target)).start())
    q.awaitTermination()
    return target


def daily_events(events: DataFrame) -> DataFrame:
    """X2's table read by day: first event and count per site and day."""
    return events.groupBy("site_id", "date").agg(
        F.min("event_id").alias("first_event_id"), F.count(F.lit(1)).alias("n_events"))

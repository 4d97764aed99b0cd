"""Rows without an id, repeats, late files, and what of the target is read."""

import datetime as dt
import io
from contextlib import redirect_stdout

from skyhealth.streaming.rollup import absent_events, keyed_events, run_insert_if_absent

EVENT = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def at(month, day, hour=1):
    return dt.datetime(2024, month, day, hour)


def test_rows_without_an_id(spark, tmp_path):
    rows = [(1, at(1, 1), 3, "click", 1.0, "{}"), (None, at(1, 1), 3, "click", 1.0, "{}"), (None, at(1, 1), 3, "click", 2.0, "{}"),
            (None, at(1, 1), 3, "click", 1.0, "{}"), (None, None, 4, None, None, None), (7, None, 4, "view", 1.0, "{}"), (1, at(1, 1), 3, "click", 1.0, "{}")]
    src, table = str(tmp_path / "in"), str(tmp_path / "table")
    spark.createDataFrame(rows, EVENT).coalesce(1).write.parquet(src)
    for _ in range(3):
        run_insert_if_absent(spark, src, table)
    got = spark.read.parquet(table)
    assert got.count() == got.select("event_key").distinct().count() == 5
    # A late file: an event of an old month and repeats of stored ones.
    late = [(2, at(1, 1), 3, "click", 1.0, "{}"), (None, at(1, 1), 3, "click", 2.0, "{}"), (1, at(3, 9), 3, "click", 1.0, "{}")]
    spark.createDataFrame(late, EVENT).coalesce(1).write.mode("append").parquet(src)
    run_insert_if_absent(spark, src, table, max_files=1)
    got = spark.read.parquet(table)
    assert got.count() == 7 and sorted(r.month for r in got.select("month").distinct().collect()) == [0, 202401, 202403]


def test_a_batch_reads_only_its_months(spark, tmp_path):
    slots = "site_id int, event_id long, ts timestamp, event_type string, value double, rain_3h double"
    table = str(tmp_path / "table")
    stored = [(0, i, at(m, 1), "click", 1.0, 0.0) for i, m in enumerate(range(1, 13))]
    keyed_events(spark.createDataFrame(stored, slots)).write.partitionBy("month").parquet(table)
    batch = keyed_events(spark.createDataFrame([(0, 2, at(3, 1), "click", 1.0, 0.0), (0, 99, at(4, 2), "view", 1.0, 0.0)], slots))
    new = absent_events(batch, spark.read.parquet(table))
    assert [r.event_id for r in new.collect()] == [99]
    out = io.StringIO()
    with redirect_stdout(out):
        new.explain("formatted")
    scans = [line for line in out.getvalue().splitlines() if line.startswith("PartitionFilters")]
    assert scans and all("202403" in line and "202404" in line and "202405" not in line for line in scans)

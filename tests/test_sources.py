"""Code-page files, the schema probe, observed copies, published tables, streamed documents."""

import json
import os
import subprocess
import sys

from pyspark.sql import functions as F

from skyhealth.operators import quality as Q
from skyhealth.sources import flat_files as FF
from skyhealth.sources.tables import drop_versions, publish, read_dated_csv
from skyhealth.streaming.rollup import run_document_rollup

TYPES = {"id": "bigint", "name": "string", "day": "date", "v": "double"}


def test_flat_file_in_a_code_page(spark, tmp_path):
    text = ('name,id,اسم,v\r\n"طقس، ""جيد""",1,x,3.5\r\nغبار,two,x,n/a\r\nقصير,3\r\nطويل,4,x,1,extra\r\n,5,,\r\n')
    (tmp_path / "a.csv").write_bytes(text.encode("windows-1256"))
    rows = FF.read_flat_file(spark, str(tmp_path / "a.csv"), {**TYPES, "اسم": "string"})
    assert rows.schema.simpleString().startswith("struct<id:bigint,name:string,day:date,v:double")
    got = [(r.id, r.name, r.day, r.v, r["اسم"]) for r in FF.accepted(rows).collect()]
    assert got == [(1, 'طقس، "جيد"', None, 3.5, "x"), (5, None, None, None, None)]
    bad = sorted((r.column_name, r.raw_value) for r in FF.rejected(rows, "name").collect())
    assert bad == [("_record", "طويل,4,x,1,extra"), ("_record", "قصير,3"), ("id", "two"), ("v", "n/a")]


def test_code_pages_come_back(spark):
    for page in ("windows-1256", "windows-1252", "iso-8859-15"):
        chars = "".join(c for c in bytes(range(32, 256)).decode(page, "replace") if c != "�" and c.isprintable())
        (r,) = spark.createDataFrame([(chars,)], "t string").select(
            FF.encoded(F.col("t"), page).alias("e"), FF.decoded(FF.encoded(F.col("t"), page), page).alias("d")).collect()
        assert r.d == chars and r.e.encode("latin-1") == chars.encode(page)
    (r,) = spark.createDataFrame([("aπ€",)], "t string").select(FF.encoded(F.col("t"), "windows-1252").alias("e")).collect()
    assert r.e == "a?\x80"


def test_schema_probe(spark):
    df = spark.createDataFrame([], "a int NOT NULL, `b.c` string, d array<double>")
    assert [tuple(r) for r in Q.describe_columns(spark, df).collect()] == [
        ("a", 1, "int", False), ("b.c", 2, "string", True), ("d", 3, "array<double>", True)]


def test_dated_csv(spark, tmp_path):
    (tmp_path / "f.csv").write_text("v,date\n1,2024-01-05\n2,soon\n3,\n4,2024-02-01 10:00:00\n")
    got = read_dated_csv(spark, str(tmp_path / "f.csv")).orderBy("v").collect()
    assert [(r.v, str(r.date)) for r in got] == [("1", "2024-01-05"), ("4", "2024-02-01")]


def test_a_copy_is_measured_by_its_write(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def seen(x):
        calls.add(1)
        return x

    df = spark.range(100).select("id", F.when(F.col("id") % 4 != 0, seen(F.col("id").cast("int"))).alias("odd.name"))
    path = str(tmp_path / "t")
    metrics = Q.observed_copy(df, path)
    assert calls.value == 100 or calls.value == 75                       # one pass over the source
    (r,) = Q.copies_match(spark, {"t": (metrics, spark.read.parquet(path))}).collect()
    assert (r.source_rows, r.target_rows, r.source_nulls, r.target_nulls, r.match) == (100, 100, 25, 25, True)
    lost = spark.read.parquet(path).where("id <> 7")
    changed = spark.read.parquet(path).withColumn("id", F.when(F.col("id") == 7, 8).otherwise(F.col("id")))
    assert [r.match for r in Q.copies_match(spark, {"l": (metrics, lost), "c": (metrics, changed)}).collect()] == [False, False]


def test_readers_see_whole_versions(spark, tmp_path):
    name, root = "published_for_test", str(tmp_path / "versions")
    first = publish(spark, spark.range(10).selectExpr("id AS v"), name, root)
    reader = spark.table(name)
    second = publish(spark, spark.table(name).selectExpr("v + 100 AS v"), name, root)
    assert reader.agg(F.min("v")).first()[0] == 0                         # planned on the old version
    assert spark.table(name).agg(F.min("v"), F.count("*")).first() == (100, 10)
    # A write that fails leaves the published version alone.
    try:
        publish(spark, spark.range(3).selectExpr("raise_error('stop') AS v"), name, root)
    except Exception as e:  # noqa: BLE001
        assert "stop" in str(e)
    assert spark.table(name).count() == 10 and os.path.isdir(first)
    drop_versions(spark, root, [second])
    assert not os.path.isdir(first) and spark.table(name).count() == 10
    spark.sql(f"DROP TABLE {name}")


def test_documents_later_than_the_watermark(spark, tmp_path):
    day = 86_400

    def landed(i, days):
        docs = [{"site_id": 1, "run_date": f"2024-01-{d - 1:02d}", "list": [
            {"dt": (19_723 + d - 1) * day + h * 3600, "main": {"aqi": 1}, "components": {"pm2_5": float(h)}} for h in (3, 9)]} for d in days]
        (tmp_path / f"f{i}.json").write_text("\n".join(map(json.dumps, docs)) + "\n")
        os.utime(tmp_path / f"f{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))

    landed(0, [2, 3])
    landed(1, [20, 3])            # the third again: within the watermark of its batch
    landed(2, [21, 2, 19])        # the second: its day is closed; the nineteenth is in time
    out = spark.read.parquet(run_document_rollup(spark, str(tmp_path), "pollution", "5 days", max_files=1))
    assert sorted((str(r.date), r.pm25) for r in out.collect()) == [
        ("2024-01-02", 6.0), ("2024-01-03", 6.0), ("2024-01-19", 6.0), ("2024-01-20", 6.0), ("2024-01-21", 6.0)]


def test_entry_imports_nothing_of_spark_sessions():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q)"
    assert subprocess.run([sys.executable, "-c", code], cwd=root, timeout=120).returncode == 0

"""Table sources and sinks.

Format + path (or catalog table) are parameters, so parquet, CSV, a catalog
table or JDBC are configuration, not code. Replacing a table that is also
being read is done through a staged write and a rename, never by
overwriting the path under the reader.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyhealth.schemas import POLLUTION_RAW_SCHEMA, WEATHER_RAW_SCHEMA


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             all_strings: bool = False) -> DataFrame:
    """UTF-8 header CSV with an explicit schema (S1, S2, S10, S11), or every
    column as a string; files in a code page (S15) are ``flat_files``' matter."""
    r = spark.read.option("header", True)
    if all_strings:
        return r.option("inferSchema", False).csv(path)
    return r.schema(schema).csv(path) if schema is not None else r.csv(path)


def read_weather_csv(spark: SparkSession, path: str) -> DataFrame:
    """Historical weather CSV (raw names, tz-suffixed date strings)."""
    return read_named_csv(spark, path, WEATHER_RAW_SCHEMA)


def read_pollution_csv(spark: SparkSession, path: str) -> DataFrame:
    """Historical air-quality CSV (pm2_5, us_aqi, ISO dates)."""
    return read_named_csv(spark, path, POLLUTION_RAW_SCHEMA)


def read_dated_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Processed-feature file; unparseable dates are dropped."""
    df = read_named_csv(spark, path, schema) if schema is not None else read_csv(spark, path)
    return (df.withColumn("date", F.to_date(F.try_to_timestamp(F.col("date").cast("string"))))
            .dropna(subset=["date"]))


def read_table(spark: SparkSession, source: str, fmt: str = "parquet",
               options: Mapping[str, str] | None = None) -> DataFrame:
    """A catalog table name (fmt="table"), a path in any file format, or
    ``fmt="jdbc"`` with ``options`` (url, dbtable, ...)."""
    if fmt == "table":
        return spark.table(source)
    reader = spark.read.format(fmt).options(**(options or {}))
    return reader.load() if fmt == "jdbc" else reader.load(source)


def run_query(spark: SparkSession, sql: str, args: Mapping | None = None,
              **frames: DataFrame) -> DataFrame:
    """Parameterised SQL (named ``:param`` markers bound, never formatted
    in); ``{name}`` stands for the frame given by that name."""
    return spark.sql(sql, args=dict(args or {}), **frames)


def write_table(df: DataFrame, target: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None,
                options: Mapping[str, str] | None = None) -> None:
    """Write a frame (append or overwrite) to a path, catalog
    table (fmt="table") or JDBC table."""
    w = df.write.mode(mode).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "table":
        w.saveAsTable(target)
    elif fmt == "jdbc":
        w.format("jdbc").save()
    else:
        w.format(fmt).save(target)


def write_if_not_empty(df: DataFrame, target: str, fmt: str = "csv") -> bool:
    """K3: the missing-date list is only written when it has rows; an empty one
    leaves what is there. The rows are computed once, by the write that counts
    them, next to the target."""
    spark, written = df.sparkSession, Observation()
    staged = f"{target.rstrip('/')}.staging-{uuid.uuid4().hex[:12]}"
    write_table(df.observe(written, F.count(F.lit(1)).alias("n")), staged, fmt,
                options={"header": "true"} if fmt == "csv" else None)
    if written.get["n"]:
        _swap(spark, staged, target)
        return True
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staged)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    return False


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at ``path``; None where nothing is there. Any other
    failure to read rises."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return None
    return spark.read.parquet(path)


def state_of(spark: SparkSession, path: str) -> tuple[int, int]:
    """Modification time and bytes of a stored table: another pair, another content."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getFileStatus(p).getModificationTime(), fs.getContentSummary(p).getLength()


def replace_partitions(df: DataFrame, target: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions that ``df`` has rows of (K4, K6); ``df`` may
    read those partitions itself, as its files are moved in after the job."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(target))
    df.sparkSession.catalog.refreshByPath(target)


def month_of(date: Column | str = "date") -> Column:
    """Partition value of a day: yyyymm, 0 for a row without a date."""
    d = F.col(date) if isinstance(date, str) else date
    return F.coalesce(F.year(d) * 100 + F.month(d), F.lit(0)).cast("int")


def partition_folders(spark: SparkSession, target: str, pattern: str) -> list[str]:
    """Partition folders of a stored table that match ``pattern``
    (``live=0/month=*``), relative to it. Names only; no data is read."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}/{pattern}")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or []
    depth = pattern.count("/") + 1
    return ["/".join(f.getPath().toString().rstrip("/").split("/")[-depth:]) for f in found]


def refresh_partitions(df: DataFrame, target: str, partition_by: Sequence[str], pattern: str) -> None:
    """K4: the partitions under ``pattern`` become the content of ``df``, which
    has rows of no others; every other partition keeps its files. Those that
    ``df`` has no rows of are dropped after the write, so a run that fails
    before leaves whole old partitions, and its replay ends the work."""
    spark = df.sparkSession
    replace_partitions(df, target, partition_by)
    written = {"/".join(f"{c}={v}" for c, v in zip(partition_by, r)) for r in df.select(*partition_by).distinct().collect()}
    for folder in partition_folders(spark, target, pattern):
        if folder not in written:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}/{folder}")
            if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True):
                raise OSError(f"{p.toString()} could not be dropped")
    spark.catalog.refreshByPath(target)


def read_named_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV read by column name, in any order (S1, S2): every column is
    taken as a string, cast with ``try_cast``, and NULL where the file has none."""
    raw = read_csv(spark, path, all_strings=True)
    return raw.select(*[(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in raw.columns
                         else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])


def replace_table(spark: SparkSession, df: DataFrame, target: str, fmt: str = "parquet",
                  partition_by: Sequence[str] | None = None, keep_old: bool = False) -> None:
    """K4/K7/K8: replace a table's content with ``df``, which may read the
    table itself. The new content is written next to the target, then the
    old directory is swapped out with two renames (Hadoop FileSystem)."""
    staged = target.rstrip("/") + f".staging-{uuid.uuid4().hex[:12]}"
    write_table(df, staged, fmt, "overwrite", partition_by)
    _swap(spark, staged, target, keep_old)


def _swap(spark: SparkSession, staged: str, target: str, keep_old: bool = False) -> None:
    """Put a written folder in a target's place."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    tgt = jvm.org.apache.hadoop.fs.Path(target)
    fs = tgt.getFileSystem(conf)
    old = jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}.old-{uuid.uuid4().hex[:12]}")
    had = fs.exists(tgt)
    if had and not fs.rename(tgt, old):
        raise OSError(f"{target} could not be set aside; the new content is in {staged}")
    moved = False
    try:
        moved = fs.rename(jvm.org.apache.hadoop.fs.Path(staged), tgt)
    finally:
        # Put the old content back, also where the rename raised an error.
        if not moved and had and not fs.rename(old, tgt):
            raise OSError(f"{target} is in {old.toString()} and its new content in {staged}; neither could be moved")
    if not moved:
        raise OSError(f"{staged} could not be moved to {target}, which is unchanged")
    if had and not keep_old:
        fs.delete(old, True)
    # Readers created after the swap must list the new files, not cached ones.
    spark.catalog.refreshByPath(target)


def publish(spark: SparkSession, df: DataFrame, table: str, root: str) -> str:
    """K7, K8: a new version of a catalog table, whose folder it returns. ``df``
    (which may read the table) is written whole into a folder of its own under
    ``root``; only then is the table's location switched to it, one entry of
    the catalog. A reader has the old version or the new one, and nothing is
    renamed, so it holds where a rename is a copy. Old folders stay until
    ``drop_versions``."""
    folder = f"{root.rstrip('/')}/v-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    else:
        spark.catalog.createTable(table, path=folder, source="parquet", schema=spark.read.parquet(folder).schema)
    spark.catalog.refreshTable(table)
    return folder


def drop_versions(spark: SparkSession, root: str, keep: Sequence[str]) -> None:
    """Delete the version folders under ``root`` but those to ``keep`` (the
    published one, and any that a running job may still read)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    p = path(f"{root.rstrip('/')}/v-*")
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    kept = {k.rstrip("/").rsplit("/", 1)[-1] for k in keep}
    for found in fs.globStatus(p) or []:
        if found.getPath().getName() not in kept and not fs.delete(found.getPath(), True):
            raise OSError(f"{found.getPath().toString()} could not be dropped")

"""Data-quality and evaluation operators.

All of them reduce to aggregates; anything per-class or per-column works on
the already tiny aggregate tables.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyhealth.functions.columns import stable_round
from skyhealth.operators.quantiles import exact_quantiles
from skyhealth.session import cut_lineage


def confusion(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Counts per (truth, prediction) pair."""
    return df.groupBy(F.col(truth).alias("rule_label"), F.col(pred).alias("model_label")) \
        .agg(F.count(F.lit(1)).alias("days"))


def agreement(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """Share of rows where both labels agree (rule vs model agreement)."""
    return df.agg(F.count(F.lit(1)).alias("days"),
                  F.count_if(F.col(truth) == F.col(pred)).alias("agree_days")) \
        .withColumn("agreement_pct", stable_round(F.col("agree_days") / F.col("days") * 100, 4))


def classification_report(conf: DataFrame, digits: int = 6) -> DataFrame:
    """precision/recall/F1/support per class, accuracy, macro and
    weighted averages — derived from the confusion table, like sklearn's
    report (0 where a ratio is undefined)."""
    r = lambda c: stable_round(c, digits)
    # The report reads the (tiny) confusion table in several branches; stage
    # it once so the labelling plan above it runs a single time.
    conf = cut_lineage(conf)
    t = conf.groupBy(F.col("rule_label").alias("label")).agg(
        F.sum("days").alias("support"),
        F.sum(F.when(F.col("rule_label") == F.col("model_label"), F.col("days")).otherwise(0)).alias("tp"))
    p = conf.groupBy(F.col("model_label").alias("label")).agg(F.sum("days").alias("predicted"))
    per = (t.join(p, "label", "full")
           .fillna(0, subset=["support", "tp", "predicted"]))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    per = per.withColumns({"precision": prec, "recall": rec})
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      F.lit(2.0) * F.col("precision") * F.col("recall")
                                      / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0)))
    totals = per.agg(
        F.sum("support").alias("n"), F.sum("tp").alias("tp"), F.count(F.lit(1)).alias("k"),
        F.sum("precision").alias("sp"), F.sum("recall").alias("sr"), F.sum("f1").alias("sf"),
        F.sum(F.col("precision") * F.col("support")).alias("wp"),
        F.sum(F.col("recall") * F.col("support")).alias("wr"),
        F.sum(F.col("f1") * F.col("support")).alias("wf"))
    rows = per.select("label", r(F.col("precision")).alias("precision"),
                      r(F.col("recall")).alias("recall"), r(F.col("f1")).alias("f1_score"),
                      F.col("support").cast("long").alias("support"))
    acc = totals.select(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                        F.lit(None).cast("double").alias("recall"),
                        r(F.col("tp") / F.col("n")).alias("f1_score"),
                        F.col("n").cast("long").alias("support"))
    macro = totals.select(F.lit("macro avg").alias("label"), r(F.col("sp") / F.col("k")).alias("precision"),
                          r(F.col("sr") / F.col("k")).alias("recall"), r(F.col("sf") / F.col("k")).alias("f1_score"),
                          F.col("n").cast("long").alias("support"))
    weighted = totals.select(F.lit("weighted avg").alias("label"), r(F.col("wp") / F.col("n")).alias("precision"),
                             r(F.col("wr") / F.col("n")).alias("recall"), r(F.col("wf") / F.col("n")).alias("f1_score"),
                             F.col("n").cast("long").alias("support"))
    return rows.unionByName(acc).unionByName(macro).unionByName(weighted)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``GROUP BY keys HAVING COUNT(*) > 1`` (expected empty)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def row_count_match(pairs: Mapping[str, tuple[DataFrame, DataFrame]],
                    checksum: bool = False) -> DataFrame:
    """Row counts of source and target per table, and whether they
    match; optionally an order-independent content checksum per side, which
    must match as well."""
    out = None
    for name, (src, dst) in pairs.items():
        for tag, df in (("source", src), ("target", dst)):
            content = F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)") if checksum else F.lit(0).cast("decimal(38,0)")
            side = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(content), F.lit(0)).alias("x"))
            side = side.select(F.lit(name).alias("table_name"), F.lit(tag).alias("side"), "n", F.col("x").cast("decimal(38,0)").alias("x"))
            out = side if out is None else out.unionByName(side)
    of = lambda tag, c: F.max(F.when(F.col("side") == tag, F.col(c)))
    sides = out.groupBy("table_name").agg(
        *[of(tag, c).alias(f"{tag}_{label}") for tag in ("source", "target") for c, label in (("n", "rows"), ("x", "checksum"))])
    same = (F.col("source_rows") == F.col("target_rows")) & (F.col("source_checksum") == F.col("target_checksum"))
    return sides.withColumn("match", same)


def _content(df: DataFrame) -> list[Column]:
    """Rows, an order-independent checksum, and the NULLs of every column."""
    names = sorted(df.columns)
    return [F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in names]).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("checksum"),
            *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{i}") for i, c in enumerate(names)]]


def observed_copy(df: DataFrame, path: str) -> Row:
    """Write ``df`` as Parquet and measure it in that same pass (A17, A18):
    the metrics are of the rows written, and the source is computed once."""
    seen = Observation()
    df.observe(seen, *_content(df)).write.mode("overwrite").parquet(path)
    return Row(**seen.get)


def copies_match(spark: SparkSession, copies: Mapping[str, tuple[Row, DataFrame]]) -> DataFrame:
    """What was observed while each table was written against what its
    copy holds: rows, NULLs and checksum."""
    out = None
    for name, (seen, copy) in copies.items():
        held = copy.agg(*_content(copy))
        nulls = [c for c in held.columns if c.startswith("nulls_")]
        total = lambda cs: sum(cs, F.lit(0))                              # noqa: E731
        side = held.select(
            F.lit(name).alias("table_name"), F.lit(seen["rows"]).cast("long").alias("source_rows"), F.col("rows").alias("target_rows"),
            F.lit(sum(seen[c] for c in nulls)).cast("long").alias("source_nulls"), total([F.col(c) for c in nulls]).cast("long").alias("target_nulls"),
            ((F.col("rows") == seen["rows"]) & (F.col("checksum") == seen["checksum"])
             & F.forall(F.array(*[F.col(c) == seen[c] for c in nulls]), lambda x: x)).alias("match"))
        out = side if out is None else out.unionByName(side)
    return out


def profile(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("site_id",),
            approximate: bool = False) -> DataFrame:
    """Per key and column — count, NULLs, mean, std, min, quartiles, max.

    Counts and moments are one aggregate over (key, column_name, value). The
    quartiles are exact, found by counting (``quantiles``), or those of
    ``percentile_approx`` with ``approximate=True``.
    """
    keys = list(keys)
    if not approximate:
        df = cut_lineage(df.select(*keys, *cols))               # read once a round of counting
    long = df.unpivot(keys, list(cols), "column_name", "value")
    v = F.col("value")
    r = lambda c: stable_round(c, 6)
    quartiles = (0.25, 0.5, 0.75)
    some = [F.percentile_approx(v, q).alias(f"q{i}") for i, q in enumerate(quartiles)] if approximate else []
    stats = long.groupBy(*keys, "column_name").agg(
        F.count(v).alias("count"), F.count_if(v.isNull()).alias("null_count"),
        r(F.avg(v)).alias("mean"), r(F.stddev_samp(v)).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"), *some)
    if not approximate:
        of = [*keys, "column_name"]
        found = exact_quantiles(df, cols, quartiles, keys).withColumnsRenamed({k: f"__of_{k}" for k in of})
        same = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in of])
        stats = stats.join(found, same, "left")
    return stats.select(*keys, "column_name", "count", "null_count", "mean", "std", "min", r(F.col("q0")).alias("q25"),
                        r(F.col("q1")).alias("q50"), r(F.col("q2")).alias("q75"), "max")


def describe_columns(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Column listing (name, ordinal, type, nullable) of a frame/table."""
    rows = [(f.name, i + 1, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, T.StructType([
        T.StructField("column_name", T.StringType()), T.StructField("ordinal_position", T.IntegerType()),
        T.StructField("data_type", T.StringType()), T.StructField("is_nullable", T.BooleanType())]))

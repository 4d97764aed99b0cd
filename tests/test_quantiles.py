"""Exact quantiles by counting against numpy and Spark's own percentile."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyhealth.operators.clean import median_fill
from skyhealth.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]


@pytest.mark.parametrize("few,buckets", [(10_000, 256), (3, 4), (1, 2)])
def test_quantiles_of_every_shape(spark, few, buckets):
    rng = np.random.default_rng(3)
    rows = [(0, float(x), 5.0) for x in rng.normal(0, 1, 60)] + [(None, float(x), None) for x in rng.integers(0, 3, 41)]
    rows += [(1, x, 1.0) for x in (1e308, -1e308, 0.0, 5e-324, 1e-300, float("inf"), float("-inf"), 7.0, 7.0)] + [(2, None, float("nan")), (3, 4.0, None)]
    df = spark.createDataFrame(rows, "site_id int, x double, y double")
    got = {(r.site_id, r.column_name): [r[f"q{i}"] for i in range(len(PROBS))]
           for r in exact_quantiles(df, ["x", "y"], PROBS, few=few, buckets=buckets).collect()}
    for c in ("x", "y"):
        own = df.where(f"{c} IS NOT NULL AND NOT isnan({c})").groupBy("site_id").agg(F.percentile(c, PROBS).alias("q"))
        want = {(r.site_id, c): list(r.q) for r in own.collect()}
        assert {k: v for k, v in got.items() if k[1] == c} == want
    assert exact_quantiles(df.limit(0), ["x"], PROBS).count() == 0


def test_one_site_that_holds_all_rows(spark):
    n = 200_000
    df = spark.range(n).select(F.lit(7).alias("site_id"), F.when(F.col("id") % 10 != 0, F.pmod(F.col("id") * 7919, F.lit(n)).cast("double")).alias("x"))
    got = exact_quantiles(df, ["x"], [0.25, 0.5], few=100).first()
    want = df.agg(F.percentile("x", [0.25, 0.5]).alias("q")).first().q
    assert [got.q0, got.q1] == want
    filled = median_fill(df, ["x"])
    assert filled.where("x IS NULL").count() == 0 and filled.count() == n

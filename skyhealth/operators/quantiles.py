"""Exact quantiles by counting (A5, A18): no task ever holds a key's values.

A quantile is a rank, or the mean of two. Each key and column starts with one
interval, from its least to its greatest value. While an interval holds more
than ``FEW`` values that are not all equal, it is cut into ``BUCKETS`` parts of
equal width; the rows are counted per part (partial aggregates, so a key of any
size sends one row per part and task), prefix sums find the part of every rank,
and that part is the next interval. A part's least and greatest value become
its ends, so each round separates them, whatever the values. In the end the few
values left are counted one by one. The rows move only to meet the intervals of
their key, in a join that splits a hot key (AQE) or broadcasts small sides.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyhealth.session import cut_lineage

FEW = 10_000
BUCKETS = 256


def _with_intervals(df: DataFrame, cols: Sequence[str], keys: list[str], intervals: DataFrame) -> DataFrame:
    """keys, column_name, v and ``s``: the interval that each value lies in."""
    # Two intervals for each quantile and column at most.
    own = intervals.groupBy(*[F.col(k).alias(f"__of_{k}") for k in keys]).agg(
        F.collect_list(F.struct("column_name", "lo", "hi", "before", "ranks", "total")).alias("__s"))
    same = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys])
    rows = df.select(*keys, *cols).join(own, same)

    def item(c: str) -> Column:
        v = F.col(c)
        held = F.filter("__s", lambda s: (s["column_name"] == c) & (s["lo"] <= v) & (v <= s["hi"]))
        return F.struct(F.lit(c).alias("column_name"), v.alias("v"), F.get(held, F.lit(0)).alias("s"))

    return rows.select(*keys, F.inline(F.array(*map(item, cols)))).where("s IS NOT NULL")


def _counted(found: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Counts by ``by`` within each interval, with the number before each and
    the ranks that fall into it."""
    of = [*keys, "column_name", F.col("s.before").alias("before"), F.col("s.ranks").alias("ranks"), F.col("s.total").alias("total")]
    names = [*keys, "column_name", "before", "ranks", "total"]
    n = found.groupBy(*of, by).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    # At most BUCKETS parts, or FEW values, to an interval.
    earlier = Window.partitionBy(*keys, "column_name", "before").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    n = n.withColumn("start", F.col("before") + F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    inside = F.filter("ranks", lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("n")))
    return n.withColumn("ranks", inside).where(F.size("ranks") > 0).select(
        *[c for c in names if c not in ("before", "ranks", "total")], "lo", "hi", "n", F.col("start").alias("before"), "ranks", "total")


def _narrowed(df: DataFrame, cols: Sequence[str], keys: list[str], wide: DataFrame, buckets: int) -> DataFrame:
    found = _with_intervals(df, cols, keys, wide)
    # Halves, as the whole width may leave a double's range; the ends are told apart first.
    share = F.try_divide(F.col("v") / 2 - F.col("s.lo") / 2, F.col("s.hi") / 2 - F.col("s.lo") / 2)
    part = F.when(F.col("v") == F.col("s.hi"), F.lit(buckets - 1)).when(F.col("v") == F.col("s.lo"), F.lit(0)).otherwise(
        F.least(F.floor(F.coalesce(share, F.lit(0.0)) * buckets), F.lit(buckets - 1)))
    return _counted(found.withColumn("part", part.cast("int")), keys, "part")


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], keys: Sequence[str] = ("site_id",),
                    few: int = FEW, buckets: int = BUCKETS) -> DataFrame:
    """keys, column_name and q0, q1, ... (interpolated, NULL-skipping; NaN
    counts as no value) for every key and column that has a value. ``df`` is
    read once a round, so cut its lineage first where that is dear."""
    keys = list(keys)
    if not keys:
        return exact_quantiles(df.withColumn("__all", F.lit(0)), cols, probs, ["__all"], few, buckets).drop("__all")
    df = df.select(*keys, *[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in cols])
    ends = df.groupBy(*keys).agg(*[F.struct(
        F.lit(c).alias("column_name"), F.min(c).alias("lo"), F.max(c).alias("hi"), F.count(c).alias("n")).alias(f"__{i}")
        for i, c in enumerate(cols)])
    at = [F.lit(float(p)) * (F.col("n") - 1).cast("double") for p in probs]
    ranks = F.array_distinct(F.array(*[f(x).cast("long") for x in at for f in (F.floor, F.ceil)]))
    intervals = ends.select(*keys, F.inline(F.array(*[f"__{i}" for i in range(len(cols))]))).where("n > 0").select(
        *keys, "column_name", "lo", "hi", "n", F.lit(0).cast("long").alias("before"), ranks.alias("ranks"), F.col("n").alias("total"))
    intervals = cut_lineage(intervals)
    wide = (F.col("n") > few) & (F.col("lo") < F.col("hi"))
    while not intervals.where(wide).isEmpty():
        intervals = cut_lineage(intervals.where(~wide).unionByName(_narrowed(df, cols, keys, intervals.where(wide), buckets)))
    left = _counted(_with_intervals(df, cols, keys, intervals), keys, "v")
    values = left.select(*keys, "column_name", "total", F.explode("ranks").alias("rank"), F.col("lo").alias("v")).groupBy(
        *keys, "column_name", "total").agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("m"))

    def quantile(p: float) -> Column:
        x = F.lit(float(p)) * (F.col("total") - 1).cast("double")
        below, above = F.floor(x).cast("long"), F.ceil(x).cast("long")
        a, b = F.element_at("m", below), F.element_at("m", above)
        return F.when((below == above) | (a == b), a).otherwise((above - x) * a + (x - below) * b)

    return values.select(*keys, "column_name", *[quantile(p).alias(f"q{i}") for i, p in enumerate(probs)])

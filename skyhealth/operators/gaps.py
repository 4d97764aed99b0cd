"""Date sets, calendar gaps and the gap-fill merge.

Every operator is keyed by site. Per-site work is bounded by the calendar
(one row per site per day), never by raw row counts: raw inputs are reduced
to distinct (site, date) pairs with partial aggregation before any per-site
step. Date sets are bitmaps (U1, U2, J3, A19).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyhealth.functions.constants import GAP_CHUNK_DAYS
from skyhealth.operators.clean import median_fill, parse_date


def date_set(df: DataFrame, keys=("site_id",)) -> DataFrame:
    """U4: distinct (site, date) pairs."""
    return df.select(*keys, "date").where(F.col("date").isNotNull()).distinct()


def calendar(start: Column, end: Column) -> Column:
    """One element per day from start to end inclusive; an empty range
    (start after end, e.g. two date sets that do not overlap) gives no rows."""
    return F.explode(F.when(start <= end, F.sequence(start, end, F.expr("INTERVAL 1 DAY"))))


# Days are numbered from the first of year 1 and kept as bitmaps of
# BITMAP_DAYS days, one per key and bucket: what is shuffled is a bitmap a task,
# not the dates.
FIRST_DAY = "0001-01-01"
BITMAP_DAYS = 32_768


def day_number(date: Column | str) -> Column:
    return F.datediff(date, F.lit(FIRST_DAY).cast("date")).cast("long")


def date_bitmaps(df: DataFrame, keys=("site_id",)) -> DataFrame:
    """U4 as bitmaps: per key its first and last day, the number of its days,
    and ``days``, a map from bucket to bitmap."""
    keys = list(keys)
    n = day_number("date") + 1
    per_bucket = (df.where(F.col("date").isNotNull()).groupBy(*keys, F.bitmap_bucket_number(n).alias("bucket"))
                  .agg(F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias("b"), F.min("date").alias("first"), F.max("date").alias("last")))
    # The calendar bounds a key's buckets (one for 89 years).
    return per_bucket.groupBy(*keys).agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.sum(F.bitmap_count("b")).alias("n"),
        F.map_from_entries(F.collect_list(F.struct("bucket", "b"))).alias("days"))


def has_day(days: Column, date: Column) -> Column:
    """Whether a map of bitmaps holds a day."""
    n = day_number(date)
    bit = F.pmod(n, F.lit(BITMAP_DAYS))
    bitmap = F.try_element_at(days, F.floor(n / BITMAP_DAYS).cast("long") + 1)
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.floor(byte / F.pow(F.lit(2), F.pmod(bit, F.lit(8)))).cast("int") % 2 == 1, F.lit(False))


def _both(weather: DataFrame, pollution: DataFrame, keys: list[str]) -> DataFrame:
    """The bitmaps of both inputs for keys that have either's dates in both."""
    sides = [date_bitmaps(df, keys).withColumnsRenamed({c: f"{tag}_{c}" for c in ("first", "last", "n", "days")})
             for tag, df in (("w", weather), ("p", pollution))]
    return sides[0].join(sides[1], keys, "inner").withColumns({
        "overlap_start": F.greatest("w_first", "p_first"), "overlap_end": F.least("w_last", "p_last")})


def common_dates(a: DataFrame, b: DataFrame, keys=("site_id",)) -> DataFrame:
    """Dates present in both inputs."""
    keys = list(keys)
    both = _both(a, b, keys).select(*keys, "w_days", "p_days", calendar(F.col("overlap_start"), F.col("overlap_end")).alias("date"))
    return both.where(has_day(F.col("w_days"), F.col("date")) & has_day(F.col("p_days"), F.col("date"))).select(*keys, "date")


def overlap_ranges(weather: DataFrame, pollution: DataFrame, keys=("site_id",)) -> DataFrame:
    """Per-site overlap [max(min), min(max)] of the two date sets."""
    return _both(weather, pollution, list(keys)).select(*keys, "overlap_start", "overlap_end")


def missing_dates(weather: DataFrame, pollution: DataFrame, keys=("site_id",)) -> DataFrame:
    """Days of the per-site overlap that have no air-quality row: the
    calendar of the overlap, tested against the site's bitmap in place."""
    keys = list(keys)
    expected = _both(weather, pollution, keys).select(
        *keys, "p_days", calendar(F.col("overlap_start"), F.col("overlap_end")).alias("date"))
    return expected.where(~has_day(F.col("p_days"), F.col("date"))).select(*keys, "date")


def overlap_stats(weather: DataFrame, pollution: DataFrame, keys=("site_id",)) -> DataFrame:
    """Per-site distinct counts, ranges, common count, overlap and gap
    size, all counted on the bitmaps."""
    keys = list(keys)
    both = _both(weather, pollution, keys)
    in_overlap = F.when(F.col("overlap_start") <= F.col("overlap_end"),
                        F.sequence("overlap_start", "overlap_end")).otherwise(F.array().cast("array<date>"))
    # Days of both lie in the overlap, so its calendar counts them all.
    count = lambda test: F.size(F.filter("__days", test)).cast("long")
    return both.withColumn("__days", in_overlap).select(
        *keys, F.col("w_n").alias("weather_dates"), F.col("w_first").alias("weather_min"), F.col("w_last").alias("weather_max"),
        F.col("p_n").alias("pollution_dates"), F.col("p_first").alias("pollution_min"), F.col("p_last").alias("pollution_max"),
        count(lambda d: has_day(F.col("w_days"), d) & has_day(F.col("p_days"), d)).alias("common_dates"),
        "overlap_start", "overlap_end", F.size("__days").cast("long").alias("expected_days"),
        count(lambda d: ~has_day(F.col("p_days"), d)).alias("missing_days"))


def chunk_dates(dates: DataFrame, size: int = GAP_CHUNK_DAYS, keys=("site_id",)) -> DataFrame:
    """Split each site's sorted dates into runs of ``size`` → (start, end, n).

    The window is per site over distinct missing days, which the calendar
    bounds (at most one row per day).
    """
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy("date")
    ranked = dates.select(*keys, "date").withColumn(
        "chunk", F.floor((F.row_number().over(w) - 1) / size).cast("int"))
    return (ranked.groupBy(*keys, "chunk")
            .agg(F.min("date").alias("start_date"), F.max("date").alias("end_date"),
                 F.count(F.lit(1)).alias("n_days")))


def exact_mean(c: str, scale: int | None) -> Column:
    if scale is None:
        return F.avg(c)
    unit = float(10 ** scale)
    return (F.sum(F.rint(F.col(c) * F.lit(unit)).cast("long")).cast("double") / F.lit(unit)
            / F.count(c).cast("double"))


def hourly_to_daily(hourly: DataFrame, cols: Sequence[str], keys=("site_id",),
                    time_col: str = "time", scale: int | None = None) -> DataFrame:
    """A4: hourly rows → daily mean of every variable per (site, date).

    ``scale`` (decimal places of the measurements) makes the mean exact and
    order-independent; leave it None for a plain floating mean.
    """
    keys = list(keys)
    df = hourly.withColumn("date", parse_date(time_col))
    daily = df.groupBy(*keys, "date").agg(*[exact_mean(c, scale).alias(c) for c in cols])
    return daily.withColumnsRenamed({"pm2_5": "pm25", "us_aqi": "aqi"})


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the one with the greatest ``order`` tuple.

    Implemented as a ``max_by`` aggregate, so a hot key is reduced map-side
    (partial aggregation) instead of being sorted inside one task.
    """
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*payload), F.struct(*order)).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, "__best.*")


def gap_fill_merge(existing: DataFrame, fetched_daily: DataFrame, missing: DataFrame,
                   keys=("site_id",)) -> DataFrame:
    """J4 (keep fetched ∈ missing) → P3 align → U3 union → W4 newest wins
    → A5 median fill over the combined table (T20)."""
    keys = list(keys)
    new = fetched_daily.join(missing.select(*keys, "date"), keys + ["date"], "left_semi")
    cols = existing.columns
    new = new.select(*[F.col(c) if c in new.columns else F.lit(None).cast(existing.schema[c].dataType).alias(c)
                       for c in cols])
    combined = (existing.withColumn("__batch", F.lit(0))
                .unionByName(new.withColumn("__batch", F.lit(1))))
    merged = keep_last(combined, keys + ["date"], ["__batch"]).drop("__batch")
    rest = [c for c in cols if c not in keys and c != "date"]
    return median_fill(merged, rest, keys)


def still_missing(missing: DataFrame, fetched_daily: DataFrame, keys=("site_id",)) -> DataFrame:
    """Days still missing after a fill (report)."""
    keys = list(keys)
    return missing.join(date_set(fetched_daily, keys), keys + ["date"], "left_anti")

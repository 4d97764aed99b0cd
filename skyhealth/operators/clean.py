"""Cleaning operators.

Order matters and is preserved (T10, T11): full-row dedupe on the raw row,
rename, keep-list, date parse, critical-column drop, then median fill of
the remaining columns per site.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyhealth.functions.columns import keep_existing, nan_to_null
from skyhealth.operators.quantiles import exact_quantiles
from skyhealth.schemas import (POLLUTION_COLUMNS, POLLUTION_RENAMES,
                               WEATHER_COLUMNS, WEATHER_CRITICAL,
                               WEATHER_RENAMES)
from skyhealth.session import cut_lineage


def parse_date(c: Column | str) -> Column:
    """P5: coercing date parse (unparseable -> NULL). Timestamps with a zone
    suffix are normalised to UTC (session zone) before taking the date."""
    col = F.col(c) if isinstance(c, str) else c
    return F.to_date(F.try_to_timestamp(col))


def median_fill(df: DataFrame, cols: Iterable[str], keys=("site_id",),
                approximate: bool = False) -> DataFrame:
    """A5: replace NULLs by the per-key median of the column (exact,
    interpolated, NULL-skipping; ``approximate=True`` uses
    ``percentile_approx``).

    The exact medians are found by counting (``quantiles``), so no task holds
    the values of a key; they are joined back, one small row per key.
    """
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return df
    keys = list(keys)
    if approximate:
        meds = df.groupBy(*keys).agg(*[F.percentile_approx(c, 0.5).alias(f"__med_{c}") for c in cols])
    else:
        df = cut_lineage(df)                                    # read once a round of counting
        long = exact_quantiles(df, cols, [0.5], keys)
        meds = long.groupBy(*keys).agg(*[F.max(F.when(F.col("column_name") == c, F.col("q0"))).alias(f"__med_{c}") for c in cols])
    if not keys:
        whole = meds.select(F.struct("*")).scalar()
        return df.withColumns({c: F.coalesce(F.col(c), whole[f"__med_{c}"]) for c in cols})
    meds = meds.withColumnsRenamed({k: f"__key_{k}" for k in keys})
    same = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys])
    out = df.join(meds, same, "left")
    out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"__med_{c}")) for c in cols})
    return out.drop(*[f"__key_{k}" for k in keys], *[f"__med_{c}" for c in cols])


def clean_weather(raw: DataFrame, keys=("site_id",), fill: bool = True) -> DataFrame:
    """Raw weather (source names, tz-suffixed date string) -> clean daily weather.
    ``fill=False`` leaves the medians out, for uses that need the dates alone."""
    df = raw.dropDuplicates()                                   # W3 on the raw row
    df = df.withColumnsRenamed({k: v for k, v in WEATHER_RENAMES.items() if k in df.columns})
    df = keep_existing(df, list(keys) + ["date"] + WEATHER_COLUMNS)   # P2
    df = df.withColumn("date", parse_date("date"))              # P5
    df = nan_to_null(df)
    df = df.dropna(subset=[c for c in WEATHER_CRITICAL if c in df.columns])  # P6
    rest = [c for c in df.columns if c not in WEATHER_CRITICAL and c not in keys]
    return median_fill(df, rest, keys) if fill else df          # A5


def clean_pollution(raw: DataFrame, keys=("site_id",), fill: bool = True) -> DataFrame:
    """Raw air quality (pm2_5, us_aqi, ISO date string) -> clean daily air quality
    (``fill`` as in ``clean_weather``)."""
    df = raw.dropDuplicates()
    df = df.withColumnsRenamed({k: v for k, v in POLLUTION_RENAMES.items() if k in df.columns})
    df = keep_existing(df, list(keys) + ["date"] + POLLUTION_COLUMNS)
    df = df.withColumn("date", parse_date("date"))
    df = nan_to_null(df)
    df = df.dropna(subset=["date"])                             # P7
    rest = [c for c in df.columns if c != "date" and c not in keys]
    return median_fill(df, rest, keys) if fill else df


def typed_conversion(raw: DataFrame, types: Mapping[str, T.DataType],
                     row_id: str) -> tuple[DataFrame, DataFrame]:
    """Try-cast string columns; return (typed rows, rejects).

    A reject is a (row_id, column, raw_value) whose raw value is present but
    does not convert. Typed rows keep every input row with failed cells NULL;
    callers drop rejected rows with a left-anti join if they need to.
    """
    typed = raw.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})
    checks = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("raw_value"),
                       (F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias("bad"))
              for c, t in types.items()]
    rejects = (raw.select(F.col(row_id), F.explode(F.array(*checks)).alias("chk"))
               .where("chk.bad")
               .select(row_id, "chk.column_name", "chk.raw_value"))
    return typed, rejects

"""Date dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyhealth.operators.gaps import calendar
from skyhealth.operators.merge import missing_dimension_rows


def us_week(d: Column) -> Column:
    """T-SQL ``DATEPART(WEEK, d)`` with DATEFIRST 7: week 1 holds Jan 1,
    weeks start on Sunday."""
    return (F.floor((F.dayofyear(d) + F.dayofweek(F.trunc(d, "YEAR")) - 2) / 7) + 1).cast("int")


def date_attributes(dates: DataFrame, col: str = "date", week_mode: str = "us") -> DataFrame:
    """year, month, month name, quarter, week, weekday name, weekend flag."""
    d = F.col(col)
    week = us_week(d) if week_mode == "us" else F.weekofyear(d)
    return dates.select(
        d.alias("date"),
        F.year(d).alias("year"), F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"), week.alias("week"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"))


def dim_from_facts(*facts: DataFrame, existing: DataFrame | None = None,
                   week_mode: str = "us") -> DataFrame:
    """Dimension rows for every distinct fact date not already present
    (attributes always computed, T22)."""
    dates = None
    for f in facts:
        d = f.select("date").where(F.col("date").isNotNull())
        dates = d if dates is None else dates.unionByName(d)
    dates = dates.distinct()
    if existing is not None:
        dates = missing_dimension_rows(dates, existing)
    return date_attributes(dates, week_mode=week_mode)


def dim_full_range(*facts: DataFrame, week_mode: str = "us") -> DataFrame:
    """A gap-free calendar spanning every fact date (one row per day)."""
    bounds = None
    for f in facts:
        b = f.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
        bounds = b if bounds is None else bounds.unionByName(b)
    span = bounds.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return date_attributes(span.select(calendar(F.col("lo"), F.col("hi")).alias("date")),
                           week_mode=week_mode)

"""Schema-shaping column helpers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ensure_columns(df: DataFrame, spec: Mapping[str, tuple]) -> DataFrame:
    """Add every absent column as a typed literal: ``{name: (type, default)}``.

    Present columns are left untouched, so optional inputs never break a plan.
    """
    missing = {name: F.lit(default).cast(dtype)
               for name, (dtype, default) in spec.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df


def keep_existing(df: DataFrame, keep: Iterable[str]) -> DataFrame:
    """Keep-list projection that ignores names the frame does not have."""
    return df.select(*[c for c in keep if c in df.columns])


def nan_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """NaN -> NULL on floating columns so rules see one kind of missing."""
    targets = cols if cols is not None else [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in targets})


def zero_fill(df: DataFrame, cols: Iterable[str], value: float = 0.0) -> DataFrame:
    """NULL -> value, and absent column -> value."""
    cols = list(cols)
    df = ensure_columns(df, {c: (T.DoubleType(), value) for c in cols})
    return df.fillna(value, subset=cols)


def or_default(c: str | Column, default: float) -> Column:
    """Python ``x or d`` on a number: NULL and 0 both become ``d``."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.nullif(col, F.lit(0)), F.lit(default))


def clip(c: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def round_half_even(c: Column, digits: int) -> Column:
    """Half-even rounding of a double the way NumPy/pandas ``.round`` does it:
    scale, round to the nearest even integer (``rint``), unscale.

    Spark's ``bround`` instead rounds the shortest decimal representation, so
    the two disagree on values whose binary expansion sits just off a
    decimal tie; this helper keeps the binary semantics of the reference.
    """
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def stable_round(c: Column, digits: int, guard: int = 10) -> Column:
    """Round an aggregate whose last bits depend on summation order.

    First snap to ``guard`` decimals (absorbs order-dependent ulp noise, so
    every engine/partitioning sees the same double), then round half-even to
    ``digits``. Exact decimal ties are then decided identically everywhere.
    """
    return round_half_even(round_half_even(c, guard), digits)


def round_half_away(c: Column, digits: int) -> Column:
    """Half-away-from-zero rounding on the scaled binary value (the
    ``ROUND`` of report tools and C's ``round``), matching ``round_half_even``'s
    scale-then-round approach rather than Spark's decimal-string ``round``."""
    scale = float(10 ** digits)
    scaled = c * F.lit(scale)
    return F.signum(scaled) * F.floor(F.abs(scaled) + F.lit(0.5)) / F.lit(scale)

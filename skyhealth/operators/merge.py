"""Table maintenance as DataFrame algebra.

Each function returns the *new table content* (or the rows to append);
persisting it is :mod:`skyhealth.sources.tables`' job (staged overwrite or
append). Keys always include ``site_id``. Latest-wins selections are
``max_by`` aggregates, so a hot key is reduced map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyhealth.functions.constants import LIVE_SOURCE
from skyhealth.operators.gaps import keep_last


def is_live(source: str = "source") -> Column:
    """source = 'api_daily' (NULL-safe: NULL is not live)."""
    return F.col(source).eqNullSafe(F.lit(LIVE_SOURCE))


def partial_refresh(current: DataFrame, new_historical: DataFrame) -> DataFrame:
    """K4: delete every non-live row (source NULL or <> 'api_daily'), insert
    the new historical rows, keep live rows."""
    kept = current.where(is_live())
    return kept.unionByName(new_historical, allowMissingColumns=True)


def rows_to_insert(new: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is absent from ``target``. A plain
    anti-join on the key; AQE broadcasts whichever side turns out small."""
    return new.join(target.select(*keys), list(keys), "left_anti")


def insert_if_absent(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K5: idempotent append; running it twice equals running it once."""
    return target.unionByName(rows_to_insert(new, target, keys), allowMissingColumns=True)


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
           order: Sequence[str] | None = None) -> DataFrame:
    """K6: MERGE on ``keys`` — matched rows take the update's values in the
    columns the update has and keep the others, unmatched updates are inserted,
    other target rows stay.

    Several updates for one key: the greatest ``order`` tuple wins (default:
    the last one by an explicit ordinal the caller supplies).
    """
    order = list(order or [])
    rest = [c for c in target.columns if c not in updates.columns]
    both = target.withColumn("__prio", F.lit(0)).unionByName(
        updates.withColumn("__prio", F.lit(1)), allowMissingColumns=True)
    if not rest:
        return keep_last(both, keys, ["__prio"] + order).drop("__prio")
    listed = [c for c in both.columns if c not in (*keys, *rest, "__prio")]
    merged = both.groupBy(*keys).agg(
        F.max_by(F.struct(*listed), F.struct("__prio", *order)).alias("l"),
        F.max_by(F.struct(*rest), F.when(F.col("__prio") == 0, F.struct("__prio", *order))).alias("r"))
    return merged.select(*keys, "l.*", "r.*").select(*[c for c in both.columns if c != "__prio"])


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """K9: DELETE ... WHERE predicate (a NULL predicate keeps the row)."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def copy_table(df: DataFrame, drop: Sequence[str] = ("id", "date_id")) -> DataFrame:
    """K7: full copy without surrogate columns."""
    return df.drop(*drop)


def prefer_source(historical: DataFrame, live: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, live beats historical."""
    both = (historical.withColumn("__prio", F.lit(0))
            .unionByName(live.withColumn("__prio", F.lit(1)), allowMissingColumns=True))
    return keep_last(both, keys, ["__prio"]).drop("__prio")


def missing_dimension_rows(fact: DataFrame, dim: DataFrame, fact_key: str = "date",
                           dim_key: str = "date") -> DataFrame:
    """Distinct fact keys with no dimension row."""
    keys = fact.select(F.col(fact_key).alias(dim_key)).where(F.col(dim_key).isNotNull()).distinct()
    return keys.join(dim.select(dim_key), dim_key, "left_anti")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key (``ROW_NUMBER() ... = 1`` as a max_by aggregate)."""
    return keep_last(df, keys, order)


def purge_superseded(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """DELETE rows with rn > 1 — the surviving content equals W1."""
    return keep_last(df, keys, order)

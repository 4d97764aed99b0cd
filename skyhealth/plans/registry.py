"""Registry of named queries and their SQL oracles.

``@register(name, sql)`` records a ``(spark, sf_dir) -> DataFrame`` callable
and, when given, the equivalent DuckDB SQL over the raw driver tables.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark, sf_dir):
            # The engine's contract is a UTC session (dates of epoch slots,
            # timestamp rendering); enforce it for callers' own sessions.
            if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
                spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from skyhealth.plans import (q_clean, q_daily, q_dims, q_forecast,  # noqa: F401
                                 q_gaps, q_marts, q_merge, q_ml, q_quality,
                                 q_rules, q_slots, q_stream, q_windows)

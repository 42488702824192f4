"""Registered queries: one Spark builder and (where SQL can say it) one DuckDB oracle
per operator id of the survey.  Every query reads the given tables and runs
over whole tables; outputs go through ``finalize`` (6-decimal rounding, dates
as text) and the oracle SQL applies the same rounding with ``R``/``D``.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all():
    """Import the modules that register queries."""
    from . import q_clean, q_core, q_dims, q_eval, q_linear, q_more, q_rules  # noqa: F401
    return QUERIES, ORACLE

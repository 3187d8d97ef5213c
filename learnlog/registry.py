"""Named queries over the driver's tables, each paired with a DuckDB oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL``.
Names are the operator ids of the survey's inventory. Every query reads the
whole tables; oracle SQL is written independently of the Spark code (plain
window functions, joins and aggregates over the same views).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    import importlib
    for mod in MODULES:
        importlib.import_module(f"{__package__}.plans.{mod}")


MODULES = ["q_sources", "q_relational", "q_joins", "q_stats", "q_history", "q_lectures",
           "q_splits", "q_scalars", "q_encoders", "q_state", "q_model", "q_streaming"]

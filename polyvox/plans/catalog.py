"""Query catalogue: name -> (Spark DataFrame builder, DuckDB oracle SQL).

Every builder takes ``(spark, sf_dir)``, reads the driver tables through the
adapter views and returns a lazy DataFrame over the whole tables. The
oracle (when present) is SQL over the same parquet tables; column names
match the Spark result exactly.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from polyvox.plans.oracle import with_views


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: str


REGISTRY: dict[str, Query] = {}


def query(name: str, ops: str, sql: str | None = None, extra_views: dict | None = None):
    """Register a query; ``sql`` gets the adapter CTEs it names prepended."""
    def deco(fn):
        REGISTRY[name] = Query(name, fn, with_views(sql, extra_views) if sql else None, ops)
        return fn
    return deco


MODULES = ["q_relational", "q_moderation", "q_text", "q_topics", "q_render", "q_models",
           "q_streaming"]


def load_all() -> dict[str, Query]:
    """Import every query module (importing registers its queries)."""
    import importlib
    for m in MODULES:
        try:
            importlib.import_module(f"polyvox.plans.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"polyvox.plans.{m}":
                raise
    return REGISTRY

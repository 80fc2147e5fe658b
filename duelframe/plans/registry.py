"""Named queries: a Spark builder plus (optionally) the DuckDB oracle text.

Every builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame that
reads the given tables through the contest views.  The oracle is the same
query in SQL over the same tables; queries whose result depends on a model
fit or a seed carry no oracle (they are pinned by invariant tests).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    ops: tuple[str, ...]   # SURVEY section 2 ids covered
    doc: str


REGISTRY: dict[str, Query] = {}


def query(name: str, ops: str, sql: str | None = None):
    """Register a builder under ``name``; ``ops`` lists the operator ids."""
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, tuple(ops.split()), (fn.__doc__ or "").strip())
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # importing the modules registers their queries
    from duelframe.plans import (  # noqa: F401
        q_engineering, q_profile, q_reports, q_history, q_learning_prep, q_metrics,
        q_unsupervised, q_neighbours, q_supervised, q_io, q_jobs,
    )
    return REGISTRY

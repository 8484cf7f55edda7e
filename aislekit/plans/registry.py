"""Registry of named queries and their SQL oracles."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from aislekit.sources.adapters import with_views
from aislekit.sources.tables import Tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}

_MODULES = (
    "aislekit.plans.profile_q",
    "aislekit.plans.functions_f",
    "aislekit.plans.contracts_v",
    "aislekit.plans.checks_x",
    "aislekit.plans.lookups_j",
    "aislekit.plans.inventory_i",
    "aislekit.plans.history_d",
    "aislekit.plans.basket_b",
    "aislekit.plans.bundles_u",
    "aislekit.plans.campaigns_c",
    "aislekit.plans.clickstream_k",
    "aislekit.plans.faults_e",
    "aislekit.plans.sources_s",
    "aislekit.plans.extended",
    "aislekit.plans.click_faults_e",
    "aislekit.plans.contracts_all",
    "aislekit.plans.cart_k",
    "aislekit.plans.affinity_b",
    "aislekit.plans.detect_t",
    "aislekit.plans.sources_all",
)


def query(name: str, views=(), sql: str | None = None, ctes: dict[str, str] | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with its oracle."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        oracle = with_views(tuple(views), sql, ctes) if sql is not None else None
        QUERIES[name] = Query(name, fn, oracle)
        return fn

    return deco


def _load_all() -> None:
    for m in _MODULES:
        try:
            importlib.import_module(m)
        except ModuleNotFoundError as e:
            if e.name != m:
                raise


_TABLES: dict[tuple[str, int, str], Tables] = {}


def tables_for(spark: SparkSession, sf_dir: str) -> Tables:
    key = (spark.sparkContext.applicationId, id(spark), sf_dir)
    if key not in _TABLES:
        _TABLES[key] = Tables(spark, sf_dir)
    return _TABLES[key]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()

    def bind(q: Query):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return q.build(tables_for(spark, sf_dir))

        run.__name__ = q.name
        run.__doc__ = q.build.__doc__
        return run

    return {n: bind(q) for n, q in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {n: q.sql for n, q in QUERIES.items() if q.sql is not None}

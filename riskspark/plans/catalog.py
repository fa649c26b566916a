"""Registry of named queries: ``key -> (spark, sf_dir) -> DataFrame`` plus its oracle SQL.

Every entry reads the driver tables at ``sf_dir`` (through ``Domain``), so
its work grows with the data. Oracle bodies sit next to the Spark code they
check; ``riskspark.plans.oracle.BINDING_SQL`` is prefixed to each.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from riskspark.plans.oracle import BINDING_SQL
from riskspark.sources.bindings import Domain


@dataclass(frozen=True)
class Entry:
    key: str
    build: Callable[[Domain], DataFrame]
    sql: str | None


REGISTRY: dict[str, Entry] = {}
# Domains per live session object: a stopped and recreated session is a new
# key, and entries vanish with their session.
_DOMAINS: "weakref.WeakKeyDictionary[SparkSession, dict[str, Domain]]" = weakref.WeakKeyDictionary()


def register(key: str, sql: str | None):
    def wrap(fn: Callable[[Domain], DataFrame]):
        if key in REGISTRY:
            raise KeyError(f"duplicate query key {key}")
        REGISTRY[key] = Entry(key, fn, sql)
        return fn
    return wrap


def domain(spark: SparkSession, sf_dir: str) -> Domain:
    """The session's Domain for ``sf_dir`` (reused, so table schemas are read once per session)."""
    per_session = _DOMAINS.setdefault(spark, {})
    if sf_dir not in per_session:
        per_session[sf_dir] = Domain(spark, sf_dir)
    return per_session[sf_dir]


def run(key: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    _load_all()
    return REGISTRY[key].build(domain(spark, sf_dir))


def query_callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {k: (lambda spark, sf_dir, _k=k: run(_k, spark, sf_dir)) for k in REGISTRY}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: BINDING_SQL + e.sql for k, e in REGISTRY.items() if e.sql is not None}


def _load_all() -> None:
    # Importing the modules runs their @register decorators.
    from riskspark.plans import registry_core, registry_derived  # noqa: F401

"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the whole test tables (through ``sources.fixtures``) and
returns the output of one operator or job with DECIMALs cast to DOUBLE.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.columns import decimals_to_double
from ..session import apply_defaults
from ..sources.fixtures import RUN_DATE, Tables

REGISTRY: dict[str, Callable[[Tables], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import queries as _q, window_queries as _w  # noqa: F401  (fill REGISTRY)

    def bind(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_defaults(spark)
            return decimals_to_double(fn(Tables(spark, sf_dir)))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run
    return {k: bind(v) for k, v in REGISTRY.items()}


__all__ = ["register", "queries", "RUN_DATE"]

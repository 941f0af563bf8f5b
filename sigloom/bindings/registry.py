"""Query registry: name -> Spark callable, and name -> reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sigloom.session import compiled_methods

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register `fn(views)`; it is called with the views of one data folder."""

    def wrap(fn):
        from sigloom.bindings.views import Views

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            compiled_methods(spark)
            return fn(Views(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap

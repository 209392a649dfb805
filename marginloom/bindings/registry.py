"""Query registry: Spark builder plus, where expressible, the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marginloom.bindings.frames import Frames
from marginloom.session import configure

BUILDERS: dict[str, Callable[[Frames], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def register(fn: Callable[[Frames], DataFrame]):
        key = name or fn.__name__
        if key in BUILDERS:
            raise ValueError(f"duplicate query {key}")
        BUILDERS[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return register


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Frames(configure(spark), sf_dir))
        return run
    return {k: bind(f) for k, f in BUILDERS.items()}

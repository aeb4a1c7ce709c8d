"""Queries by name, each with the SQL text that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from ledgerlark.tables import Warehouse


class Plan(NamedTuple):
    build: Callable[[Warehouse], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Warehouse(spark, folder))


REGISTRY: dict[str, Plan] = {}


def plan(name: str, sql: str | None = None):
    """Register a function from ``Warehouse`` to DataFrame."""

    def add(build: Callable[[Warehouse], DataFrame]):
        if name in REGISTRY:
            raise KeyError(f"{name} is registered twice")
        REGISTRY[name] = Plan(build, sql)
        return build

    return add

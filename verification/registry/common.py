"""Registration helper: one Spark form and one SQL form per name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from verification.tables import Tables


class Registry:
    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, build: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
        self.queries[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            self.sql[name] = sql

"""Named queries over the benchmark tables and, where one exists, the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """``t.orders`` reads the table; Catalyst prunes columns and pushes filters into that scan."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = prepare(spark), root

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def spread(self, name: str) -> DataFrame:
        """A table for work that costs far more than its scan and a shuffle of its rows: dealt out evenly before it."""
        return getattr(self, name).repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")))


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, root: build(Tables(spark, root))
        if sql:
            ORACLES[name] = sql
        return build

    return register

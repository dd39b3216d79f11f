"""Where query modules register."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skyledger.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables of one scale folder, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder.rstrip('/')}/{name}.parquet")


def query(name: str, oracle: str | None = None):
    """Register a function of `Tables`; `oracle` is the same answer in plain SQL."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(tune(spark), folder))

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return build

    return register

"""Registration of queries and access to the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """``t.orders`` is the orders table of one benchmark folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def dealt(df: DataFrame) -> DataFrame:
    """Rows dealt out to all cores if the scan has fewer splits, for work that costs more than its rows.

    A benchmark table is one row group, which one task reads; large tables have splits enough.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def query(name: str, sql: str | None = None):
    """Register ``f(t: Tables) -> DataFrame`` under a name, with the SQL giving the same rows."""

    def add(f: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            # the benchmark tables hold wall-clock times; the SQL side reads them as UTC
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return f(Tables(spark, folder))

        run.__name__, run.__doc__ = name, f.__doc__
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add

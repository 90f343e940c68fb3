"""Where intermediate and published tables are written."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SCRATCH = "civiclake_scratch"
_LOCAL_FALLBACK: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; a cluster without it
    is an error, since a machine-local folder would vanish with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK[app] = tempfile.mkdtemp(prefix="civiclake-")
    return _LOCAL_FALLBACK[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has written to yet."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write once, go on from the files: cuts lineage and pins values such as partition ids."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_buckets(df: DataFrame, label: str, column: str, buckets: int) -> DataFrame:
    """Write once into a table of ``buckets`` by the hash of a column, to be joined by it without a shuffle.

    The rows stay where they are: each task writes one file for each bucket it has rows of.
    """
    spark = df.sparkSession
    if not spark.catalog.databaseExists(SCRATCH):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {SCRATCH} LOCATION '{fresh_path(spark, SCRATCH)}'")
    name = f"{SCRATCH}.{re.sub(r'[^a-z0-9]', '_', label)}_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(buckets, column).saveAsTable(name)
    return spark.table(name)

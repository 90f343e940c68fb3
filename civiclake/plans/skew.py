"""How many rows of a key one task may hold, and how large a broadcast may be."""

from __future__ import annotations

from pyspark.sql import SparkSession

HOT_ROWS_CONF = "civiclake.hotKeyRows"
HOT_ROWS_DEFAULT = 20_000_000
QUANTILE_ROWS_CONF = "civiclake.quantileBufferRows"
QUANTILE_ROWS_DEFAULT = 1_000_000
BROADCAST_BYTES_CONF = "civiclake.maxBroadcastBytes"
BROADCAST_BYTES_DEFAULT = 64 * 1024 * 1024


def hot_row_limit(spark: SparkSession) -> int:
    """Rows of one key that one task may still sort; above it a key is split."""
    return int(spark.conf.get(HOT_ROWS_CONF, str(HOT_ROWS_DEFAULT)))


def quantile_row_limit(spark: SparkSession) -> int:
    """Rows of one group whose values may be held in one aggregation buffer."""
    return int(spark.conf.get(QUANTILE_ROWS_CONF, str(QUANTILE_ROWS_DEFAULT)))


def broadcast_limit(spark: SparkSession) -> int:
    return int(spark.conf.get(BROADCAST_BYTES_CONF, str(BROADCAST_BYTES_DEFAULT)))

"""Is there anything new at the source? Answered for all tables at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclake.operators.history import last_kept, latest_per


def checked_sources(sources: DataFrame, prior_checks: DataFrame) -> DataFrame:
    """Fill the availability flags of the current check of every table.

    A table never pulled counts as having new data and metadata. Otherwise something is new when
    the source changed after the latest check that pulled; a source without a date is not new.
    When nothing is new, ``data_pulled_this_check`` is false, else it is still open (NULL).
    """
    pulls = (
        prior_checks.where(F.col("data_pulled_this_check"))
        .groupBy(F.col("table_id").alias("__id"))
        .agg(F.max("time_of_check").alias("__pulled"))
    )
    joined = sources.join(pulls, F.col("table_id") == F.col("__id"), "left")

    def newer(updated: str) -> Column:
        after = F.coalesce(F.col(updated) > F.col("__pulled"), F.lit(False))
        return F.col("__pulled").isNull() | after

    data, meta = newer("source_data_last_updated"), newer("source_metadata_last_updated")
    return joined.withColumns(
        {
            "updated_data_available": data,
            "updated_metadata_available": meta,
            "data_pulled_this_check": F.when(~data & ~meta, F.lit(False)),
        }
    ).drop("__id", "__pulled")


def latest_checks(checks: DataFrame, dataset: str = "dataset_name",
                  modified: str = "source_data_last_modified") -> DataFrame:
    """One successful local check per dataset and source date: the most recent."""
    done = checks.where(F.col("local_data_updated"))
    return latest_per(done, [dataset, modified], ["time_of_check"])


def stale_datasets(sources: DataFrame, local: DataFrame, name: str = "dataset_name",
                   modified: str = "source_data_last_modified") -> DataFrame:
    """``needs_refresh`` per source dataset: no local copy, or one older than the source."""
    have = local.groupBy(F.col(name).alias("__name")).agg(F.max(modified).alias("local_modified"))
    joined = sources.join(have, F.col(name) == F.col("__name"), "left").drop("__name")
    current = F.coalesce(F.col("local_modified") >= F.col(modified), F.lit(False))
    return joined.withColumn("needs_refresh", ~current)


def changed_listing(listing: DataFrame, cache: DataFrame, url: str = "metadata_url",
                    modified: str = "last_modified") -> DataFrame:
    """Listed entries with ``updated_metadata_available``: unknown so far, or newer than cached.

    A listing is keyed by URL; the cache keeps its last row per URL.
    """
    known = last_kept(cache.select(url, modified), [url], [modified]).select(
        F.col(url).alias("__url"), F.col(modified).alias("__cached")
    )
    joined = listing.join(known, F.col(url) == F.col("__url"), "left")
    newer = F.coalesce(F.col(modified) > F.col("__cached"), F.lit(False))
    return joined.withColumn(
        "updated_metadata_available", F.col("__cached").isNull() | newer
    ).drop("__url", "__cached")


def cached_and_source(listing: DataFrame, cache: DataFrame, key: str, column: str) -> DataFrame:
    """Left join keeping both sides' value of one column as ``<column>_source`` / ``_cache``."""
    left = listing.withColumnRenamed(column, f"{column}_source")
    right = cache.select(F.col(key).alias("__key"), F.col(column).alias(f"{column}_cache"))
    return left.join(right, F.col(key) == F.col("__key"), "left").drop("__key")


def next_action(exists: Column, fresh: Column) -> Column:
    """What a refresh does with a table."""
    return (
        F.when(~F.coalesce(fresh, F.lit(False)), "skip")
        .when(F.coalesce(exists, F.lit(False)), "update_table")
        .otherwise("create_table")
    )


def any_and_all(df: DataFrame, flag: str) -> DataFrame:
    return df.agg(F.bool_or(flag).alias("any_true"), F.bool_and(flag).alias("all_true"))

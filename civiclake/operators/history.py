"""Previous values along time: lag per entity, and what is computed from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civiclake.functions.columns import nulls_first_desc, nulls_last, rank_struct, same_row
from civiclake.plans.skew import hot_row_limit


def with_previous(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    previous: dict[str, str],
    hot_limit: int | None = None,
) -> DataFrame:
    """Add ``{new_name: column}`` holding that column's value in the key's previous row.

    Rows are ordered by ``order`` ascending, NULL last; give it a unique last column to make
    equal dates deterministic. All lags share one window, so one shuffle and one sort.

    A window puts all rows of a key into one task. Keys with more than ``hot_limit`` rows are
    therefore cut into ordered slices (see ``_sliced_previous``). Which they are is found as the plan runs;
    where there are none, Spark drops that branch.
    """
    limit = hot_row_limit(df.sparkSession) if hot_limit is None else hot_limit
    of = [f"__of_{k}" for k in keys]
    counted = df.groupBy(*[F.col(k).alias(o) for k, o in zip(keys, of)]).agg(F.count(F.lit(1)).alias("__key_rows"))
    # at most one row for each ``limit`` rows of the table
    hot = F.broadcast(counted.where(F.col("__key_rows") > limit).select(*of))
    same = same_row(df, hot, keys, of)
    cold_rows, hot_rows = (df.join(hot, same, how) for how in ("left_anti", "left_semi"))
    return _windowed_previous(cold_rows, keys, order, previous).unionByName(
        _sliced_previous(hot_rows, keys, order, previous)
    )


def _windowed_previous(df, keys, order, previous):
    w = Window.partitionBy(*keys).orderBy(*[nulls_last(o) for o in order])
    return df.withColumns({new: F.lag(c, 1).over(w) for new, c in previous.items()})


def _sliced_previous(df, keys, order, previous):
    """Lag over keys too big for one task.

    The rows are range-partitioned by (keys, order), so each partition is a consecutive slice of
    some key. Within a slice the lag is a plain window. A second window holds the first and the last row of all
    slices of a key, where the row before a first one is the last of the slice before; the
    other rows pass it in the groups of their slices. Rows learn their slice once and keep it, so
    nothing depends on how an evaluation of the ranges would turn out a second time.
    """
    ordered = [nulls_last(o) for o in order]
    by = [*[F.col(k).asc_nulls_last() for k in keys], *ordered]
    cut = df.repartitionByRange(*by).withColumn("__slice", F.spark_partition_id())
    in_slice = Window.partitionBy(*keys, "__slice").orderBy(*ordered)
    local = cut.withColumns(
        {
            "__rn": F.row_number().over(in_slice),
            "__more": F.lead(F.lit(True), 1, False).over(in_slice),
            **{f"__in_{new}": F.lag(c, 1).over(in_slice) for new, c in previous.items()},
        }
    )
    first = F.col("__rn") == 1
    place = F.when(first | ~F.col("__more"), F.lit(-1)).otherwise(F.col("__slice"))
    across = Window.partitionBy(*keys, "__place").orderBy("__slice", "__rn")
    carried = {
        new: F.when(first, F.lag(c, 1).over(across)).otherwise(F.col(f"__in_{new}")) for new, c in previous.items()
    }
    return local.withColumn("__place", place).withColumns(carried).select(*df.columns, *previous)


def with_changes(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    columns: list[str],
    hot_limit: int | None = None,
) -> DataFrame:
    """Add ``<column>_change`` = value minus the key's previous value, for each column."""
    previous = {f"__last_{c}": c for c in columns}
    out = with_previous(df, keys, order, previous, hot_limit)
    changes = {f"{c}_change": F.col(c) - F.col(f"__last_{c}") for c in columns}
    return out.withColumns(changes).drop(*previous)


def latest_per(df: DataFrame, keys: list[str], newest_first: list[str]) -> DataFrame:
    """The row with the greatest ``newest_first`` columns of each key (NULL counts as greatest)."""
    w = Window.partitionBy(*keys).orderBy(*[nulls_first_desc(c) for c in newest_first])
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def last_kept(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Sort ascending by ``order`` and keep the last row per key; NULL sorts last, so it is kept."""
    return latest_per(df, keys, order)


def all_but_newest(df: DataFrame, keys: list[str], newest_first: list[str], keep: int) -> DataFrame:
    """Rows that are not among the ``keep`` newest of their key.

    The n-th newest row per key is found first (Spark limits each partition to ``keep`` rows
    per key before the shuffle); all rows are then only compared with that one row.
    """
    w = Window.partitionBy(*keys).orderBy(*[nulls_first_desc(c) for c in newest_first])
    edge = (
        df.select(*keys, *newest_first)
        .withColumn("__rn", F.row_number().over(w))
        .where(F.col("__rn") <= keep)
        .groupBy(*[F.col(k).alias(f"__of_{k}") for k in keys])
        .agg(F.min(rank_struct(*newest_first)).alias("__edge"), F.count("*").alias("__held"))
        .where(F.col("__held") == keep)
    )
    older = rank_struct(*newest_first) < F.col("__edge")
    for k in keys:
        older = older & F.col(k).eqNullSafe(F.col(f"__of_{k}"))
    return df.join(edge, older, "left_semi")

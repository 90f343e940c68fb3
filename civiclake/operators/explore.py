"""Questions asked of a table while getting to know it, and the aggregates behind charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiclake.functions.columns import ColumnLike, as_column, same_row
from civiclake.functions.dates import month_label, month_start_of_label
from civiclake.operators.quantiles import COUNT, VALUE, exact_quantiles


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def distinct_count(df: DataFrame, column: str, approximate: bool = False) -> DataFrame:
    """Number of distinct non-NULL values."""
    c = F.approx_count_distinct(column) if approximate else F.countDistinct(column)
    return df.agg(c.alias("distinct_count"))


def distinct_rows_count(df: DataFrame, *columns: str) -> DataFrame:
    """Number of distinct combinations, a NULL counting as a value."""
    return df.select(*columns).distinct().agg(F.count(F.lit(1)).alias("distinct_count"))


def value_counts(
    df: DataFrame, column: str, ascending: bool = True, with_length: bool = False
) -> DataFrame:
    """Rows per value, ordered by their number."""
    out = df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    if with_length:
        out = out.withColumn("n_chars", F.length(F.col(column)))
    first = F.asc("row_count") if ascending else F.desc("row_count")
    return out.orderBy(first, F.col(column).asc_nulls_last())


def counts_by_hour(df: DataFrame, ts: str) -> DataFrame:
    return (
        df.groupBy(F.hour(ts).alias("date_hour"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy("date_hour")
    )


def surplus_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first of each key: 0 means the columns identify a record."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"))


def rows_sharing_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows whose key occurs more than once (NULL keys match nothing).

    Repeated keys are found by a partially aggregated count; the rows are then filtered by a
    semi join, which adaptive execution splits when one key holds very many rows.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    return df.join(repeated.select(*keys), keys, "left_semi")


def version_counts(df: DataFrame, published: str = "source_data_updated") -> DataFrame:
    """How many new or changed rows each publication brought."""
    return df.groupBy(published).agg(F.count(F.lit(1)).alias("row_count")).orderBy(published)


def monthly_stats(
    df: DataFrame, day: str, value: str, hot_limit: int | None = None
) -> DataFrame:
    """Count, max, rounded mean, min and exact median of a value per 'yyyy-MM' month."""
    rows = df.select(month_label(day).alias("month"), F.col(value).alias("value"))
    n, v = F.col(COUNT), F.col(VALUE)
    amount = v if isinstance(rows.schema["value"].dataType, T.DecimalType) else v.cast("double")
    known = F.sum(F.when(v.isNotNull(), n))
    simple = [
        F.coalesce(known, F.lit(0)).alias("num_values"),
        F.max(v).alias("max_value"),
        F.round(F.sum(amount * n) / known).cast("bigint").alias("mean_value"),
        F.min(v).alias("min_value"),
    ]
    stats = exact_quantiles(rows, ["month"], "value", [0.5], "__q", hot_limit, also=simple)
    return stats.withColumn("median_value", F.get("__q", 0)).drop("__q")


def months_between_busy_ends(df: DataFrame, day: str, at_least: int = 5) -> DataFrame:
    """Every month start from the first to the last month that has ``at_least`` rows."""
    counts = df.groupBy(month_label(day).alias("month")).agg(F.count(F.lit(1)).alias("n"))
    ends = counts.where(F.col("n") >= at_least).agg(
        month_start_of_label(F.min("month")).alias("first"),
        month_start_of_label(F.max("month")).alias("last"),
    )
    series = F.sequence("first", "last", F.expr("interval 1 month"))
    return ends.where(F.col("first").isNotNull()).select(F.explode(series).alias("month_start"))


def dense_monthly_stats(df: DataFrame, day: str, value: str, at_least: int = 5) -> DataFrame:
    """Monthly statistics on the evenly spaced months; empty months are kept with a count of 0."""
    months = months_between_busy_ends(df, day, at_least)
    stats = monthly_stats(df, day, value)
    joined = months.withColumn("month", month_label("month_start")).join(stats, "month", "left")
    return joined.withColumn("num_values", F.coalesce("num_values", F.lit(0)))


def _metric(kind: str, column: ColumnLike) -> Column:
    c = F.lit(1) if column == "*" else as_column(column)
    simple = {
        "MIN": F.min,
        "MAX": F.max,
        "COUNT": F.count,
        "COUNT_DISTINCT": F.countDistinct,
        "AVG": F.avg,
        "SUM": F.sum,
    }
    if kind.upper() not in simple:
        raise ValueError(f"unknown metric {kind}; use one of {sorted(simple)}, MEDIAN or a Column")
    return simple[kind.upper()](c)


def metric_query(
    df: DataFrame,
    metrics: dict[str, tuple[str, ColumnLike] | Column],
    dimensions: dict[str, ColumnLike] | None = None,
    filters: Column | None = None,
    time: ColumnLike | None = None,
    grain: str | None = None,
) -> DataFrame:
    """A chart's numbers: filter, slice by time grain and dimensions, aggregate.

    ``metrics`` maps a name to (kind, column) or to any aggregate Column. MEDIAN is exact and
    computed apart from the others, so that no group has to fit into one task.
    """
    rows = df if filters is None else df.where(filters)
    groups = dict(dimensions or {})
    if time is not None:
        groups = {"period": F.date_trunc(grain or "day", as_column(time)), **groups}
    medians = {
        n: m[1] for n, m in metrics.items() if isinstance(m, tuple) and m[0].upper() == "MEDIAN"
    }
    others = {
        n: m if isinstance(m, Column) else _metric(*m)
        for n, m in metrics.items()
        if n not in medians
    }
    names = list(groups)
    keyed = rows.select(
        "*",
        *[as_column(c).alias(f"__g{i}") for i, c in enumerate(groups.values())],
    )
    by = [F.col(f"__g{i}").alias(n) for i, n in enumerate(names)]
    parts = []
    if others or not medians:
        aggs = [m.alias(n) for n, m in others.items()] or [F.count(F.lit(1)).alias("row_count")]
        parts.append(keyed.groupBy(*by).agg(*aggs))
    for n, c in medians.items():
        values = keyed.select(*by, as_column(c).alias("__value"))
        q = exact_quantiles(values, names, "__value", [0.5], "__q")
        parts.append(q.select(*names, F.get("__q", 0).alias(n)))
    out = parts[0]
    for other in parts[1:]:
        if not names:
            out = out.crossJoin(F.broadcast(other))  # one row each
            continue
        renamed = other.withColumnsRenamed({n: f"__r_{n}" for n in names})
        same = same_row(out, renamed, names, [f"__r_{n}" for n in names])
        out = out.join(renamed, same, "left").drop(*[f"__r_{n}" for n in names])
    return out.select(*names, *metrics)

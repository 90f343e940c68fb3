"""Exact interpolated quantiles that never hold a large group in one task.

The values of each group are counted once, by value; all further steps read that one shuffle. Spark's ``percentile``,
which keeps the distinct values of a group in one buffer, serves groups of ordinary size. In larger
ones the wanted ranks are selected by radix: doubles become integers of the same order, some 20 bits
at a time are counted per group, and only values that share the bits found so far go on. Which groups are large
is part of the plan, not a job before it; where there are none, Spark drops the other branch as it runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclake.functions.columns import same_row
from civiclake.plans.skew import quantile_row_limit

#: Bits found in each round; a window holds at most 2^22 rows.
DIGITS = (22, 21, 21)
MANTISSA = 1 << 52
BIAS = 1023
VALUE, COUNT = "__value", "__n"


def exact_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    probabilities: list[float],
    name: str = "quantiles",
    hot_limit: int | None = None,
    also: Sequence[Column] = (),
) -> DataFrame:
    """keys + ``name`` array<double>, interpolated between neighbours (percentile_cont).

    ``also`` are further aggregates of each group, over its distinct values (column ``VALUE``) and how
    often each occurs (column ``COUNT``). NULL values are left out, but a group of NULLs keeps its row;
    without keys there is one row, also for an empty table.
    """
    limit = quantile_row_limit(df.sparkSession) if hot_limit is None else hot_limit
    by = keys or ["__all"]
    group = [F.col(k) for k in keys] or [F.lit(1).alias("__all")]
    rows = df.select(*group, F.col(value).alias(VALUE))
    counted = rows.groupBy(*by, VALUE).agg(F.count(F.lit(1)).alias(COUNT))
    v = F.col(VALUE).cast("double")
    known = F.coalesce(F.sum(F.when(v.isNotNull(), F.col(COUNT))), F.lit(0))
    groups = counted.groupBy(*by).agg(known.alias("__rows"), *also)
    # at most one row for each ``limit`` rows of the table
    large = F.broadcast(groups.where(F.col("__rows") > limit).select(*[F.col(k).alias(f"__of_{k}") for k in by], "__rows"))
    of = [f"__of_{k}" for k in by]
    # the count keeps Spark from moving this join below the count, to a scan of its own
    others = counted.join(large, same_row(counted, large, by, of) & (counted[COUNT] > 0), "left_anti")
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    plain = F.percentile(v, wanted, F.col(COUNT)).alias(name)
    values = counted.where(v.isNotNull()).select(*by, v.alias("__v"), _ordered_bits(v).alias("__bits"), COUNT)
    selected = _selected(values, large, by, probabilities, name)
    if not keys:
        # one of the two has it; the other is a NULL or no row
        both = others.agg(plain).unionByName(selected.select(name))
        out = both.agg(F.first(name, ignorenulls=True).alias(name))
        return groups.drop("__rows", "__all").crossJoin(F.broadcast(out)) if also else out
    out = others.groupBy(*by).agg(plain).unionByName(selected)
    if not also:
        return out
    out = out.withColumnsRenamed({k: f"__r_{k}" for k in by})
    renamed = [f"__r_{k}" for k in by]
    return groups.drop("__rows").join(out, same_row(groups, out, by, renamed), "left").drop(*renamed)


def _ordered_bits(v: Column) -> Column:
    """The bits of a double as a bigint of the same order; NaN comes last, as in Spark's order."""
    size = F.abs(v)
    # scaling by powers of two is exact, so a logarithm that is off by one can be put right
    guess = F.floor(F.log2(size))
    guess = F.greatest(F.least(guess, F.lit(BIAS)), F.lit(1 - BIAS))
    part = size * F.pow(F.lit(2.0), -guess)
    exponent = guess + F.when(part >= 2, 1).when(part < 1, -1).otherwise(0)
    part = F.when(part >= 2, part / 2).when(part < 1, part * 2).otherwise(part)
    normal = (exponent + BIAS) * F.lit(MANTISSA) + ((part - 1) * F.lit(float(MANTISSA))).cast("bigint")
    tiny = (size * F.lit(2.0**537) * F.lit(2.0**537)).cast("bigint")
    bits = (
        F.when(size == 0, F.lit(0).cast("bigint"))
        .when(size == float("inf"), F.lit((2 * BIAS + 1) * MANTISSA))
        .when(size < 2.0**-1022, tiny)
        .otherwise(normal)
    )
    return F.when(F.isnan(v), F.lit((1 << 63) - 1)).when(v < 0, -bits).otherwise(bits)


def _selected(
    values: DataFrame, large: DataFrame, by: list[str], probabilities: list[float], name: str
) -> DataFrame:
    """Quantiles of the ``large`` groups, from their distinct ``values`` with bits and counts.

    Each wanted rank carries the bits it is known to begin with and its rank among the values that begin so.
    A round counts the next digit: per group and rank at most 2^22 numbers, summed up before they move.
    """
    of = [f"__of_{k}" for k in by]
    ranks = []
    for i, p in enumerate(probabilities):
        rank = F.lit(float(p)) * (F.col("__rows") - 1)
        part = rank - F.floor(rank)
        for side, exact in enumerate((F.floor(rank), F.ceil(rank))):
            ranks.append(
                F.struct(F.lit(2 * i + side).alias("id"), exact.cast("bigint").alias("rank"), part.alias("part"))
            )
    wanted = large.select(*of, F.lit(0).cast("bigint").alias("__found"), F.array(*ranks).alias("__ranks"))
    rest = 64
    for turn, digit in enumerate(DIGITS):
        known, rest = rest, rest - digit
        wanted = F.broadcast(wanted)  # a row for each large group and rank
        same = same_row(values, wanted, by, of)
        if turn:
            same = same & (F.shiftright("__bits", known) == F.col("__found"))
        digits = (
            values.join(wanted, same)
            .groupBy(*by, "__found", F.shiftright("__bits", rest).alias("__next"))
            .agg(F.sum(COUNT).alias("__c"), F.max("__ranks").alias("__ranks"), F.min("__v").alias("__v"))
        )
        so_far = Window.partitionBy(*by, "__found").orderBy("__next")
        upto = digits.withColumn("__upto", F.sum("__c").over(so_far)).withColumn("__before", F.col("__upto") - F.col("__c"))
        here = F.filter("__ranks", lambda r: (r["rank"] >= F.col("__before")) & (r["rank"] < F.col("__upto")))
        moved = F.transform(
            here, lambda r: F.struct(r["id"].alias("id"), (r["rank"] - F.col("__before")).alias("rank"), r["part"].alias("part"))
        )
        met = upto.withColumn("__ranks", moved).where(F.size("__ranks") > 0)
        found = [F.col(k).alias(o) for k, o in zip(by, of)]
        wanted = met.select(*found, F.col("__next").alias("__found"), "__ranks")
    # all bits are known: one value
    each = met.select(*found, "__v", F.inline("__ranks"))
    pairs = each.groupBy(*of).agg(
        F.sort_array(F.collect_list(F.struct("id", "part", F.col("__v").alias("v")))).alias("__p")
    )

    def between(i: int) -> Column:
        low, high, part = F.get("__p", 2 * i)["v"], F.get("__p", 2 * i + 1)["v"], F.get("__p", 2 * i)["part"]
        return F.when(part == 0, low).otherwise((1 - part) * low + part * high)

    quantiles = F.array(*[between(i) for i in range(len(probabilities))])
    return pairs.select(*[F.col(o).alias(k) for k, o in zip(by, of)], quantiles.alias(name))

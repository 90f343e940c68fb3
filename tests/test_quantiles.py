import math
import random
import struct

import pytest
from conftest import rows
from pyspark.sql import functions as F

from civiclake.operators.explore import monthly_stats
from civiclake.operators.quantiles import _ordered_bits, exact_quantiles


def order_of(x):
    bits = struct.unpack(">q", struct.pack(">d", abs(x)))[0]
    return -bits if x < 0 else bits


def odd_doubles():
    rng = random.Random(2)
    values = [0.0, -0.0, 1.0, -1.0, math.inf, -math.inf, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308]
    values += [1.7976931348623157e308, math.nextafter(1, 0), math.nextafter(1, 2), math.nextafter(8, 0), 1 / 3, 1e-310]
    values += [2.0**e for e in range(-1074, 1024, 13)] + [math.nextafter(2.0**e, 0) for e in range(-1060, 1024, 7)]
    values += [struct.unpack(">d", rng.randbytes(8))[0] for _ in range(3000)]
    return [v for v in values + [-v for v in values] if v == v]


def test_bits_of_doubles_keep_their_order(spark):
    values = odd_doubles()
    df = spark.createDataFrame([(v,) for v in values] + [(math.nan,)], "v double").select("v", _ordered_bits(F.col("v")).alias("b"))
    got = df.collect()
    for v, b in got:
        assert b == ((1 << 63) - 1 if v != v else order_of(v)), v


def skewed(spark):
    rng = random.Random(3)
    data = [("large", rng.choice([rng.gauss(0, 1e-3), rng.randrange(-5, 5) * 1.0, 1e300, -1e-320])) for _ in range(4000)]
    data += [("same", 7.5)] * 3000 + [("two", float(i % 2)) for i in range(999)] + [(None, float(i)) for i in range(900)]
    data += [("small", float(i)) for i in range(9)] + [("nulls", None)] * 2000 + [("mixed", 2.0 if i % 2 else None) for i in range(800)]
    return spark.createDataFrame(data, "k string, v double")


PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.77, 0.999, 1.0]


@pytest.mark.parametrize("limit", [0, 20, 350, 1000])
def test_selected_quantiles_are_those_of_sorted_groups(spark, limit):
    df = skewed(spark)
    plain = df.groupBy("k").agg(F.percentile("v", F.array(*[F.lit(p) for p in PROBABILITIES])).alias("q"))
    got = exact_quantiles(df, ["k"], "v", PROBABILITIES, "q", limit)
    close = lambda df: [(k, q and [pytest.approx(x, rel=1e-12) for x in q]) for k, q in rows(df)]
    assert {r.k: r.q for r in got.collect()} == dict(close(plain))


def test_nothing_runs_while_the_plan_is_built_and_one_scan(spark, tmp_path):
    skewed(spark).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "")
    try:
        got = exact_quantiles(df, ["k"], "v", [0.5], "q")
        assert tracker.getJobIdsForGroup("planning") == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "Window" not in final and "BroadcastHashJoin" not in final  # no large group: both are gone


def test_whole_tables_and_empty_ones(spark):
    df = skewed(spark)
    values = [r.v for r in df.where("v IS NOT NULL").collect()]
    low, high = sorted(values)[(len(values) - 1) // 2], sorted(values)[len(values) // 2]
    for limit in (None, 10):
        assert exact_quantiles(df, [], "v", [0.5], "q", limit).collect()[0][0] == [pytest.approx((low + high) / 2)]
        assert exact_quantiles(df.limit(0), [], "v", [0.5], "q", limit).collect() == [(None,)]
        assert exact_quantiles(df.limit(0), ["k"], "v", [0.5], "q", limit).collect() == []


def test_monthly_numbers_of_all_kinds_of_values(spark):
    df = spark.createDataFrame([(f"2020-0{1 + i % 3}-10", i if i % 7 else None) for i in range(900)], "d string, v int")
    for kind in ("int", "bigint", "double", "decimal(12,2)"):
        rows_of = df.selectExpr("date(d) AS d", f"CAST(v AS {kind}) AS v")
        plain = rows_of.groupBy(F.date_format("d", "yyyy-MM").alias("month")).agg(
            F.count("v").alias("num_values"), F.max("v").alias("max_value"), F.round(F.avg("v")).cast("bigint").alias("mean_value"),
            F.min("v").alias("min_value"), F.percentile(F.col("v").cast("double"), 0.5).alias("median_value"),
        )
        for limit in (None, 50):
            got = monthly_stats(rows_of, "d", "v", hot_limit=limit)
            assert rows(got) == rows(plain) and got.schema.simpleString() == plain.schema.simpleString()

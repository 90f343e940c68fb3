import random

from conftest import rows

from civiclake.operators.explore import monthly_stats
from civiclake.operators.history import (
    all_but_newest,
    latest_per,
    with_changes,
    with_previous,
)
from civiclake.operators.quantiles import exact_quantiles


def skewed(spark, n=3000):
    """A third of all rows under one key, some NULL keys and NULL dates."""
    rnd = random.Random(7)
    data = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else None if i % 3 == 1 and i % 2 else f"k{rnd.randrange(40)}"
        day = None if rnd.random() < 0.05 else rnd.randrange(50)
        data.append((key, day, i, float(rnd.randrange(1000))))
    return spark.createDataFrame(data, "k string, day int, id int, v double")


def test_sliced_lag_equals_the_window(spark):
    df = skewed(spark)
    new = {"pv": "v", "pid": "id"}
    plain = with_previous(df, ["k"], ["day", "id"], new)
    sliced = with_previous(df, ["k"], ["day", "id"], new, hot_limit=100)
    assert rows(plain) == rows(sliced)


def test_lag_without_hot_keys_has_one_window_and_no_range(spark):
    df = skewed(spark, 300)
    got = with_previous(df, ["k"], ["day", "id"], {"a": "v", "b": "id"})
    got.collect()
    final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "rangepartitioning" not in final and final.count("Window [") == 1


def test_slices_of_one_row_and_single_key(spark):
    df = spark.range(40).selectExpr("1 AS k", "id", "id * 2 AS v").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        got = rows(with_previous(df, ["k"], ["id"], {"p": "v"}, hot_limit=1), "id", "p")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {i: p for i, p in got} == {i: (2 * (i - 1) if i else None) for i in range(40)}


def test_changes(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 2, 7.0), (2, 1, 1.0)], "k int, t int, v double")
    got = with_changes(df, ["k"], ["t"], ["v"])
    assert rows(got, "k", "t", "v_change") == [(1, 1, None), (1, 2, 2.0), (2, 1, None)]


def test_undated_rows_rank_as_latest(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, 9, "y")], "k int, day int, who string")
    assert rows(latest_per(df, ["k"], ["day"]), "who") == [("x",)]


def test_all_but_newest_counts_every_file(spark):
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 1)], "t string, n int")
    assert rows(all_but_newest(df, ["t"], ["n"], 2)) == [("a", 0), ("a", 1), ("a", 2)]
    assert all_but_newest(df, ["t"], ["n"], 5).count() == 0


def test_large_group_quantiles_are_exact(spark):
    df = skewed(spark)
    wanted = [0.0, 0.1, 0.5, 0.93, 1.0]
    plain = exact_quantiles(df, ["k"], "v", wanted, "q")
    large = exact_quantiles(df, ["k"], "v", wanted, "q", hot_limit=200)
    assert [(k, [round(x, 9) for x in q]) for k, q in rows(plain)] == [
        (k, [round(x, 9) for x in q]) for k, q in rows(large)
    ]
    whole = exact_quantiles(df, [], "v", [0.5], "q", hot_limit=200).first()[0]
    assert whole == exact_quantiles(df, [], "v", [0.5], "q").first()[0]


def test_monthly_stats_with_a_hot_month(spark):
    df = spark.createDataFrame(
        [(f"2020-0{1 + (i % 3 == 0)}-10", i) for i in range(900)], "d string, v int"
    ).selectExpr("date(d) AS d", "v")
    assert rows(monthly_stats(df, "d", "v")) == rows(monthly_stats(df, "d", "v", hot_limit=400))

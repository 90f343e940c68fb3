import json

from conftest import rows
from pyspark.sql import functions as F

from civiclake.operators import quality as Q
from civiclake.operators.quality import Expectation, expect


def alerts(spark):
    data = [(f"crate-{i}", "pears" if i % 2 else "plums", f"{i % 4:02d}", None if i == 7 else 100 + i) for i in range(40)]
    return spark.createDataFrame(data, "crate string, fruit string, shelf string, weight int")


def verdicts(df, *suite, **options):
    return [r.success for r in Q.validate(df, list(suite), **options).orderBy("ordinal").collect()]


def test_suite_document_round_trip(spark):
    text = json.dumps(
        {
            "expectations": [
                {"expectation_type": "expect_table_columns_to_match_set", "kwargs": {"column_set": ["crate", "fruit", "shelf", "weight"], "exact_match": True}},
                {"expectation_type": "expect_table_row_count_to_be_between", "kwargs": {"min_value": 30, "max_value": 50}},
                {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "weight", "mostly": 0.97}},
                {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "weight"}},
                {"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "crate"}},
                {"expectation_type": "expect_column_value_lengths_to_be_between", "kwargs": {"column": "shelf", "min_value": 2, "max_value": 2}},
                {"expectation_type": "expect_column_distinct_values_to_be_in_set", "kwargs": {"column": "fruit", "value_set": ["pears", "plums"]}},
            ]
        }
    )
    suite = Q.suite_from_json(text)
    assert verdicts(alerts(spark), *suite) == [True, True, True, False, True, True, True]
    assert Q.suite_from_json(Q.suite_to_json(suite)) == suite


def test_row_checks_ignore_missing_values(spark):
    df = spark.createDataFrame([(1, 2), (None, 5), (9, 3)], "a int, b int")
    report = Q.validate(df, [expect("column_pair_values_a_to_be_greater_than_b", column_A="a", column_B="b")])
    assert rows(report, "missing_count", "unexpected_count", "success") == [(1, 1, False)]
    assert verdicts(df, expect("column_values_to_be_between", "a", min_value=0, strict_min=True)) == [True]


def test_simple_checks_are_one_pass(spark, tmp_path):
    path = str(tmp_path / "alerts")
    alerts(spark).write.parquet(path)
    suite = [
        expect("column_values_to_not_be_null", "weight"),
        expect("column_max_to_be_between", "weight", min_value=0),
        expect("column_values_to_match_regex", "shelf", regex=r"^\d+$"),
        expect("table_row_count_to_equal", value=40),
    ]
    plan = Q.validate(spark.read.parquet(path), suite)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_repeat_checks_share_a_scan(spark, tmp_path):
    path = str(tmp_path / "alerts")
    alerts(spark).write.parquet(path)
    suite = [
        expect("column_values_to_be_unique", "crate"),
        expect("compound_columns_to_be_unique", column_list=["shelf", "weight"]),
        expect("column_unique_value_count_to_be_between", "shelf", min_value=4, max_value=4),
        expect("column_proportion_of_unique_values_to_be_between", "shelf", min_value=0.1, max_value=0.1),
    ]
    report = Q.validate(spark.read.parquet(path), suite)
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert [r.success for r in report.orderBy("ordinal").collect()] == [True] * 4


def test_modes_order_and_divergence(spark):
    df = spark.createDataFrame([(i, "a" if i < 6 else "b", 10 - i) for i in range(10)], "i int, c string, d int")
    assert verdicts(
        df,
        expect("column_most_common_value_to_be_in_set", "c", value_set=["a"]),
        expect("column_most_common_value_to_be_in_set", "c", value_set=["b"]),
        expect("column_values_to_be_increasing", "i", strictly=True),
        expect("column_values_to_be_decreasing", "d"),
        expect("column_values_to_be_increasing", "d"),
        expect("column_kl_divergence_to_be_less_than", "c", threshold=1e-9, partition_object={"values": ["a", "b"], "weights": [0.6, 0.4]}),
        expect("column_kl_divergence_to_be_less_than", "c", threshold=9, partition_object={"values": ["a"], "weights": [1.0]}),
        row_order=["i"],
    ) == [True, False, True, True, False, True, False]


def test_empty_table(spark):
    df = alerts(spark).limit(0)
    got = verdicts(
        df,
        expect("column_values_to_not_be_null", "weight"),
        expect("column_values_to_be_in_set", "shelf", value_set=["x"]),
        expect("column_max_to_be_between", "weight", min_value=1),
    )
    assert got == [True, True, False]


def test_own_expectation(spark):
    @Q.row_check("column_values_to_be_even")
    def _(args, c):
        return c % 2 == 0

    df = alerts(spark).where(F.col("weight").isNotNull())
    e = Expectation("column_values_to_be_even", {"column": "weight", "mostly": 0.5})
    assert verdicts(df, e) == [True]
    assert Q.unexpected_rows(df, e).count() == 19


def test_json_schema(spark):
    df = spark.createDataFrame([('{"k": 1, "s": "x"}',), ('{"k": "no"}',), ("{",), (None,)], "j string")
    schema = {"properties": {"k": {"type": "integer"}, "s": {"type": "string"}}, "required": ["k"]}
    report = Q.validate(df, [expect("column_values_to_match_json_schema", "j", json_schema=schema)])
    assert rows(report, "missing_count", "unexpected_count") == [(1, 2)]


def test_profile_round_trip(spark):
    df = alerts(spark)
    suite = [
        Expectation(
            r.expectation.removeprefix("expect_"),
            {**json.loads(r.kwargs), **({"column": r.column} if r.column else {})},
        )
        for r in Q.profile(df).collect()
    ]
    assert len(suite) >= 10 and all(verdicts(df, *suite))


def test_repeated_values_travel_as_digests(spark):
    long = "x" * 5000
    data = [(i % 40, f"{long}{i % 30}" if i % 7 else None, None if i % 11 else 1.5, i) for i in range(2000)]
    df = spark.createDataFrame(data, "a int, b string, c double, d int")
    suite = [
        expect("column_values_to_be_unique", "b"),
        expect("column_values_to_be_unique", "d"),
        expect("compound_columns_to_be_unique", column_list=["a", "b", "c"]),
        expect("column_unique_value_count_to_be_between", "a", min_value=40, max_value=40),
        expect("column_most_common_value_to_be_in_set", "c", value_set=[1.5]),
        expect("column_most_common_value_to_be_in_set", "b", value_set=[long + str(n) for n in range(30)], ties_okay=True),
        expect("column_proportion_of_unique_values_to_be_between", "d", min_value=1),
    ]
    report = Q.validate(df, suite)
    got = {r.ordinal: r for r in report.collect()}
    counts = df.where("b IS NOT NULL").groupBy("b").count().where("count > 1").agg({"count": "sum"}).first()[0]
    three = df.groupBy("a", "b", "c").count().where("count > 1").agg({"count": "sum"}).first()[0]
    assert (got[0].unexpected_count, got[0].missing_count) == (counts, df.where("b IS NULL").count())
    assert got[1].unexpected_count == 0 and got[2].unexpected_count == three
    assert got[3].observed == 40 and all(got[i].success for i in (1, 3, 4, 5, 6)) and not got[0].success
    plan = report._jdf.queryExecution().executedPlan().toString()
    exchange = [line for line in plan.splitlines() if "Exchange hashpartitioning(d1" in line]
    assert exchange and all("hashpartitioning(d1" in line and ", d2" in line for line in exchange)


def test_null_places_make_different_compounds(spark):
    df = spark.createDataFrame([(None, "x"), ("x", None), (None, None), (None, None)], "a string, b string")
    row = Q.validate(df, [expect("compound_columns_to_be_unique", column_list=["a", "b"])]).first()
    assert (row.element_count, row.missing_count, row.unexpected_count, row.success) == (4, 2, 0, True)

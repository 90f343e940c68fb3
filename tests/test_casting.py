import pytest
from pyspark.sql import functions as F

from civiclake.functions import casting as C
from civiclake.functions import text as X


def values(spark, expression, *inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_rounding_casts(spark):
    assert values(spark, C.real_to_bigint("c"), "2.5", "3.5", "16777217", None) == [2, 4, 16777216, None]
    assert values(spark, C.numeric_to_bigint("c"), "2.5", "-2.5", "0.4") == [3, -3, 0]


def test_money(spark):
    got = values(spark, C.money("c"), "$1,200.50", "-$3", "($3.10)", " 7 ", None)
    assert [None if g is None else float(g) for g in got] == [1200.5, -3.0, -3.1, 7.0, None]


def test_booleans(spark):
    assert values(spark, C.boolean("c"), "on", "OFF", "t", "no", "1", None) == [True, False, True, False, True, None]
    assert values(spark, C.int_to_boolean("c"), "0", "7", None) == [False, True, None]


def test_malformed_raises_or_is_null(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, C.bigint("c"), "x1")
    assert values(spark, C.bigint("c", lenient=True), "x1", " 12 ", "", "n") == [None, 12, None, None]
    assert values(spark, C.double("c", lenient=True), "-1e3", "NaN", "one")[0] == -1000.0


def test_text_lengths(spark):
    assert values(spark, C.char("c", 3), "a   b", "abcd") == ["a", "abc"]
    assert values(spark, C.varchar("c", 3), "a   b", "abcd") == ["a  ", "abc"]


def test_dates(spark):
    formats = ("MM/dd/yyyy", "yyyy-MM-dd")
    got = values(spark, C.date("c", formats), "12/01/2024", "2024-12-02", None)
    assert [str(g) for g in got] == ["2024-12-01", "2024-12-02", "None"]
    with pytest.raises(Exception, match="not a date in any known format"):
        values(spark, C.date("c", formats), "yesterday")
    assert str(values(spark, C.year_start("c"), 2021, kind="int")[0]) == "2021-01-01"


def test_zoned_timestamps(spark):
    at = F.date_format(C.zoned_timestamp("c"), "yyyy-MM-dd HH:mm:ss")
    assert values(spark, at, "2024-12-01T11:01:39Z", "2024-07-01T11:00:00") == [
        "2024-12-01 17:01:39",
        "2024-07-01 16:00:00",
    ]
    same = F.date_format(C.zoned_timestamp("c", tz_mode="convert"), "HH:mm")
    assert values(spark, same, "2024-12-01T11:01:39Z") == ["11:01"]


def test_text_rules(spark):
    assert values(spark, X.letters_after_digit_removed("c"), "2-AB1A", "211") == ["2AB1", "211"]
    assert values(spark, X.strip_leading("c", "0"), "007", "10") == ["07", "10"]
    got = values(spark, X.normalized_category("c", ("MALE",)), "male", "Unknown Gender", "x", None)
    assert got == ["MALE", "UNKNOWN", "X", None]
    key = X.surrogate_key(["c", F.lit(None).cast("string")])
    assert values(spark, key, "a") == values(spark, F.md5(F.lit("a-_dbt_utils_surrogate_key_null_")), "a")

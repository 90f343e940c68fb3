from datetime import date

from conftest import rows

from civiclake.plans import parcels as P

SALE = "parcel_sale_id string, pin bigint, class string, sale_price bigint, sale_date date, is_multisale boolean, num_parcels_sale int"


def sales(spark, *values):
    data = [(i, pin, "211", price, day, False, 1) for i, pin, price, day in values]
    return spark.createDataFrame(data, SALE)


def test_sale_feature_edge_cases(spark):
    df = sales(
        spark,
        ("a", 1, 100, date(2000, 1, 1)),
        ("b", 1, 200, date(2001, 1, 1)),
        ("c", 1, 300, date(2001, 1, 1)),  # same day: no years, no return
        ("d", 1, 400, date(2001, 1, 20)),  # under a month: years, no return
        ("e", 2, 0, date(2000, 1, 1)),
        ("f", 2, 50, date(2002, 1, 1)),  # after a price of zero
        ("g", 3, 10, None),
    )
    got = {r.parcel_sale_id: r for r in P.parcel_sales_feature(df).collect()}
    assert got["a"].last_sale_price is None and got["a"].annualized_roi is None
    assert got["b"].price_change_since_last_sale == 100
    assert round(got["b"].years_since_last_sale, 6) == round(366 / 365.2422, 6)
    assert 99 < got["b"].annualized_roi < 100.1
    assert got["c"].years_since_last_sale is None and got["c"].annualized_roi is None
    assert 0 < got["d"].years_since_last_sale < 1 / 12 and got["d"].annualized_roi is None
    assert got["f"].annualized_roi is None and got["f"].price_change_since_last_sale == 50
    assert got["g"].class_descr == "APARTMENT BUILDING WITH 2 TO 6 UNITS, ANY AGE"


def test_owner_occupancy_is_three_valued(spark):
    df = spark.createDataFrame([("x", "x"), ("x", "y"), ("x", None), (None, None)], "a string, b string")
    got = [r[0] for r in df.select(P.same_or_null("a", "b")).collect()]
    assert got == [True, False, None, None]


def test_full_join_keeps_left_key_only(spark):
    left = spark.createDataFrame([(1, "l")], "id int, a string")
    right = spark.createDataFrame([(1, "r"), (2, "s")], "id int, b string")
    assert rows(P.full_join_keeping_left_key(left, right, "id")) == [(1, "l", "r"), (None, None, "s")]


def test_class_lookup(spark):
    df = spark.createDataFrame([("EX",), ("nope",), (None,)], "class string")
    got = rows(P.code_lookup(df, "class", P.CLASS_DESCRIPTIONS, "d"), "d")
    assert got == [("EXEMPT PROPERTY",), (None,), (None,)]

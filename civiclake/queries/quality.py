"""Quality suites. Each suite's SQL is a UNION ALL with one SELECT per expectation."""

from __future__ import annotations

from pyspark.sql import functions as F

from civiclake.operators import quality as Q
from civiclake.operators.quality import expect
from civiclake.queries.base import query

REPORT = [
    "ordinal",
    "expectation",
    "column",
    "element_count",
    "missing_count",
    "unexpected_count",
    "observed",
    "success",
]


def _report(df):
    return df.withColumn("observed", F.round("observed", 6)).select(*REPORT)


def _sql(suite, checks, table):
    """One SELECT per expectation from (missing, unexpected, observed, success) SQL texts.

    ``success`` None means: no unexpected value beyond what ``mostly`` allows."""
    parts = []
    for i, (e, (missing, unexpected, observed, success)) in enumerate(zip(suite, checks, strict=True)):
        ok = success or f"(n - m - u) >= {e.mostly} * (n - m)"
        label = f"'{e.label}'" if e.label else "NULL"
        count = "NULL" if missing == "-" else "n"
        parts.append(
            f"SELECT {i} AS ordinal, 'expect_{e.kind}' AS expectation, {label}::VARCHAR AS \"column\", "
            f"{count}::BIGINT AS element_count, {'NULL' if missing in ('-', None) else 'm'}::BIGINT "
            f"AS missing_count, {'NULL' if unexpected is None else 'u'}::BIGINT AS unexpected_count, "
            f"round(o::DOUBLE, 6) AS observed, ({ok})::BOOLEAN AS success FROM (SELECT count(*) AS n, "
            f"{'NULL' if missing in ('-', None) else missing} AS m, {unexpected or 'NULL'} AS u, "
            f"{observed or 'NULL'} AS o FROM {table})"
        )
    return " UNION ALL ".join(parts)


def bad(condition: str) -> str:
    return f"count_if(NOT ({condition}))"


LINE_SUITE = [
    expect("column_values_to_be_between", "l_quantity", min_value=1, max_value=40, mostly=0.7),
    expect("column_values_to_be_between", "l_tax", min_value=0, max_value=0.08, strict_max=True),
    expect("column_values_to_be_in_set", "l_returnflag", value_set=["A", "N"]),
    expect("column_distinct_values_to_be_in_set", "l_linestatus", value_set=["O", "F"]),
    expect("column_values_to_not_be_in_set", "l_returnflag", value_set=["X"]),
    expect("column_distinct_values_to_contain_set", "l_returnflag", value_set=["A", "Z"]),
    expect("column_distinct_values_to_equal_set", "l_linestatus", value_set=["O", "F"]),
    expect("column_values_to_not_be_null", "l_shipdate"),
    expect("column_values_to_be_null", "l_shipdate", mostly=0.5),
    expect("column_max_to_be_between", "l_quantity", min_value=50, max_value=50),
    expect("column_min_to_be_between", "l_quantity", min_value=2),
    expect("column_mean_to_be_between", "l_linenumber", min_value=3, max_value=5),
    expect("column_sum_to_be_between", "l_linenumber", min_value=1),
    expect("column_stdev_to_be_between", "l_linenumber", min_value=1, max_value=3),
    expect("column_pair_values_a_to_be_greater_than_b", column_A="l_extendedprice",
           column_B="l_quantity"),
    expect("column_pair_values_to_be_equal", column_A="l_orderkey", column_B="l_partkey"),
    expect("column_pair_values_to_be_in_set", column_A="l_returnflag", column_B="l_linestatus",
           value_pairs_set=[["A", "F"], ["R", "F"], ["N", "O"]]),
    expect("multicolumn_sum_to_equal", column_list=["l_linenumber", "l_quantity"], sum_total=10,
           mostly=0.001),
    expect("select_column_values_to_be_unique_within_record",
           column_list=["l_orderkey", "l_partkey", "l_suppkey"]),
    expect("column_value_z_scores_to_be_less_than", "l_linenumber", threshold=1.4,
           double_sided=True, mostly=0.7),
    expect("table_row_count_to_be_between", min_value=1),
    expect("table_row_count_to_equal", value=0),
    expect("table_row_count_to_equal_other_table"),
]
LINE_CHECKS = [
    ("0", bad("l_quantity BETWEEN 1 AND 40"), None, None),
    ("0", bad("l_tax >= 0 AND l_tax < 0.08"), None, None),
    ("0", bad("l_returnflag IN ('A', 'N')"), None, None),
    ("0", bad("l_linestatus IN ('O', 'F')"), None, None),
    ("0", bad("l_returnflag NOT IN ('X')"), None, None),
    ("0", "(NOT bool_or(l_returnflag = 'A'))::INT + (NOT bool_or(l_returnflag = 'Z'))::INT", None,
     "u = 0"),
    ("0", bad("l_linestatus IN ('O', 'F')"), None,
     "u = 0 AND (SELECT count(DISTINCT l_linestatus) FROM lineitem) = 2"),
    ("count_if(l_shipdate IS NULL)", "count_if(l_shipdate IS NULL)", None, "n - u >= n"),
    ("count_if(l_shipdate IS NULL)", "count_if(l_shipdate IS NOT NULL)", None, "n - u >= 0.5 * n"),
    ("0", None, "max(l_quantity)", "o BETWEEN 50 AND 50"),
    ("0", None, "min(l_quantity)", "o >= 2"),
    ("0", None, "avg(l_linenumber)", "o BETWEEN 3 AND 5"),
    ("0", None, "sum(l_linenumber)", "o >= 1"),
    ("0", None, "stddev_samp(l_linenumber)", "o BETWEEN 1 AND 3"),
    ("0", bad("l_extendedprice > l_quantity"), None, None),
    ("0", bad("l_orderkey = l_partkey"), None, None),
    ("0", bad("(l_returnflag, l_linestatus) IN (('A', 'F'), ('R', 'F'), ('N', 'O'))"), None, None),
    ("0", bad("l_linenumber + l_quantity = 10"), None, None),
    ("0", bad("l_orderkey <> l_partkey AND l_orderkey <> l_suppkey AND l_partkey <> l_suppkey"),
     None, None),
    ("0", """count_if(abs((l_linenumber - (SELECT avg(l_linenumber) FROM lineitem))
        / (SELECT stddev_samp(l_linenumber) FROM lineitem)) >= 1.4)""", None, None),
    (None, None, "count(*)", "o >= 1"),
    (None, None, "count(*)", "o = 0"),
    (None, None, "count(*)", "o = (SELECT count(*) FROM lineitem)"),
]


@query("quality_values_and_aggregates", _sql(LINE_SUITE, LINE_CHECKS, "lineitem"))
def _(t):
    """Row-wise, aggregate and row-count checks: one pass over the table."""
    return _report(Q.validate(t.lineitem, LINE_SUITE, other=t.lineitem))


TEXT_SUITE = [
    expect("column_value_lengths_to_be_between", "text", min_value=10, max_value=2000, mostly=0.5),
    expect("column_value_lengths_to_equal", "lang", value=2),
    expect("column_values_to_match_like_pattern", "source", like_pattern="%e%"),
    expect("column_values_to_match_like_pattern_list", "source", like_pattern_list=["%e%", "%o%"]),
    expect("column_values_to_match_like_pattern_list", "source", like_pattern_list=["%e%", "%o%"],
           match_on="all"),
    expect("column_values_to_not_match_like_pattern", "lang", like_pattern="x%"),
    expect("column_values_to_not_match_like_pattern_list", "lang", like_pattern_list=["e%", "f%"]),
    expect("column_values_to_match_regex", "lang", regex="^[a-z]{2}$"),
    expect("column_values_to_match_regex_list", "text", regex_list=["[0-9]", "[A-Z]"]),
    expect("column_values_to_match_regex_list", "text", regex_list=["[0-9]", "[A-Z]"],
           match_on="all", mostly=0.1),
    expect("column_values_to_not_match_regex", "text", regex="@[a-z]+"),
    expect("column_values_to_not_match_regex_list", "text", regex_list=["@[a-z]+", "https?:"]),
]


def _lengths(c, low, high):
    return bad(f"length({c}) BETWEEN {low} AND {high}")


TEXT_CHECKS = [
    ("0", _lengths("text", 10, 2000), None, None),
    ("0", bad("length(lang) = 2"), None, None),
    ("0", bad("source LIKE '%e%'"), None, None),
    ("0", bad("source LIKE '%e%' OR source LIKE '%o%'"), None, None),
    ("0", bad("source LIKE '%e%' AND source LIKE '%o%'"), None, None),
    ("0", bad("lang NOT LIKE 'x%'"), None, None),
    ("0", bad("lang NOT LIKE 'e%' AND lang NOT LIKE 'f%'"), None, None),
    ("0", bad("regexp_matches(lang, '^[a-z]{2}$')"), None, None),
    ("0", bad("regexp_matches(text, '[0-9]') OR regexp_matches(text, '[A-Z]')"), None, None),
    ("0", bad("regexp_matches(text, '[0-9]') AND regexp_matches(text, '[A-Z]')"), None, None),
    ("0", bad("NOT regexp_matches(text, '@[a-z]+')"), None, None),
    ("0", bad("NOT regexp_matches(text, '@[a-z]+') AND NOT regexp_matches(text, 'https?:')"),
     None, None),
]


@query("quality_texts", _sql(TEXT_SUITE, TEXT_CHECKS, "documents"))
def _(t):
    """Length and pattern checks over whole texts."""
    return _report(Q.validate(t.documents, TEXT_SUITE))


PARSE_SUITE = [
    expect("column_values_to_be_json_parseable", "props"),
    expect("column_values_to_match_json_schema", "props",
           json_schema={"properties": {"k": {"type": "integer"}}, "required": ["k"]}),
    expect("column_values_to_match_json_schema", "props", json_schema={"required": ["missing"]}),
    expect("column_values_to_be_dateutil_parseable", "day"),
    expect("column_values_to_match_strftime_format", "day", strftime_format="%Y-%m-%d"),
    expect("column_values_to_match_strftime_format", "day", strftime_format="%d.%m.%Y"),
    expect("column_values_to_be_json_parseable", "event_type"),
]
PARSE_CHECKS = [
    ("0", "0", None, None),
    ("0", "count_if((props->>'$.k') IS NULL)", None, None),
    ("0", "count(*)", None, None),
    ("0", "0", None, None),
    ("0", "0", None, None),
    ("0", "count(*)", None, None),
    ("0", "count(*)", None, None),
]


@query("quality_parseable", _sql(PARSE_SUITE, PARSE_CHECKS, "events"))
def _(t):
    """JSON, dates and formats."""
    rows = t.events.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return _report(Q.validate(rows, PARSE_SUITE))


REPEAT_SUITE = [
    expect("column_values_to_be_unique", "o_orderkey"),
    expect("column_values_to_be_unique", "o_custkey", mostly=0.01),
    expect("compound_columns_to_be_unique", column_list=["o_custkey", "o_orderdate"]),
    expect("column_unique_value_count_to_be_between", "o_custkey", min_value=100),
    expect("column_proportion_of_unique_values_to_be_between", "o_custkey", max_value=0.5),
    expect("column_most_common_value_to_be_in_set", "o_orderstatus", value_set=["F", "O", "P"]),
    expect("column_most_common_value_to_be_in_set", "o_orderpriority", value_set=["none"]),
]


def _in_groups(cols: str) -> str:
    return f"""(SELECT coalesce(sum(k), 0) FROM (SELECT count(*) AS k FROM orders GROUP BY {cols}
    HAVING count(*) > 1))"""


REPEAT_CHECKS = [
    ("0", _in_groups("o_orderkey"), None, None),
    ("0", _in_groups("o_custkey"), None, None),
    ("0", _in_groups("o_custkey, o_orderdate"), None, None),
    ("0", None, "count(DISTINCT o_custkey)", "o >= 100"),
    ("0", None, "count(DISTINCT o_custkey) / count(*)", "o <= 0.5"),
    ("0", "0", None, "true"),
    ("0", """(SELECT count(*) FROM (SELECT count(*) AS k FROM orders GROUP BY o_orderpriority)
        WHERE k = (SELECT max(k) FROM (SELECT count(*) AS k FROM orders GROUP BY o_orderpriority)))""",
     None, "false"),
]


@query("quality_repeats", _sql(REPEAT_SUITE, REPEAT_CHECKS, "orders"))
def _(t):
    """Uniqueness, distinct counts and modes: one shuffle for all."""
    return _report(Q.validate(t.orders, REPEAT_SUITE))


SCHEMA_SUITE = [
    expect("column_to_exist", "c_name"),
    expect("column_to_exist", "c_nothing"),
    expect("column_to_exist", "c_name", column_index=1),
    expect("column_values_to_be_of_type", "c_acctbal", type_="DOUBLE_PRECISION"),
    expect("column_values_to_be_in_type_list", "c_custkey", type_list=["INTEGER", "BIGINT"]),
    expect("table_column_count_to_equal", value=5),
    expect("table_column_count_to_be_between", min_value=6, max_value=9),
    expect("table_columns_to_match_ordered_list",
           column_list=["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]),
    expect("table_columns_to_match_set", column_set=["c_name", "c_custkey"], exact_match=False),
    expect("table_columns_to_match_set", column_set=["c_name", "c_custkey"]),
]
SCHEMA_CHECKS = [
    ("-", None, None, "true"),
    ("-", None, None, "false"),
    ("-", None, None, "true"),
    ("-", None, None, "true"),
    ("-", None, None, "true"),
    ("-", None, "5", "true"),
    ("-", None, "5", "false"),
    ("-", None, None, "true"),
    ("-", None, None, "true"),
    ("-", None, None, "false"),
]


@query("quality_schema", _sql(SCHEMA_SUITE, SCHEMA_CHECKS, "customer"))
def _(t):
    """Columns, their types, number and order."""
    return _report(Q.validate(t.customer, SCHEMA_SUITE))


SPREAD_SUITE = [
    expect("column_median_to_be_between", "l_quantity", min_value=20, max_value=30),
    expect("column_quantile_values_to_be_between", "l_quantity",
           quantile_ranges={"quantiles": [0.1, 0.9], "value_ranges": [[1, 10], [49, 50]]}),
    expect("column_kl_divergence_to_be_less_than", "l_returnflag", threshold=0.1,
           partition_object={"values": ["A", "N", "R"], "weights": [0.3, 0.4, 0.3]}),
    expect("column_values_to_be_increasing", "l_orderkey"),
    expect("column_values_to_be_decreasing", "l_quantity", mostly=0.1),
]
SPREAD_CHECKS = [
    ("-", "0", "quantile_cont(l_quantity, 0.5)", "o BETWEEN 20 AND 30"),
    ("-", """(quantile_cont(l_quantity, 0.1) NOT BETWEEN 1 AND 10)::INT
        + (quantile_cont(l_quantity, 0.9) NOT BETWEEN 49 AND 50)::INT""", None, "u = 0"),
    (None, "0", """(SELECT sum(p * ln(p / q)) FROM (SELECT count(*) / (SELECT count(*) FROM lineitem)
        AS p, CASE l_returnflag WHEN 'N' THEN 0.4::DOUBLE ELSE 0.3 END AS q FROM lineitem
        GROUP BY l_returnflag))""", "o <= 0.1"),
    ("0", "0", None, None),
    ("0", """(SELECT count_if(l_quantity > p) FROM (SELECT l_quantity, lag(l_quantity) OVER (ORDER BY
        l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity)
        AS p FROM lineitem))""", None, None),
]
ROW_ORDER = [
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_extendedprice",
    "l_shipdate",
    "l_quantity",
]


@query("quality_distribution_and_order", _sql(SPREAD_SUITE, SPREAD_CHECKS, "lineitem"))
def _(t):
    """Quantiles, divergence from declared weights, order along a row order."""
    return _report(Q.validate(t.lineitem, SPREAD_SUITE, row_order=ROW_ORDER))


@query(
    "quality_not_unique",
    """SELECT o_custkey, count(*) AS n_records FROM orders GROUP BY 1 HAVING count(*) > 1""",
)
def _(t):
    """Model test: values that should be unique and are not."""
    return Q.not_unique_values(t.orders, "o_custkey")


@query(
    "quality_null_rows",
    """SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    AND n_regionkey < 3 WHERE n_name IS NULL""",
)
def _(t):
    """Model test: rows with a missing value."""
    some = t.nation.where("n_regionkey < 3")
    rows = t.customer.join(some, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return Q.null_rows(rows.select("c_custkey", "n_name"), "n_name")


@query(
    "quality_unexpected_rows",
    "SELECT * FROM part WHERE NOT regexp_matches(p_brand, '^Brand#[0-9]$')",
)
def _(t):
    """The rows behind a failed expectation."""
    e = expect("column_values_to_match_regex", "p_brand", regex="^Brand#[0-9]$")
    return Q.unexpected_rows(t.part, e)


@query(
    "quality_percentages",
    """SELECT 0 AS ordinal, round(100.0 * count_if(p_size > 40) / count(*), 6) AS unexpected_percent,
    0.0::DOUBLE AS missing_percent FROM part""",
)
def _(t):
    """The summary level of a report."""
    suite = [expect("column_values_to_be_between", "p_size", max_value=40)]
    report = Q.summarized(Q.validate(t.part, suite), "SUMMARY")
    return report.select(
        "ordinal", F.round("unexpected_percent", 6).alias("unexpected_percent"), "missing_percent"
    )


@query(
    "quality_profile",
    """SELECT NULL::VARCHAR AS "column", 'expect_table_row_count_to_be_between' AS expectation,
    '{"min_value":' || count(*) || ',"max_value":' || count(*) || '}' AS kwargs FROM orders
    UNION ALL SELECT NULL, 'expect_table_columns_to_match_set', '{"column_set":["o_orderkey",'
      || '"o_custkey","o_orderstatus","o_totalprice","o_orderdate","o_orderpriority"]}'
    UNION ALL SELECT unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate',
      'o_orderpriority']),
      'expect_column_values_to_not_be_null', '{"mostly":1.0}'
    UNION ALL SELECT 'o_orderkey', 'expect_column_values_to_be_between',
      '{"min_value":' || min(o_orderkey) || ',"max_value":' || max(o_orderkey) || '}' FROM orders
    UNION ALL SELECT 'o_totalprice', 'expect_column_values_to_be_between',
      '{"min_value":' || min(o_totalprice) || ',"max_value":' || max(o_totalprice) || '}' FROM orders
    UNION ALL SELECT 'o_custkey', 'expect_column_values_to_be_between',
      '{"min_value":' || min(o_custkey) || ',"max_value":' || max(o_custkey) || '}' FROM orders
    UNION ALL SELECT 'o_orderstatus', 'expect_column_value_lengths_to_be_between',
      '{"min_value":' || min(length(o_orderstatus)) || ',"max_value":'
      || max(length(o_orderstatus)) || '}' FROM orders
    UNION ALL SELECT 'o_orderpriority', 'expect_column_value_lengths_to_be_between',
      '{"min_value":' || min(length(o_orderpriority)) || ',"max_value":'
      || max(length(o_orderpriority)) || '}' FROM orders
    UNION ALL SELECT 'o_orderstatus', 'expect_column_values_to_match_regex',
      '{"regex":"^[A-Za-z]+$","mostly":1.0}'
    UNION ALL SELECT 'o_orderpriority', 'expect_column_values_to_match_regex',
      '{"regex":"^\\\\S","mostly":1.0}'""",
)
def _(t):
    """Expectations derived from a table, from all its columns."""
    return Q.profile(t.orders, t.orders.columns)

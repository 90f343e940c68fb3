"""Aggregates and exploration."""

from __future__ import annotations

from pyspark.sql import functions as F

from civiclake.operators import explore as E
from civiclake.operators.freshness import any_and_all
from civiclake.operators.quantiles import exact_quantiles
from civiclake.operators.spatial import most_common
from civiclake.queries.base import query


@query(
    "high_water_mark",
    "SELECT max(ts) AS mark, (SELECT max(o_orderdate) FROM orders) AS latest_order FROM events",
)
def _(t):
    latest = t.orders.agg(F.max("o_orderdate")).scalar()
    return t.events.agg(F.max("ts").alias("mark"), latest.alias("latest_order"))


MONTHLY_SQL = """SELECT strftime(o_orderdate, '%Y-%m') AS month, count(price) AS num_values,
    max(price) AS max_value, round(avg(price))::BIGINT AS mean_value, min(price) AS min_value,
    quantile_cont(price::DOUBLE, 0.5) AS median_value
    FROM (SELECT o_orderdate, round(o_totalprice::DECIMAL(38,10))::BIGINT AS price FROM orders)
    GROUP BY 1"""


def _prices(t):
    price = F.round(F.col("o_totalprice").cast("decimal(38,10)")).cast("bigint")
    return t.orders.select("o_orderdate", price.alias("price"))


@query("monthly_price_stats", MONTHLY_SQL)
def _(t):
    return E.monthly_stats(_prices(t), "o_orderdate", "price")


@query("monthly_price_stats_large_groups", MONTHLY_SQL)
def _(t):
    """The same numbers with every month treated as too large for one buffer."""
    return E.monthly_stats(_prices(t), "o_orderdate", "price", hot_limit=100)


@query(
    "exact_quantiles",
    """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 4) AS q25,
    round(quantile_cont(l_extendedprice, 0.5), 4) AS q50,
    round(quantile_cont(l_extendedprice, 0.99), 4) AS q99 FROM lineitem GROUP BY 1""",
)
def _(t):
    q = exact_quantiles(t.lineitem, ["l_returnflag"], "l_extendedprice", [0.25, 0.5, 0.99], "q")
    names = [F.round(F.get("q", i), 4).alias(n) for i, n in enumerate(("q25", "q50", "q99"))]
    return q.select("l_returnflag", *names)


@query("row_count", "SELECT count(*) AS row_count FROM lineitem")
def _(t):
    return E.row_count(t.lineitem)


@query("distinct_count", "SELECT count(DISTINCT l_orderkey) AS distinct_count FROM lineitem")
def _(t):
    return E.distinct_count(t.lineitem, "l_orderkey")


@query(
    "distinct_rows_count",
    "SELECT count(*) AS distinct_count FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)",
)
def _(t):
    return E.distinct_rows_count(t.lineitem, "l_orderkey", "l_linenumber")


@query(
    "value_counts",
    """SELECT event_type, count(*) AS row_count, length(event_type)::INTEGER AS n_chars
    FROM events GROUP BY 1 ORDER BY 2, 1""",
)
def _(t):
    return E.value_counts(t.events, "event_type", with_length=True)


@query(
    "value_counts_descending",
    "SELECT l_shipdate, count(*) AS row_count FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1",
)
def _(t):
    return E.value_counts(t.lineitem, "l_shipdate", ascending=False)


@query(
    "counts_by_hour",
    "SELECT hour(ts)::INTEGER AS date_hour, count(*) AS row_count FROM events GROUP BY 1",
)
def _(t):
    return E.counts_by_hour(t.events, "ts")


MONTHS_SQL = """m AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders
    GROUP BY 1),
    months AS (SELECT unnest(generate_series(
      (SELECT min(month) || '-01' FROM m WHERE n >= 5)::TIMESTAMP,
      (SELECT max(month) || '-01' FROM m WHERE n >= 5)::TIMESTAMP,
      INTERVAL 1 MONTH))::DATE AS month_start)"""


@query("evenly_spaced_months", f"WITH {MONTHS_SQL} SELECT month_start FROM months")
def _(t):
    return E.months_between_busy_ends(t.orders, "o_orderdate")


@query(
    "dense_monthly_stats",
    f"""WITH {MONTHS_SQL}, stats AS ({MONTHLY_SQL})
    SELECT strftime(month_start, '%Y-%m') AS month, month_start,
    coalesce(num_values, 0) AS num_values, max_value, mean_value, min_value, median_value
    FROM months LEFT JOIN stats ON stats.month = strftime(month_start, '%Y-%m')""",
)
def _(t):
    """Statistics on evenly spaced months."""
    return E.dense_monthly_stats(_prices(t), "o_orderdate", "price")


@query(
    "most_common_value",
    """SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""",
)
def _(t):
    return most_common(t.part, "p_brand")


@query(
    "chart_metrics",
    """SELECT date_trunc('quarter', o_orderdate)::TIMESTAMP AS period, l_returnflag AS flag,
    min(l_quantity) AS min_qty, max(l_quantity) AS max_qty, count(*) AS num_lines,
    count(DISTINCT o_custkey) AS num_customers, sum(l_linenumber)::BIGINT AS sum_lines,
    avg(l_linenumber) AS avg_line,
    round(quantile_cont(l_extendedprice, 0.5), 4) AS median_price,
    count(*) FILTER (l_discount > 0.05) AS num_discounted
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_linestatus = 'F' GROUP BY 1, 2""",
)
def _(t):
    """All metric kinds, filtered and sliced by quarter and a dimension."""
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    out = E.metric_query(
        rows,
        {
            "min_qty": ("MIN", "l_quantity"),
            "max_qty": ("MAX", "l_quantity"),
            "num_lines": ("COUNT", "*"),
            "num_customers": ("COUNT_DISTINCT", "o_custkey"),
            "sum_lines": ("SUM", "l_linenumber"),
            "avg_line": ("AVG", "l_linenumber"),
            "median_price": ("MEDIAN", "l_extendedprice"),
            "num_discounted": F.count_if(F.col("l_discount") > 0.05),
        },
        {"flag": "l_returnflag"},
        F.col("l_linestatus") == "F",
        "o_orderdate",
        "quarter",
    )
    return out.withColumns(
        {
            "period": F.col("period").cast("timestamp_ntz"),
            "median_price": F.round("median_price", 4),
        }
    )


@query(
    "repeated_group_sizes",
    """SELECT l_suppkey, l_quantity, count(*) AS n_lines FROM lineitem GROUP BY 1, 2
    HAVING count(*) > 1""",
)
def _(t):
    counts = t.lineitem.groupBy("l_suppkey", "l_quantity").agg(F.count("*").alias("n_lines"))
    return counts.where("n_lines > 1")


@query(
    "candidate_key_test",
    """SELECT (SELECT count(*) FROM (SELECT row_number() OVER (PARTITION BY l_orderkey,
      l_linenumber) AS rn FROM lineitem) WHERE rn > 1) AS order_line,
    (SELECT count(*) FROM (SELECT row_number() OVER (PARTITION BY o_orderkey) AS rn FROM orders)
      WHERE rn > 1) AS orderkey""",
)
def _(t):
    """0 surplus rows: the columns identify a record."""
    one = E.surplus_rows(t.lineitem, ["l_orderkey", "l_linenumber"])
    two = E.surplus_rows(t.orders, ["o_orderkey"]).withColumnRenamed("surplus_rows", "orderkey")
    return one.withColumnRenamed("surplus_rows", "order_line").crossJoin(F.broadcast(two))


@query(
    "rows_sharing_a_key",
    """SELECT doc_id, text, lang, source, n_chars FROM documents WHERE text IN
    (SELECT text FROM documents GROUP BY 1 HAVING count(*) > 1)""",
)
def _(t):
    """All rows whose whole text occurs more than once. The key is a digest, so that only the
    rows themselves carry texts through the shuffle."""
    rows = t.documents.withColumn("digest", F.sha2("text", 256))
    return E.rows_sharing_key(rows, ["digest"]).select(*t.documents.columns)


@query(
    "any_and_all",
    """SELECT bool_or(quality = 1) AS any_true, bool_and(quality = 1) AS all_true FROM labels""",
)
def _(t):
    return any_and_all(t.labels.select((F.col("quality") == 1).alias("good")), "good")

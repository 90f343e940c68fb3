"""Rankings and lags."""

from __future__ import annotations

from pyspark.sql import functions as F

from civiclake.operators import history as H
from civiclake.operators.freshness import latest_checks
from civiclake.plans.parcels import sale_features
from civiclake.queries.base import query


@query(
    "latest_supplier_per_part",
    """SELECT l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey
    ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC) AS rn
    FROM lineitem) WHERE rn = 1""",
)
def _(t):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey"]
    return H.latest_per(t.lineitem, ["l_partkey"], order).select("l_partkey", "l_suppkey")


@query(
    "resale_features",
    """WITH lagged AS (
      SELECT o_orderkey, o_custkey, o_orderdate::DATE AS sale_date,
        round(o_totalprice::DECIMAL(38,10))::BIGINT AS sale_price,
        lag(o_orderdate::DATE) OVER w AS last_sale_date,
        lag(round(o_totalprice::DECIMAL(38,10))::BIGINT) OVER w AS last_sale_price,
        lag(o_orderpriority) OVER w AS last_priority
      FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
    timed AS (SELECT *, nullif((sale_date - last_sale_date)::DOUBLE / 365.2422, 0) AS years
              FROM lagged)
    SELECT o_orderkey, o_custkey, sale_date, sale_price, last_sale_date, last_sale_price,
      last_priority, sale_price - last_sale_price AS price_change_since_last_sale,
      years AS years_since_last_sale,
      printf('%.9e', (power(1 + (sale_price - last_sale_price)::DOUBLE
        / nullif(last_sale_price, 0), 1 / CASE WHEN years < 1.0 / 12 THEN NULL ELSE years END)
        - 1) * 100) AS annualized_roi
    FROM timed""",
)
def _(t):
    """Previous sale, change, years between and annualized return per customer."""
    sales = t.orders.select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderdate").cast("date").alias("sale_date"),
        F.round(F.col("o_totalprice").cast("decimal(38,10)")).cast("bigint").alias("sale_price"),
        "o_orderpriority",
    )
    feats = sale_features(
        sales,
        "o_custkey",
        sale_id="o_orderkey",
        also_previous={"last_priority": "o_orderpriority"},
        class_column=None,
    )
    roi = F.col("annualized_roi")
    text = F.when(roi.isNotNull(), F.format_string("%.9e", roi))
    return feats.withColumn("annualized_roi", text).drop("o_orderpriority")


_LINE_ORDER = (
    "l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, "
    "l_tax, l_returnflag, l_linestatus"
)


@query(
    "value_changes_per_part",
    f"""SELECT l_partkey, l_orderkey, l_linenumber, l_shipdate,
    l_quantity - lag(l_quantity) OVER w AS l_quantity_change,
    l_extendedprice - lag(l_extendedprice) OVER w AS l_extendedprice_change,
    l_tax - lag(l_tax) OVER w AS l_tax_change, lag(l_returnflag) OVER w AS last_flag
    FROM lineitem WINDOW w AS (PARTITION BY l_partkey ORDER BY {_LINE_ORDER})""",
)
def _(t):
    """Several changes over one window."""
    order = _LINE_ORDER.split(", ")
    rows = H.with_previous(
        t.lineitem,
        ["l_partkey"],
        order,
        {
            "last_flag": "l_returnflag",
            **{f"last_{c}": c for c in ("l_quantity", "l_extendedprice", "l_tax")},
        },
    )
    return rows.select(
        "l_partkey",
        "l_orderkey",
        "l_linenumber",
        "l_shipdate",
        *[
            (F.col(c) - F.col(f"last_{c}")).alias(f"{c}_change")
            for c in ("l_quantity", "l_extendedprice", "l_tax")
        ],
        "last_flag",
    )


@query(
    "value_changes_of_hot_keys",
    f"""SELECT l_returnflag, l_orderkey, l_linenumber, l_shipdate,
    l_quantity - lag(l_quantity) OVER w AS l_quantity_change
    FROM lineitem WINDOW w AS (PARTITION BY l_returnflag ORDER BY
    {_LINE_ORDER.replace(', l_returnflag', '')}, l_partkey)""",
)
def _(t):
    """Three keys for all rows: each is cut into ordered slices."""
    order = [*_LINE_ORDER.replace(", l_returnflag", "").split(", "), "l_partkey"]
    rows = t.lineitem.select("l_returnflag", *order)
    out = H.with_changes(rows, ["l_returnflag"], order, ["l_quantity"], hot_limit=15_000)
    return out.select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_shipdate", "l_quantity_change"
    )


@query(
    "latest_check_per_dataset",
    """SELECT dataset_name, source_data_last_modified, time_of_check FROM (
      SELECT event_type AS dataset_name, ts::DATE AS source_data_last_modified,
        ts AS time_of_check, row_number() OVER (PARTITION BY event_type, ts::DATE
        ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE value > 1) WHERE rn = 1""",
)
def _(t):
    checks = t.events.select(
        F.col("event_type").alias("dataset_name"),
        F.col("ts").cast("date").alias("source_data_last_modified"),
        F.col("ts").alias("time_of_check"),
        (F.col("value") > 1).alias("local_data_updated"),
    )
    return latest_checks(checks).drop("local_data_updated")


@query(
    "last_row_kept",
    """SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY value DESC NULLS FIRST, event_id DESC) AS rn FROM events) WHERE rn = 1""",
)
def _(t):
    """Sort ascending, keep the last row per key."""
    rows = t.events.select("user_id", "event_id", "value")
    return H.last_kept(rows, ["user_id"], ["value", "event_id"])


@query(
    "all_but_newest_files",
    """SELECT source, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY source
    ORDER BY doc_id DESC) AS rn FROM documents) WHERE rn > 20""",
)
def _(t):
    """Which pulls are older than the newest 20 of their table."""
    rows = t.documents.select("source", "doc_id")
    return H.all_but_newest(rows, ["source"], ["doc_id"], 20)

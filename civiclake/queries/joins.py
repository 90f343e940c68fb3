"""Join shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from civiclake.operators.freshness import cached_and_source
from civiclake.operators.history import latest_per
from civiclake.plans.parcels import full_join_keeping_left_key
from civiclake.queries.base import query
from civiclake.sources.tables import absent_rows


@query(
    "join_one_to_one",
    """SELECT c.c_custkey, c_name, num_orders FROM customer c JOIN
    (SELECT o_custkey, count(*) AS num_orders FROM orders GROUP BY 1) f ON c_custkey = o_custkey""",
)
def _(t):
    counts = t.orders.groupBy("o_custkey").agg(F.count("*").alias("num_orders"))
    joined = t.customer.join(counts, F.col("c_custkey") == F.col("o_custkey"))
    return joined.select("c_custkey", "c_name", "num_orders")


@query(
    "join_one_to_many",
    """SELECT c_custkey, c_mktsegment, o_orderkey, o_totalprice
    FROM customer JOIN orders ON c_custkey = o_custkey""",
)
def _(t):
    joined = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"))
    return joined.select("c_custkey", "c_mktsegment", "o_orderkey", "o_totalprice")


@query(
    "join_dropping_never_sold",
    """SELECT c_custkey, last_priority FROM customer JOIN (
      SELECT o_custkey, o_orderpriority AS last_priority, row_number() OVER
        (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders WHERE o_totalprice > 450000) ON o_custkey = c_custkey AND rn = 1""",
)
def _(t):
    """Customers without a large order drop out."""
    large = t.orders.where("o_totalprice > 450000")
    latest = latest_per(large, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    joined = t.customer.join(latest, F.col("c_custkey") == F.col("o_custkey"))
    return joined.select("c_custkey", F.col("o_orderpriority").alias("last_priority"))


@query(
    "join_left",
    """SELECT c_custkey, n_name FROM customer LEFT JOIN nation
    ON c_nationkey = n_nationkey AND n_regionkey < 3""",
)
def _(t):
    some = t.nation.where("n_regionkey < 3")
    joined = t.customer.join(some, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.select("c_custkey", "n_name")


@query(
    "join_full_keeping_left_key",
    """SELECT a.o_orderkey, a.o_totalprice, b.o_orderpriority
    FROM (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P') a
    FULL OUTER JOIN (SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'F') b
    ON a.o_orderkey = b.o_orderkey""",
)
def _(t):
    """Rows found only on the right carry NULL in the key."""
    features = t.orders.where("o_orderstatus <> 'P'").select("o_orderkey", "o_totalprice")
    details = t.orders.where("o_orderstatus <> 'F'").select("o_orderkey", "o_orderpriority")
    return full_join_keeping_left_key(features, details, "o_orderkey")


@query(
    "join_semi",
    """SELECT * FROM orders WHERE o_custkey IN
    (SELECT o_custkey FROM orders WHERE o_orderdate > TIMESTAMP '2001-06-01')""",
)
def _(t):
    """All versions of the entities that changed lately."""
    changed = t.orders.where("o_orderdate > timestamp_ntz'2001-06-01'").select("o_custkey")
    return t.orders.join(changed, "o_custkey", "left_semi")


@query(
    "join_anti",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN
    (SELECT o_custkey FROM orders WHERE o_orderdate > TIMESTAMP '2001-06-01')""",
)
def _(t):
    lately = t.orders.where("o_orderdate > timestamp_ntz'2001-06-01'")
    rows = t.customer.select("c_custkey", "c_name")
    return absent_rows(rows, lately.selectExpr("o_custkey AS c_custkey"), ["c_custkey"])


@query(
    "join_one_row_to_all",
    """SELECT p_partkey, p_name, first_day, last_day FROM part,
    (SELECT min(o_orderdate) AS first_day, max(o_orderdate) AS last_day FROM orders)""",
)
def _(t):
    """A one-row header attached to every row (the header is an aggregate, so one row for sure)."""
    header = t.orders.agg(
        F.min("o_orderdate").alias("first_day"), F.max("o_orderdate").alias("last_day")
    )
    return t.part.select("p_partkey", "p_name").crossJoin(F.broadcast(header))


@query(
    "join_source_with_cache",
    """SELECT c.c_custkey, c.c_nationkey, c.c_acctbal AS c_acctbal_source,
    s.s_acctbal AS c_acctbal_cache
    FROM customer c LEFT JOIN supplier s ON c.c_custkey = s.s_suppkey""",
)
def _(t):
    """The same column from both sides under two names."""
    cache = t.supplier.selectExpr("s_suppkey AS c_custkey", "s_acctbal AS c_acctbal")
    rows = t.customer.select("c_custkey", "c_nationkey", "c_acctbal")
    return cached_and_source(rows, cache, "c_custkey", "c_acctbal")


@query(
    "join_by_position",
    """SELECT doc_id, string_split(text, '.')[1] AS first_sentence, n_chars FROM documents""",
)
def _(t):
    """A field of a row's first list element, without any join."""
    return t.documents.select(
        "doc_id", F.get(F.split("text", r"\."), 0).alias("first_sentence"), "n_chars"
    )

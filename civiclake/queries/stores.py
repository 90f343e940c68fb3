"""Version stores, standardization, upserts and layer tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.operators.explore import monthly_stats, version_counts
from civiclake.operators.quality import expect
from civiclake.operators.versions import (
    distinct_pull,
    keep_stored_copy,
    latest_versions,
    latest_versions_incremental,
    merge_distinct_versions,
    new_versions,
    upserted,
)
from civiclake.plans.names import with_standard_names
from civiclake.plans.parcels import sale_features
from civiclake.plans.refresh import CHECKS, GateFailed, refresh
from civiclake.plans.scratch import written
from civiclake.plans.spec import DatasetSpec, auto_spec, column_specs, standardize
from civiclake.queries.base import Tables, query
from civiclake.sources import files, tables

OLD, NEW = "2023-02-17T15:09:14Z", "2023-07-05T19:32:45Z"
META = ["source_data_updated", "ingestion_check_time"]
ORDER_COLS = [
    "o_orderkey",
    "o_custkey",
    "o_orderstatus",
    "o_totalprice",
    "o_orderdate",
    "o_orderpriority",
]


def stored_orders(t: Tables) -> DataFrame:
    """What an earlier pull left: orders up to 1998, the finished ones still open then."""
    old = t.orders.where("o_orderdate < timestamp_ntz'1999-01-01'").withColumn(
        "o_orderstatus", F.when(F.col("o_orderstatus") == "F", "P").otherwise(F.col("o_orderstatus"))
    )
    return files.with_constants(old, source_data_updated=OLD, ingestion_check_time=OLD)


def staged_orders(t: Tables) -> DataFrame:
    """The current pull: all orders, delivered twice."""
    both = t.orders.unionByName(t.orders)
    return files.with_constants(both, source_data_updated=NEW, ingestion_check_time=NEW)


STORED_SQL = f"""
stored AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'P' ELSE o_orderstatus END
         AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         '{OLD}' AS source_data_updated, '{OLD}' AS ingestion_check_time
  FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
pull AS (
  SELECT *, '{NEW}' AS source_data_updated, '{NEW}' AS ingestion_check_time FROM orders
  UNION ALL
  SELECT *, '{NEW}', '{NEW}' FROM orders)"""
_COLS = ", ".join(ORDER_COLS)
MERGED_SQL = f"""
distinct_pull AS (SELECT DISTINCT *, 2 AS retention_priority FROM pull),
both_sides AS (SELECT *, 1 AS retention_priority FROM stored
               UNION ALL SELECT * FROM distinct_pull),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {_COLS} ORDER BY retention_priority) AS rn
           FROM both_sides)"""


@query(
    "raw_distinct_versions",
    f"WITH {STORED_SQL}, {MERGED_SQL} "
    f"SELECT {_COLS}, source_data_updated, ingestion_check_time FROM ranked WHERE rn = 1",
)
def _(t):
    """Stored and staged rows merged, one per distinct version, the stored copy kept."""
    return merge_distinct_versions(stored_orders(t), staged_orders(t), ORDER_COLS)


@query(
    "raw_new_versions",
    f"WITH {STORED_SQL}, {MERGED_SQL} SELECT {_COLS}, source_data_updated, ingestion_check_time "
    "FROM ranked WHERE rn = 1 AND retention_priority = 2",
)
def _(t):
    """Only the staged versions that the store lacks."""
    return new_versions(stored_orders(t), staged_orders(t), ORDER_COLS)


@query("raw_without_staging", f"WITH {STORED_SQL} SELECT * FROM stored")
def _(t):
    """No staging table: the store passes through."""
    return merge_distinct_versions(stored_orders(t), None, ORDER_COLS)


@query("pull_distinct_rows", f"WITH {STORED_SQL} SELECT DISTINCT * FROM pull")
def _(t):
    return distinct_pull(staged_orders(t), ORDER_COLS)


@query(
    "retention_ranking",
    f"WITH {STORED_SQL}, {MERGED_SQL} SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1",
)
def _(t):
    """Window form of the retention rule over the union of both sides."""
    one, two = F.lit(1).alias("retention_priority"), F.lit(2).alias("retention_priority")
    both = stored_orders(t).select("*", one).unionByName(
        distinct_pull(staged_orders(t), ORDER_COLS).select("*", two)
    )
    return keep_stored_copy(both, ORDER_COLS)


@query(
    "version_counts_by_publication",
    f"WITH {STORED_SQL}, {MERGED_SQL} SELECT source_data_updated, count(*) AS row_count "
    "FROM ranked WHERE rn = 1 GROUP BY 1",
)
def _(t):
    """How many new or changed rows each pull brought."""
    return version_counts(merge_distinct_versions(stored_orders(t), staged_orders(t), ORDER_COLS))


# ---------------------------------------------------------------- standardized

ORDERS_SPEC = DatasetSpec(
    "orders",
    ("customer", "document_num", "sale_date", "sale_price"),
    "sale_id",
    column_specs(
        bigint="o_custkey>customer",
        padded_int__8="o_orderkey>document_num",
        date="o_orderdate>sale_date",
        numeric_bigint="o_totalprice>sale_price",
        char__1="o_orderstatus>status",
        text="o_orderpriority>priority",
    ),
)
STANDARD_SQL = f"""
std AS (
  SELECT md5(concat_ws('-', o_custkey::VARCHAR, lpad(o_orderkey::VARCHAR, 8, '0'),
                       o_orderdate::DATE::VARCHAR,
                       round(o_totalprice::DECIMAL(38,10))::BIGINT::VARCHAR)) AS sale_id,
         lpad(o_orderkey::VARCHAR, 8, '0') AS document_num, o_custkey AS customer,
         upper(o_orderstatus) AS status,
         round(o_totalprice::DECIMAL(38,10))::BIGINT AS sale_price,
         o_orderdate::DATE AS sale_date, upper(o_orderpriority) AS priority,
         timezone('America/Chicago', replace(source_data_updated, 'Z', '')::TIMESTAMP)
           ::TIMESTAMP AS source_data_updated,
         timezone('America/Chicago', replace(ingestion_check_time, 'Z', '')::TIMESTAMP)
           ::TIMESTAMP AS ingestion_check_time
  FROM ranked WHERE rn = 1)"""


def standardized_orders(t: Tables) -> DataFrame:
    raw = merge_distinct_versions(stored_orders(t), staged_orders(t), ORDER_COLS)
    return standardize(raw, ORDERS_SPEC)


def plain_times(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names or META})


@query(
    "standardized_by_spec",
    f"WITH {STORED_SQL}, {MERGED_SQL}, {STANDARD_SQL} SELECT * FROM std",
)
def _(t):
    """Rename, retype and reorder by a declared spec, surrogate key in front."""
    return plain_times(standardized_orders(t))


@query(
    "standardized_by_type",
    """SELECT c_custkey, upper(c_name) AS c_name, c_nationkey, c_acctbal,
       upper(c_mktsegment) AS c_mktsegment FROM customer""",
)
def _(t):
    """The default spec, derived from the landed column types."""
    customer = t.customer
    return standardize(customer, auto_spec("customer", customer.schema, ("c_custkey",), "c_custkey"))


@query(
    "standard_column_names",
    """SELECT p_partkey AS part_key, p_name AS part_name_1, p_brand AS part_name,
       p_type AS easement, p_size AS size_class_1, p_retailprice AS size_class FROM part""",
)
def _(t):
    """Spaces and hyphens replaced, clashes numbered, lower-cased."""
    odd = t.part.toDF("Part Key", "Part Name", "Part_Name", "Easement", "size-class", "size_class")
    return with_standard_names(odd)


@query(
    "flagship_monthly_sales",
    f"""WITH {STORED_SQL}, {MERGED_SQL}, {STANDARD_SQL},
    clean AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY document_num
              ORDER BY source_data_updated DESC, sale_id DESC) AS rn FROM std) WHERE rn = 1),
    lagged AS (SELECT *, lag(sale_price) OVER w AS last_sale_price,
               lag(sale_date) OVER w AS last_sale_date FROM clean
               WINDOW w AS (PARTITION BY customer ORDER BY sale_date, sale_id)),
    feats AS (SELECT *, sale_price - last_sale_price AS price_change,
              nullif((sale_date - last_sale_date)::DOUBLE / 365.2422, 0) AS years FROM lagged)
    SELECT strftime(sale_date, '%Y-%m') AS month, count(sale_price) AS num_values,
           max(sale_price) AS max_value, round(avg(sale_price))::BIGINT AS mean_value,
           min(sale_price) AS min_value, quantile_cont(sale_price::DOUBLE, 0.5) AS median_value,
           count(price_change) AS num_resales, sum(price_change)::BIGINT AS total_change,
           count(*) FILTER (years >= 1.0 / 12) AS num_annualized
    FROM feats GROUP BY 1""",
)
def flagship(t: Tables) -> DataFrame:
    """Raw versions, standardized, latest per record, resale features, monthly statistics."""
    clean = latest_versions(standardized_orders(t), "document_num", tie_breakers=["sale_id"])
    clean = written(clean, "clean")  # a stored table, as later steps read it more than once
    feats = sale_features(
        clean, "customer", "sale_date", "sale_price", "sale_id", {}, class_column=None
    )
    stats = monthly_stats(clean, "sale_date", "sale_price")
    resales = feats.groupBy(F.date_format("sale_date", "yyyy-MM").alias("month")).agg(
        F.count("price_change_since_last_sale").alias("num_resales"),
        F.sum("price_change_since_last_sale").alias("total_change"),
        F.count_if(F.col("years_since_last_sale") >= 1.0 / 12).alias("num_annualized"),
    )
    return stats.join(resales, "month")


# ---------------------------------------------------------------- clean

LATEST_SQL = """SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC)
  AS rn FROM {src}) WHERE rn = 1"""
CURRENT_SQL = LATEST_SQL.format(src="(SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-29 12:00')")
DELTA_SQL = LATEST_SQL.format(
    src="""(SELECT * FROM events WHERE user_id IN (SELECT user_id FROM events
            WHERE ts > (SELECT max(ts) FROM current_rows)))"""
)


def current_events(t: Tables) -> DataFrame:
    """The clean table as it was before the last day and a half."""
    known = t.events.where("ts < timestamp_ntz'2024-01-29 12:00:00'")
    return latest_versions(known, "user_id", "ts", ["event_id"])


@query("clean_latest_versions", LATEST_SQL.format(src="events"))
def _(t):
    return latest_versions(t.events, "user_id", "ts", ["event_id"])


@query(
    "clean_incremental_delta", f"WITH current_rows AS ({CURRENT_SQL}) {DELTA_SQL}"
)
def _(t):
    """Latest version of the records changed since the clean table was built."""
    return latest_versions_incremental(t.events, current_events(t), "user_id", "ts", ["event_id"])


@query(
    "clean_merged",
    f"""WITH current_rows AS ({CURRENT_SQL}), delta AS ({DELTA_SQL})
    SELECT * FROM current_rows WHERE user_id NOT IN (SELECT user_id FROM delta)
    UNION ALL SELECT * FROM delta""",
)
def _(t):
    """Upsert: matched records replaced, others added."""
    current = current_events(t)
    delta = latest_versions_incremental(t.events, current, "user_id", "ts", ["event_id"])
    return upserted(current, delta, "user_id")


@query(
    "merge_with_schema_sync",
    """WITH target AS (SELECT c_custkey, c_name, c_acctbal FROM customer),
    delta AS (SELECT c_custkey, upper(c_name) AS c_name, c_mktsegment FROM customer
              WHERE c_acctbal < 0)
    SELECT c_custkey, c_name, NULL AS c_mktsegment FROM target
    WHERE c_custkey NOT IN (SELECT c_custkey FROM delta)
    UNION ALL SELECT * FROM delta""",
)
def _(t):
    """The target gains delta's new column and loses the one no longer delivered."""
    target = t.customer.select("c_custkey", "c_name", "c_acctbal")
    delta = t.customer.where("c_acctbal < 0").select(
        "c_custkey", F.upper("c_name").alias("c_name"), "c_mktsegment"
    )
    return upserted(target, delta, "c_custkey")


@query(
    "empty_watermark_delta",
    """WITH nothing AS (SELECT * FROM events WHERE ts < TIMESTAMP '1990-01-01')
    SELECT * FROM events WHERE ts > (SELECT max(ts) FROM nothing)""",
)
def _(t):
    """An empty clean table has no watermark, so nothing counts as newer."""
    nothing = t.events.where("ts < timestamp_ntz'1990-01-01'")
    return latest_versions_incremental(t.events, nothing, "user_id", "ts", ["event_id"])


# ---------------------------------------------------------------- layer tables


def _table(t: Tables, label: str) -> str:
    tables.create_layers(t.spark, ("civiclake_demo",))
    return f"civiclake_demo.{label}_{uuid.uuid4().hex[:12]}"


@query(
    "table_rebuilt_from_itself",
    """SELECT s_suppkey, upper(s_name) AS s_name, s_nationkey, s_acctbal FROM supplier""",
)
def _(t):
    """A full rebuild that reads the version it replaces."""
    name = _table(t, "supplier")
    first = tables.publish(t.supplier, name)
    return tables.publish(first.withColumn("s_name", F.upper("s_name")), name)


@query("table_stored_sorted", "SELECT * FROM orders WHERE o_custkey <= 50")
def _(t):
    """Stored in ranges of a key; a filter on it reads only the files that may hold it."""
    stored = tables.publish(t.orders, _table(t, "orders"), sort_by=["o_custkey", "o_orderdate"])
    return stored.where("o_custkey <= 50")


@query("table_view", "SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 1")
def _(t):
    """A lazy view by name."""
    tables.publish_view(t.nation.where("n_regionkey = 1").select("n_nationkey", "n_name"), "std.nations_1")
    return tables.read(t.spark, "SELECT * FROM nations_1")


@query("table_merged", """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END
AS c_acctbal FROM customer""")
def _(t):
    """Upsert into a stored table."""
    name = _table(t, "customer")
    tables.publish(t.customer.where("c_acctbal < 5000").select("c_custkey", "c_acctbal"), name)
    delta = t.customer.where("c_acctbal < 0 OR c_acctbal >= 5000").select(
        "c_custkey", F.greatest("c_acctbal", F.lit(0.0)).alias("c_acctbal")
    )
    return tables.merge(delta, name, "c_custkey")


@query(
    "staging_replaced_and_appended",
    """SELECT *, 'pull 2' AS pull FROM supplier WHERE s_acctbal >= 5000
       UNION ALL SELECT *, 'pull 3' FROM supplier WHERE s_acctbal < 5000""",
)
def _(t):
    """A staging table replaced by the next pull, then appended to, with constant columns."""
    name = _table(t, "temp_supplier")
    tables.publish(files.with_constants(t.supplier, pull="pull 1"), name)
    high, low = t.supplier.where("s_acctbal >= 5000"), t.supplier.where("s_acctbal < 5000")
    tables.publish(files.with_constants(high, pull="pull 2"), name)
    return tables.append(files.with_constants(low, pull="pull 3"), name)


@query("table_created_empty", "SELECT * FROM part WHERE false")
def _(t):
    return tables.create_like(t.spark, _table(t, "part"), t.part)


@query(
    "check_records_numbered",
    """SELECT 25 + row_number() OVER (ORDER BY s_suppkey) AS id, s_name AS table_name
       FROM supplier""",
)
def _(t):
    """New records get ids after the largest in use; the inserted rows come back."""
    name = _table(t, "checks")
    tables.record_checks(t.nation.select(F.col("n_name").alias("table_name"), "n_nationkey"), name,
                         ["n_nationkey"])
    more = t.supplier.select(F.col("s_name").alias("table_name"), F.col("s_suppkey").cast("int").alias("n_nationkey"))
    return tables.record_checks(more, name, ["n_nationkey"]).drop("n_nationkey")


@query(
    "insert_where_absent",
    """SELECT c_custkey, c_name, 1 AS batch FROM customer WHERE c_acctbal >= 0
       UNION ALL SELECT c_custkey, c_name, 2 FROM customer WHERE c_acctbal < 0""",
)
def _(t):
    """Insert, doing nothing where the key is there already."""
    name = _table(t, "customer")
    rows = t.customer.select("c_custkey", "c_name")
    first = files.with_constants(rows.join(t.customer.where("c_acctbal >= 0"), "c_custkey", "left_semi"), batch=1)
    tables.publish(first, name)
    return tables.insert_if_absent(files.with_constants(rows, batch=2), name, ["c_custkey"])


@query(
    "flag_updated_conditionally",
    """SELECT o_orderkey, (o_orderstatus = 'F') AS pulled FROM orders""",
)
def _(t):
    """One whitelisted field set where a condition holds."""
    rows = t.orders.select("o_orderkey", "o_orderstatus", F.lit(False).alias("pulled"))
    return tables.with_field_set(
        rows, F.col("o_orderstatus") == "F", {"pulled": True}, ("pulled",)
    ).drop("o_orderstatus")


@query(
    "catalog_lookups",
    """SELECT true AS layer_existed, 2::BIGINT AS staging_tables, true AS found, false AS still_there,
       count(*) AS n_rows FROM region""",
)
def _(t):
    """Does the layer exist, which staging tables are in it, and are they gone once dropped?"""
    layer = f"civiclake_{uuid.uuid4().hex[:8]}"
    tables.create_layers(t.spark, (layer,))
    tables.publish(t.region, f"{layer}.temp_region")
    tables.publish(t.nation, f"{layer}.temp_nation")
    tables.publish(t.region, f"{layer}.region")
    existed = t.spark.catalog.databaseExists(layer)
    found = tables.table_exists(t.spark, f"{layer}.temp_region")
    dropped = tables.drop_staging(t.spark, layer)
    still = tables.table_exists(t.spark, f"{layer}.temp_region")
    return tables.read(t.spark, f"{layer}.region").agg(
        F.lit(existed).alias("layer_existed"),
        F.lit(len(dropped)).cast("bigint").alias("staging_tables"),
        F.lit(found).alias("found"),
        F.lit(still).alias("still_there"),
        F.count(F.lit(1)).alias("n_rows"),
    )


@query("constants_stamped", f"""SELECT n_nationkey, n_name, '{NEW}' AS source_data_updated,
1 AS retention_priority FROM nation""")
def _(t):
    rows = t.nation.select("n_nationkey", "n_name")
    return files.with_constants(rows, source_data_updated=NEW, retention_priority=1)


@query(
    "dataset_refreshed",
    """SELECT lpad(o_orderkey::VARCHAR, 8, '0') AS document_num, upper(o_orderstatus) AS status,
       round(o_totalprice::DECIMAL(38,10))::BIGINT AS sale_price FROM orders""",
)
def _(t):
    """Two refreshes of one dataset: the second replaces what changed and adds what is new."""
    dataset = f"orders_{uuid.uuid4().hex[:12]}"
    spec = DatasetSpec(dataset, ("document_num",), "document_num", ORDERS_SPEC.columns)
    first = stored_orders(t).drop(*META)
    refresh(t.spark, spec, first, OLD)
    result = refresh(t.spark, spec, t.orders, NEW)
    return result.clean.select("document_num", "status", "sale_price")


SUITE = [
    expect("column_values_to_not_be_null", "o_orderkey"),
    expect("column_values_to_be_in_set", "o_orderstatus", value_set=["F", "O"]),
    expect("column_values_to_be_unique", "o_orderkey"),
    expect("column_max_to_be_between", "o_totalprice", min_value=0, max_value=1_000_000_000),
    expect("table_row_count_to_be_between", min_value=1),
]


@query(
    "dataset_refreshed_under_check",
    """WITH clean AS (SELECT lpad(o_orderkey::VARCHAR, 8, '0') AS document_num, upper(o_orderstatus) AS status,
         round(o_totalprice::DECIMAL(38,10))::BIGINT AS sale_price FROM orders)
    SELECT 'clean' AS section, document_num || ' ' || status AS item, sale_price AS n, NULL::BOOLEAN AS ok FROM clean
    UNION ALL SELECT 'mart', status || ' ' || count(*), sum(sale_price)::BIGINT, NULL FROM clean GROUP BY status
    UNION ALL SELECT 'check', d, NULL, ok FROM (VALUES ('2023-02-18', true), ('2023-07-06', true), ('2023-07-07', false)) AS v(d, ok)
    UNION ALL SELECT 'action', 'skip', NULL, NULL
    UNION ALL SELECT 'gate', 'closed', NULL, NULL WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderstatus NOT IN ('F', 'O'))
    UNION ALL SELECT 'staged', 'rows', count(*), NULL FROM orders
    UNION ALL SELECT 'report', 'expect_column_values_to_not_be_null', count(*) - count(o_orderkey), count(*) = count(o_orderkey) FROM orders
    UNION ALL SELECT 'report', 'expect_column_values_to_be_in_set', count(*) FILTER (o_orderstatus NOT IN ('F', 'O')),
      count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) = 0 FROM orders
    UNION ALL SELECT 'report', 'expect_column_values_to_be_unique', 0, count(DISTINCT o_orderkey) = count(*) FROM orders
    UNION ALL SELECT 'report', 'expect_column_max_to_be_between', NULL, max(o_totalprice) BETWEEN 0 AND 1000000000 FROM orders
    UNION ALL SELECT 'report', 'expect_table_row_count_to_be_between', NULL, count(*) >= 1 FROM orders""",
)
def _(t):
    """Three refreshes, each with a check of the source: one as a gate lets it, one with a failing suite and a
    mart, one with nothing new; and one that the gate stops."""
    dataset = f"orders_{uuid.uuid4().hex[:12]}"
    spec = DatasetSpec(dataset, ("document_num",), "document_num", ORDERS_SPEC.columns)

    def check(updated: str, at: str) -> DataFrame:
        return t.spark.sql(
            f"SELECT '{dataset}' AS table_id, timestamp'{updated}' AS source_data_last_updated, "
            f"CAST(NULL AS timestamp) AS source_metadata_last_updated, timestamp'{at}' AS time_of_check"
        )

    def by_status(ref):
        sums = ref(f"clean.{dataset}_clean").groupBy("status")
        return sums.agg(F.count(F.lit(1)).alias("n"), F.sum("sale_price").alias("total"))

    mart = f"dwh.{dataset}_by_status"
    first = stored_orders(t).drop(*META).where("o_orderstatus = 'O'")
    refresh(t.spark, spec, first, OLD, check("2023-02-17", "2023-02-18"), SUITE, gate=True)
    result = refresh(t.spark, spec, t.orders, NEW, check("2023-07-05", "2023-07-06"), SUITE, models={mart: by_status})
    last = refresh(t.spark, spec, t.orders, NEW, check("2023-07-05", "2023-07-07"), SUITE, gate=True)
    gate = "open"
    try:
        refresh(t.spark, spec, t.orders, NEW, suite=SUITE, gate=True)
    except GateFailed:
        gate = "closed"
    none, unknown = F.lit(None).cast("bigint"), F.lit(None).cast("boolean")

    def section(df: DataFrame, name: str, item, n=none, ok=unknown) -> DataFrame:
        return df.select(F.lit(name).alias("section"), item.alias("item"), n.alias("n"), ok.alias("ok"))

    one = t.spark.range(1)
    checks = t.spark.table(CHECKS).where(F.col("table_id") == dataset)
    clean, report, sums = result.clean, result.report, result.marts[mart]
    parts = [
        section(clean, "clean", F.concat_ws(" ", "document_num", "status"), F.col("sale_price")),
        section(sums, "mart", F.concat_ws(" ", "status", "n"), F.col("total")),
        section(checks, "check", F.date_format("time_of_check", "yyyy-MM-dd"), ok=F.col("data_pulled_this_check")),
        section(one, "action", F.lit(last.action)),
        section(one, "gate", F.lit(gate)).where("item = 'closed'"),
        section(one, "staged", F.lit("rows"), F.lit(result.staged_rows).cast("bigint")),
        section(report, "report", F.col("expectation"), F.col("unexpected_count"), F.col("success")),
    ]
    return reduce(DataFrame.unionByName, parts)

"""Freshness and source metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from civiclake.operators import freshness as R
from civiclake.operators import metadata as M
from civiclake.plans.scratch import written
from civiclake.queries.base import query
from civiclake.queries.landed import LISTING_SQL, listing_pages
from civiclake.sources.documents import listing_rows


@query(
    "freshness_of_all_tables",
    """WITH pulls AS (SELECT o_custkey, max(o_orderdate) AS pulled FROM orders
      WHERE o_orderstatus = 'F' GROUP BY 1),
    src AS (SELECT c_custkey AS table_id,
      CASE WHEN c_nationkey <> 5 THEN TIMESTAMP '2000-06-01' + INTERVAL 1 DAY * (c_nationkey * 30) END
        AS source_data_last_updated,
      CASE WHEN c_mktsegment <> 'BUILDING' THEN TIMESTAMP '2000-01-01' + INTERVAL 1 DAY * (c_nationkey * 20)
        END AS source_metadata_last_updated FROM customer),
    f AS (SELECT src.*, pulled IS NULL OR coalesce(source_data_last_updated > pulled, false)
      AS updated_data_available, pulled IS NULL OR
      coalesce(source_metadata_last_updated > pulled, false) AS updated_metadata_available
      FROM src LEFT JOIN pulls ON o_custkey = table_id)
    SELECT *, CASE WHEN NOT updated_data_available AND NOT updated_metadata_available THEN false
    END AS data_pulled_this_check FROM f""",
)
def _(t):
    """Flags of the current check of every table from all checks before."""
    c = F.col

    def day(start: str, step: int):
        since = F.lit(start).cast("timestamp_ntz")
        return since + F.make_dt_interval(days=c("c_nationkey") * step)

    sources = t.customer.select(
        c("c_custkey").alias("table_id"),
        F.when(c("c_nationkey") != 5, day("2000-06-01", 30)).alias("source_data_last_updated"),
        F.when(c("c_mktsegment") != "BUILDING", day("2000-01-01", 20)).alias(
            "source_metadata_last_updated"
        ),
    )
    checks = t.orders.select(
        c("o_custkey").alias("table_id"),
        c("o_orderdate").alias("time_of_check"),
        (c("o_orderstatus") == "F").alias("data_pulled_this_check"),
    )
    return R.checked_sources(sources, checks)


@query(
    "stale_datasets",
    """WITH s AS (SELECT p_partkey AS dataset_name, TIMESTAMP '2001-01-01' + INTERVAL 1 DAY * (p_size * 20)
      AS source_data_last_modified FROM part),
    l AS (SELECT l_partkey, max(l_shipdate) AS local_modified FROM lineitem
      WHERE l_returnflag = 'R' GROUP BY 1)
    SELECT s.*, local_modified, NOT coalesce(local_modified >= source_data_last_modified, false)
    AS needs_refresh FROM s LEFT JOIN l ON l_partkey = dataset_name""",
)
def _(t):
    c = F.col
    since = F.lit("2001-01-01").cast("timestamp_ntz")
    sources = t.part.select(
        c("p_partkey").alias("dataset_name"),
        (since + F.make_dt_interval(days=c("p_size") * 20)).alias("source_data_last_modified"),
    )
    local = t.lineitem.where("l_returnflag = 'R'").select(
        c("l_partkey").alias("dataset_name"), c("l_shipdate").alias("source_data_last_modified")
    )
    return R.stale_datasets(sources, local)


@query(
    "changed_listing_entries",
    f"""WITH {LISTING_SQL}, cache AS (SELECT metadata_url, max(last_modified) AS cached FROM
      (SELECT metadata_url, last_modified - INTERVAL 1 DAY * (CASE WHEN size = '-' THEN 0 ELSE 3 END)
       AS last_modified FROM listing WHERE last_modified < TIMESTAMP '2000-01-01') GROUP BY 1)
    SELECT metadata_url, last_modified, size, cached IS NULL OR last_modified > cached
    AS updated_metadata_available FROM listing LEFT JOIN cache USING (metadata_url)""",
)
def _(t):
    """New or newer entries of directory pages against the cached ones."""
    rows = listing_rows(listing_pages(t), "html", "url").select(
        "metadata_url", F.col("last_modified").cast("timestamp_ntz").alias("last_modified"), "size"
    )
    rows = written(rows, "listing")  # pages are read for their rows once, not again for the cache
    lag = F.make_dt_interval(days=F.when(F.col("size") == "-", 0).otherwise(3))
    known = rows.where("last_modified < timestamp_ntz'2000-01-01'")
    cache = known.withColumn("last_modified", F.col("last_modified") - lag)
    return R.changed_listing(rows, cache)


@query(
    "next_actions",
    """SELECT c_custkey, CASE WHEN NOT coalesce(c_acctbal > 1000, false) THEN 'skip'
    WHEN c_nationkey < 10 THEN 'update_table' ELSE 'create_table' END AS action FROM customer""",
)
def _(t):
    fresh, exists = F.col("c_acctbal") > 1000, F.col("c_nationkey") < 10
    return t.customer.select("c_custkey", R.next_action(exists, fresh).alias("action"))


def metadata_documents(t):
    """One landed metadata document per customer, of changing kind."""
    c, lit = F.col, F.lit
    id_text = F.format_string("%04d-abcd", c("c_custkey"))
    geo = c("c_nationkey") % 3
    kinds = F.when(geo == 0, F.array(lit("Text"), lit("MultiPolygon"))).when(
        geo == 1, F.array(lit("Text"), lit("Number"))
    )
    resource = F.struct(
        c("c_name").alias("name"),
        lit("2022-11-22T05:18:10.000Z").alias("metadata_updated_at"),
        F.when(c("c_acctbal") > 0, "2022-12-01T06:16:57.123Z").alias("data_updated_at"),
        F.when(geo == 2, F.array().cast("array<string>"))
        .otherwise(F.array(lit("a"), lit("b")))
        .alias("columns_name"),
        kinds.alias("columns_datatype"),
        F.when(c("c_mktsegment") == "BUILDING", "geo").otherwise("tabular").alias("lens_view_type"),
        F.when(c("c_mktsegment") == "MACHINERY", "map").otherwise("table").alias("lens_display_type"),
    )
    pairs = F.array(
        F.struct(lit("Owner").alias("key"), c("c_name").alias("value")),
        F.struct(lit("Owner").alias("key"), c("c_mktsegment").alias("value")),
    )
    doc = F.struct(
        id_text.alias("_id"),
        lit("2022-12-27T02:32:07.5Z").alias("time_of_collection"),
        resource.alias("resource"),
        F.struct(pairs.alias("domain_metadata")).alias("classification"),
        F.struct(lit("data.example.org").alias("domain")).alias("metadata"),
    )
    return t.customer.select("c_custkey", F.to_json(doc).alias("metadata_json"))


GEO_SQL = """(c_nationkey % 3 = 0 OR (c_nationkey % 3 = 2 AND
  c_mktsegment IN ('BUILDING', 'MACHINERY')))"""


@query(
    "metadata_check_records",
    f"""WITH g AS (SELECT *, printf('%04d-abcd', c_custkey) AS id, {GEO_SQL} AS geo FROM customer)
    SELECT id AS table_id, 'customer_' || split_part(c_name, '#', 2) AS table_name,
    CASE WHEN geo THEN 'GeoJSON' ELSE 'csv' END AS download_format, geo AS is_geospatial,
    CASE WHEN geo THEN 'https://data.example.org/api/geospatial/' || id ||
      '?method=export&format=GeoJSON'
      ELSE 'https://data.example.org/api/views/' || id || '/rows.csv?accessType=DOWNLOAD' END
      AS data_download_url,
    CASE WHEN c_acctbal > 0 THEN TIMESTAMP '2022-12-01 06:16:57' END AS source_data_last_updated,
    TIMESTAMP '2022-11-22 05:18:10' AS source_metadata_last_updated,
    TIMESTAMP '2022-12-27 02:32:07.5' AS time_of_check FROM g""",
)
def _(t):
    """Geospatial or not, format, address and dates of every source table."""
    rows = M.check_records(metadata_documents(t)).drop(
        "updated_data_available",
        "updated_metadata_available",
        "data_pulled_this_check",
        "metadata_json",
    )
    times = [c for c, kind in rows.dtypes if kind == "timestamp"]
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


@query(
    "metadata_classification",
    """SELECT c_custkey, c_mktsegment = 'BUILDING' AS geo_view, c_mktsegment = 'MACHINERY' AS map_display,
    c_nationkey % 3 <> 2 AS has_columns, c_mktsegment AS owner FROM customer""",
)
def _(t):
    """The parts of the classification, and a key/value list as a map."""
    meta = F.col("meta")
    return M.parsed_metadata(metadata_documents(t)).select(
        "c_custkey",
        M.has_geo_view(meta).alias("geo_view"),
        M.has_map_display(meta).alias("map_display"),
        M.has_data_columns(meta).alias("has_columns"),
        M.domain_metadata(meta)["Owner"].alias("owner"),
    )


@query(
    "metadata_rows_stamped",
    """SELECT p_partkey, p_name, (SELECT max(o_orderkey) FROM orders) AS dataset_id,
    (SELECT max(o_orderdate) FROM orders) AS modified FROM part""",
)
def _(t):
    """The current check's id and date on every metadata row."""
    check = t.orders.agg(
        F.max("o_orderkey").alias("dataset_id"), F.max("o_orderdate").alias("modified")
    )
    return M.stamped(t.part.select("p_partkey", "p_name"), check, ["dataset_id", "modified"])

"""The parcel domain on the benchmark tables: customers as parcels, orders as their sales."""

from __future__ import annotations

from pyspark.sql import functions as F

from civiclake.functions.text import surrogate_key
from civiclake.plans import parcels as P
from civiclake.queries import shapes
from civiclake.queries.base import query
from civiclake.queries.scalars import CLASS_VALUES
from civiclake.queries.spatial import BOUNDARY_TEXT_SQL
from civiclake.queries.stores import plain_times


def sales_clean(t):
    """All orders, moved off the customers divisible by 7, so that some parcels are unsold."""
    c = F.col
    price = F.round(c("o_totalprice").cast("decimal(38,10)")).cast("bigint")
    orders = t.orders.withColumn("o_custkey", F.expr("o_custkey + if(o_custkey % 7 = 0, 1, 0)"))
    rows = orders.select(
        c("o_custkey").alias("pin"),
        F.upper(F.concat(F.lit("doc"), c("o_orderkey").cast("string"))).alias("sale_document_num"),
        c("o_orderdate").cast("date").alias("sale_date"),
        (c("o_orderstatus") == "F").alias("is_mydec_date"),
        F.year("o_orderdate").alias("year"),
        price.alias("sale_price"),
        c("o_orderpriority").alias("sale_deed_type"),
        c("o_orderstatus").alias("sale_type"),
        (F.lit(200) + c("o_orderkey") % 100).cast("string").alias("class"),
        (c("o_custkey") % 38).alias("township_code"),
        (c("o_orderstatus") == "P").alias("is_multisale"),
        F.length("o_orderpriority").alias("num_parcels_sale"),
        F.concat(F.lit("SELLER "), c("o_orderkey").cast("string")).alias("sale_seller_name"),
        F.concat(F.lit("BUYER "), c("o_orderkey").cast("string")).alias("sale_buyer_name"),
        c("o_orderdate").cast("timestamp").alias("source_data_updated"),
        c("o_orderdate").cast("timestamp").alias("ingestion_check_time"),
    )
    key = surrogate_key(["pin", "sale_document_num", "sale_date", "sale_price"])
    return rows.select(key.alias("parcel_sale_id"), "*")


SALES_SQL = """sales AS (SELECT md5(concat_ws('-', o_custkey::VARCHAR, 'DOC' || o_orderkey,
    o_orderdate::DATE::VARCHAR, round(o_totalprice::DECIMAL(38,10))::BIGINT::VARCHAR))
    AS parcel_sale_id,
  o_custkey AS pin, 'DOC' || o_orderkey AS sale_document_num, o_orderdate::DATE AS sale_date,
  o_orderstatus = 'F' AS is_mydec_date, round(o_totalprice::DECIMAL(38,10))::BIGINT AS sale_price,
  o_orderpriority AS sale_deed_type, o_orderstatus AS sale_type,
  (200 + o_orderkey % 100)::VARCHAR AS class, o_custkey % 38 AS township_code,
  o_orderstatus = 'P' AS is_multisale, length(o_orderpriority)::INTEGER AS num_parcels_sale,
  'SELLER ' || o_orderkey AS sale_seller_name, 'BUYER ' || o_orderkey AS sale_buyer_name,
  o_orderdate AS source_data_updated, o_orderdate AS ingestion_check_time
  FROM (SELECT * REPLACE (o_custkey + CASE WHEN o_custkey % 7 = 0 THEN 1 ELSE 0 END AS o_custkey)
    FROM orders))"""


def locations_clean(t):
    c = F.col
    x, y = shapes.position(c("c_custkey"))
    placed = c("c_acctbal") >= 0
    town = F.format_string("%02d", c("c_nationkey"))
    flag = (c("c_nationkey") % 2) == 0
    return t.customer.select(
        c("c_custkey").alias("pin"),
        F.upper("c_name").alias("property_address"),
        F.lit(None).cast("string").alias("property_apt_no"),
        F.when(c("c_mktsegment") == "MACHINERY", "EVANSTON").otherwise("CHICAGO").alias("property_city"),
        F.format_string("606%02d", c("c_nationkey")).alias("property_zip"),
        F.format_string("%03d", c("c_custkey") % 1000).alias("nbhd"),
        F.when(c("c_nationkey") != 7, town).alias("township"),
        c("c_mktsegment").alias("township_name"),
        c("c_mktsegment").alias("municipality"),
        F.format_string("%04d", c("c_nationkey")).alias("municipality_fips"),
        (c("c_nationkey") * 2).alias("ward"),
        F.format_string("%011d", c("c_custkey")).alias("tract_geoid"),
        F.when(c("c_nationkey") == 5, None)
        .when(c("c_mktsegment") == "BUILDING", "PO BOX")
        .otherwise(F.upper("c_name"))
        .alias("mailing_address"),
        c("c_mktsegment").alias("mailing_city"),
        F.lit("60601").alias("mailing_zip"),
        F.lit("IL").alias("mailing_state"),
        flag.alias("ohare_noise"),
        (~flag).alias("floodplain"),
        flag.alias("fs_flood_factor"),
        c("c_nationkey").alias("fs_flood_risk_direction"),
        flag.alias("withinmr100"),
        flag.alias("withinmr101300"),
        F.when(placed, x.cast("double")).alias("longitude"),
        F.when(placed, y.cast("double")).alias("latitude"),
    )


LOCATIONS_SQL = """locations AS (SELECT c_custkey AS pin, upper(c_name) AS property_address,
  NULL::VARCHAR AS property_apt_no,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'EVANSTON' ELSE 'CHICAGO' END AS property_city,
  printf('606%02d', c_nationkey) AS property_zip, printf('%03d', c_custkey % 1000) AS nbhd,
  CASE WHEN c_nationkey <> 7 THEN printf('%02d', c_nationkey) END AS township,
  c_mktsegment AS township_name, c_mktsegment AS municipality,
  printf('%04d', c_nationkey) AS municipality_fips, c_nationkey * 2 AS ward,
  printf('%011d', c_custkey) AS tract_geoid,
  CASE WHEN c_nationkey = 5 THEN NULL WHEN c_mktsegment = 'BUILDING' THEN 'PO BOX'
    ELSE upper(c_name) END AS mailing_address, c_mktsegment AS mailing_city,
  '60601' AS mailing_zip, 'IL' AS mailing_state, c_nationkey % 2 = 0 AS ohare_noise,
  c_nationkey % 2 <> 0 AS floodplain, c_nationkey % 2 = 0 AS fs_flood_factor,
  c_nationkey AS fs_flood_risk_direction, c_nationkey % 2 = 0 AS withinmr100,
  c_nationkey % 2 = 0 AS withinmr101300,
  CASE WHEN c_acctbal >= 0 THEN (c_custkey * 37 % 1000)::DOUBLE END AS longitude,
  CASE WHEN c_acctbal >= 0 THEN (c_custkey * 91 % 1000)::DOUBLE END AS latitude
  FROM customer),
city_points AS (SELECT pin AS id, longitude AS x, latitude AS y FROM locations
  WHERE property_city = 'CHICAGO' AND longitude IS NOT NULL)"""
FEATURE_SQL = f"""{shapes.districts_sql('city_points')}, {shapes.beats_sql('city_points')},
{shapes.areas_sql('city_points')},
buyers AS (SELECT pin, sale_buyer_name AS owner_name, row_number() OVER (PARTITION BY pin
  ORDER BY sale_date DESC NULLS FIRST, parcel_sale_id DESC) AS rn FROM sales),
feature AS (SELECT l.pin, concat(township, nbhd) AS town_nbhd,
  CASE WHEN property_address = mailing_address THEN true
       WHEN property_address <> mailing_address THEN false END AS owner_occupied,
  owner_name, b.name AS cpd_beat, d.name AS cpd_district, a.name AS chicago_community
  FROM locations l JOIN buyers u ON u.pin = l.pin AND rn = 1
  LEFT JOIN district_in d ON d.id = l.pin LEFT JOIN beat_in b ON b.id = l.pin
  LEFT JOIN area_in a ON a.id = l.pin)"""
SALE_FEATURE_SQL = f"""codes(code, descr) AS (VALUES {CLASS_VALUES}),
lagged AS (SELECT s.*, lag(sale_date) OVER w AS last_sale_date,
  lag(sale_price) OVER w AS last_sale_price, lag(is_multisale) OVER w AS last_sale_was_multisale,
  lag(num_parcels_sale) OVER w AS num_parcels_last_sale FROM sales s
  WINDOW w AS (PARTITION BY pin ORDER BY sale_date, parcel_sale_id)),
sale_feature AS (SELECT parcel_sale_id, pin, class, descr AS class_descr, sale_price, sale_date,
  is_multisale, num_parcels_sale, last_sale_price, last_sale_date, last_sale_was_multisale,
  num_parcels_last_sale, sale_price - last_sale_price AS price_change_since_last_sale,
  nullif((sale_date - last_sale_date)::DOUBLE / 365.2422, 0) AS years_since_last_sale
  FROM lagged LEFT JOIN codes ON class = code)"""
ROI_SQL = """printf('%.9e', (power(1 + price_change_since_last_sale::DOUBLE
  / nullif(last_sale_price, 0), 1 / CASE WHEN years_since_last_sale < 1.0 / 12 THEN NULL
  ELSE years_since_last_sale END) - 1) * 100) AS annualized_roi"""


def _roi_text(df):
    roi = F.col("annualized_roi")
    return df.withColumn(
        "annualized_roi", F.when(roi.isNotNull(), F.format_string("%.9e", roi))
    )


def locations_feature(t):
    return P.parcel_locations_feature(
        locations_clean(t),
        sales_clean(t),
        shapes.districts(t.region),
        shapes.beats(t.nation),
        shapes.areas(t.nation),
    )


def _flat(df):
    return df.withColumns(
        {"x": F.col("geometry.x"), "y": F.col("geometry.y"), "srid": F.col("geometry.srid")}
    ).drop("geometry")


@query("parcel_sales_feature", f"WITH {SALES_SQL}, {SALE_FEATURE_SQL} SELECT *, {ROI_SQL} FROM sale_feature")
def _(t):
    return _roi_text(P.parcel_sales_feature(sales_clean(t)))


@query(
    "parcel_locations_feature",
    f"""WITH {SALES_SQL}, {LOCATIONS_SQL}, {FEATURE_SQL}
    SELECT f.*, longitude AS x, latitude AS y,
    CASE WHEN longitude IS NOT NULL THEN 4326 END AS srid
    FROM feature f JOIN locations USING (pin)""",
)
def _(t):
    return _flat(locations_feature(t))


@query(
    "parcel_locations_dim",
    f"""WITH {SALES_SQL}, {LOCATIONS_SQL}, {FEATURE_SQL}
    SELECT l.* EXCLUDE (mailing_address, mailing_city, mailing_zip, mailing_state),
    town_nbhd, owner_occupied, owner_name, cpd_beat, cpd_district, chicago_community,
    longitude AS x, latitude AS y, CASE WHEN longitude IS NOT NULL THEN 4326 END AS srid
    FROM locations l JOIN feature f USING (pin)""",
)
def _(t):
    return _flat(P.parcel_locations_dim(locations_clean(t), locations_feature(t)))


@query(
    "parcel_owner_fact",
    f"""WITH {SALES_SQL}, {LOCATIONS_SQL}, {FEATURE_SQL}
    SELECT pin, owner_occupied, mailing_address, mailing_city, mailing_zip, mailing_state
    FROM feature JOIN locations USING (pin)""",
)
def _(t):
    return P.parcel_owner_fact(locations_clean(t), locations_feature(t))


@query(
    "parcel_sales_fact",
    f"""WITH {SALES_SQL}, {SALE_FEATURE_SQL},
    details AS (SELECT parcel_sale_id AS detail_id, sale_document_num, is_mydec_date,
      sale_deed_type, sale_type, township_code, sale_seller_name, sale_buyer_name,
      source_data_updated, ingestion_check_time FROM sales)
    SELECT f.*, {ROI_SQL}, d.* EXCLUDE (detail_id)
    FROM sale_feature f
    FULL OUTER JOIN details d ON parcel_sale_id = detail_id""",
)
def _(t):
    """Every sale's features next to its details."""
    sales = sales_clean(t)
    return plain_times(_roi_text(P.parcel_sales_fact(P.parcel_sales_feature(sales), sales)))


@query(
    "parcel_assessments_fact",
    """WITH a AS (SELECT md5(o_orderkey::VARCHAR) AS parcel_assessment_id, o_custkey AS pin,
      year(o_orderdate)::INTEGER AS tax_year, o_orderstatus AS class,
      printf('%02d', o_custkey % 38) AS township_code, o_orderpriority AS township_name,
      round(o_totalprice::DECIMAL(38,10))::BIGINT::DOUBLE AS v FROM orders),
    w AS (SELECT *, lag(class) OVER k AS class_last_assessment, v - lag(v) OVER k AS change
      FROM a WINDOW k AS (PARTITION BY pin ORDER BY tax_year, parcel_assessment_id))
    SELECT parcel_assessment_id, pin, make_date(tax_year, 1, 1) AS tax_year, class,
    class_last_assessment, township_code, township_name, v AS mailed_bldg, v * 2 AS mailed_land,
    v * 3 AS mailed_tot, v AS certified_bldg, v * 2 AS certified_land, v * 3 AS certified_tot,
    v AS board_bldg, v * 2 AS board_land, v * 3 AS board_tot, change AS mailed_bldg_change,
    change * 2 AS mailed_land_change, change * 3 AS mailed_tot_change,
    change AS certified_bldg_change, change * 2 AS certified_land_change,
    change * 3 AS certified_tot_change, change AS board_bldg_change,
    change * 2 AS board_land_change, change * 3 AS board_tot_change FROM w""",
)
def _(t):
    """Nine assessed values with their changes over one window."""
    c = F.col
    value = F.round(c("o_totalprice").cast("decimal(38,10)")).cast("bigint").cast("double")
    factor = {"bldg": 1, "land": 2, "tot": 3}
    rows = t.orders.select(
        F.md5(c("o_orderkey").cast("string")).alias("parcel_assessment_id"),
        c("o_custkey").alias("pin"),
        F.year("o_orderdate").alias("tax_year"),
        c("o_orderstatus").alias("class"),
        F.format_string("%02d", c("o_custkey") % 38).alias("township_code"),
        c("o_orderpriority").alias("township_name"),
        *[(value * factor[a.split("_")[1]]).alias(a) for a in P.ASSESSED],
    )
    return P.parcel_value_assessments_fact(rows)


@query(
    "parcel_sales_mart",
    f"""WITH {SALES_SQL}, {LOCATIONS_SQL}, {FEATURE_SQL}, {SALE_FEATURE_SQL},
    texts AS ({BOUNDARY_TEXT_SQL})
    SELECT pin, chicago_community, cpd_beat, cpd_district, property_address, ward, tract_geoid,
    ohare_noise, floodplain, fs_flood_factor, fs_flood_risk_direction, withinmr100,
    withinmr101300, s.* EXCLUDE (pin), sale_document_num, is_mydec_date, sale_deed_type,
    sale_type, township_code, sale_seller_name, sale_buyer_name, chi_nbhd_boundary
    FROM feature f JOIN locations USING (pin) JOIN sale_feature s USING (pin)
    JOIN (SELECT parcel_sale_id, sale_document_num, is_mydec_date, sale_deed_type, sale_type,
          township_code, sale_seller_name, sale_buyer_name FROM sales) d USING (parcel_sale_id)
    LEFT JOIN texts ON community = chicago_community
    WHERE chicago_community IS NOT NULL""",
)
def _(t):
    """Denormalized sales with the boundary text of their area, once per part of the area."""
    sales = sales_clean(t)
    dim = P.parcel_locations_dim(locations_clean(t), locations_feature(t))
    fact = P.parcel_sales_fact(P.parcel_sales_feature(sales), sales)
    return P.chicago_parcel_sales_mart(dim, fact, shapes.areas(t.nation))

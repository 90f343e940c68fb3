"""Points, boundaries, spatial joins and hulls."""

from __future__ import annotations

from pyspark.sql import functions as F

from civiclake.functions import geometry as G
from civiclake.operators import spatial as S
from civiclake.queries import shapes
from civiclake.queries.base import query

ORDER_POINTS_SQL = """order_points AS (SELECT o_orderkey AS id, (o_orderkey * 37) % 1000 AS x,
  (o_orderkey * 91) % 1000 AS y FROM orders)"""


def order_points(t):
    x, y = shapes.position(F.col("o_orderkey"))
    return t.orders.select("o_orderkey", x.alias("x"), y.alias("y"))


@query(
    "points_made",
    """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN 4326 END AS srid,
    CASE WHEN c_acctbal >= 0 THEN (c_custkey * 37 % 1000)::DOUBLE END AS x,
    CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS y FROM customer""",
)
def _(t):
    """A point from two coordinates; NULL when one is missing; identity transformation."""
    known = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    made = G.transformed(G.with_srid(G.point(shapes.position(F.col("c_custkey"))[0], known, 0), 4326), 4326)
    rows = t.customer.select("c_custkey", made.alias("p"))
    return rows.select("c_custkey", "p.srid", "p.x", "p.y")


@query(
    "points_in_areas",
    f"""WITH {ORDER_POINTS_SQL}, {shapes.areas_sql('order_points')}
    SELECT id AS o_orderkey, x, y, name AS area FROM order_points LEFT JOIN area_in USING (id)""",
)
def _(t):
    """Left spatial join: holes, second parts and borders decided exactly."""
    return S.join_containing(
        order_points(t), shapes.areas(t.nation), "x", "y", "geometry_parts", {"community": "area"}
    )


@query(
    "points_in_areas_shuffled",
    f"""WITH {ORDER_POINTS_SQL}, {shapes.areas_sql('order_points')}
    SELECT id AS o_orderkey, x, y, name AS area FROM order_points LEFT JOIN area_in USING (id)""",
)
def _(t):
    """The same join with both sides shuffled by cell, crowded cells in parts, as for a very large boundary layer."""
    return S.join_containing(
        order_points(t),
        shapes.areas(t.nation),
        "x",
        "y",
        "geometry_parts",
        {"community": "area"},
        broadcast_bytes=0,
        cell_points=20,
    )


@query(
    "points_in_three_layers",
    f"""WITH {ORDER_POINTS_SQL}, {shapes.districts_sql('order_points')},
    {shapes.beats_sql('order_points')}, {shapes.areas_sql('order_points')}
    SELECT p.id AS o_orderkey, x, y, d.name AS district, b.name AS beat, a.name AS area
    FROM order_points p LEFT JOIN district_in d USING (id) LEFT JOIN beat_in b USING (id)
    LEFT JOIN area_in a USING (id)""",
)
def _(t):
    """Three left spatial joins in a row; points on shared borders are in no beat."""
    layers = [
        S.Layer(shapes.districts(t.region), {"dist_num": "district"}),
        S.Layer(shapes.beats(t.nation), {"beat_num": "beat"}),
        S.Layer(shapes.areas(t.nation), {"community": "area"}),
    ]
    return S.join_layers(order_points(t), layers, "x", "y")


@query(
    "polygon_parts",
    """SELECT n_name AS community, unnest([2, 1])::INTEGER AS rings FROM nation""",
)
def _(t):
    """One row per part of a boundary."""
    parts = S.polygon_parts(shapes.areas(t.nation), "geometry_parts")
    return parts.select("community", F.size("part").alias("rings"))


def _ring_text(corners) -> str:
    pairs = [
        f"'[' || ({x} + (n_nationkey % 5) * 200) || ',' || ({y} + (n_nationkey // 5) * 200) || ']'"
        for x, y in corners
    ]
    return "'[' || " + " || ',' || ".join(pairs) + " || ']'"


BOUNDARY_TEXT_SQL = f"""SELECT n_name AS community, unnest([
  '{{"type" : "Polygon", "geometry" : {{"type":"Polygon","coordinates":[' || {_ring_text(shapes.OUTLINE)}
    || ',' || {_ring_text(shapes.HOLE)} || ']}}}}',
  '{{"type" : "Polygon", "geometry" : {{"type":"Polygon","coordinates":[' || {_ring_text(shapes.SECOND)}
    || ']}}}}']) AS chi_nbhd_boundary FROM nation"""


@query("boundary_json", BOUNDARY_TEXT_SQL)
def _(t):
    """GeoJSON text of every part."""
    parts = S.polygon_parts(shapes.areas(t.nation), "geometry_parts")
    return parts.select("community", G.feature_json("part").alias("chi_nbhd_boundary"))


def landed_geometries(t):
    """Landed geometries of mixed kinds, some empty, some missing, derived from suppliers."""
    key = F.col("s_suppkey")
    x, y = shapes.position(key)
    coords = F.format_string("[%d,%d]", x, y)
    made = F.struct(
        F.when(F.col("s_acctbal") < 0, "LineString").otherwise("Point").alias("type"),
        F.when(F.col("s_acctbal") > 8000, "[]")
        .when(F.col("s_acctbal") < 0, F.concat(F.lit("["), coords, F.lit(","), coords, F.lit("]")))
        .otherwise(coords)
        .alias("coordinates"),
    )
    landed = F.when(F.col("s_nationkey") != 3, made)
    return t.supplier.select("s_suppkey", landed.alias("geometry"))


LANDED_SQL = """landed AS (SELECT s_suppkey, s_nationkey <> 3 AS present,
  CASE WHEN s_acctbal < 0 THEN 'LineString' ELSE 'Point' END AS kind,
  s_acctbal > 8000 AS bare, s_suppkey * 37 % 1000 AS x, s_suppkey * 91 % 1000 AS y
  FROM supplier)"""


@query(
    "geometry_checks",
    f"""WITH {LANDED_SQL}
    SELECT s_suppkey, (present AND NOT bare) AS has_content,
    (NOT present OR kind = 'Point') AS is_point,
    CASE WHEN present AND kind = 'Point' AND NOT bare THEN x END::DOUBLE AS x,
    CASE WHEN present AND kind = 'Point' AND NOT bare THEN y END::DOUBLE AS y FROM landed""",
)
def _(t):
    """Empty to NULL, declared kind checked, points read."""
    rows = landed_geometries(t).select(
        "s_suppkey",
        G.empty_to_null("geometry").isNotNull().alias("has_content"),
        G.checked_kind("geometry", "POINT", flag_only=True).alias("is_point"),
        G.point_from_geojson("geometry").alias("p"),
    )
    return rows.select("s_suppkey", "has_content", "is_point", "p.x", "p.y")


@query(
    "missing_geometry_imputed",
    f"""WITH {LANDED_SQL}, usual AS (SELECT kind FROM landed WHERE present GROUP BY 1
      ORDER BY count(*) DESC, 1 LIMIT 1)
    SELECT s_suppkey, CASE WHEN present THEN landed.kind ELSE usual.kind END AS kind,
    coalesce(NOT present OR bare, false) AS is_empty FROM landed, usual""",
)
def _(t):
    """Missing geometries become an empty one of the usual kind."""
    rows = S.impute_empty_geometry(landed_geometries(t), "geometry")
    return rows.select(
        "s_suppkey",
        F.col("geometry.type").alias("kind"),
        (F.col("geometry.coordinates") == "[]").alias("is_empty"),
    )


@query(
    "points_from_text",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_orderkey::DOUBLE AS x,
    -l_partkey::DOUBLE AS y FROM lineitem""",
)
def _(t):
    """'POINT(x y)' text to points."""
    text = F.format_string("POINT(%d -%d)", F.col("l_orderkey"), F.col("l_partkey"))
    rows = t.lineitem.withColumn("p", G.point_from_wkt(text))
    zero_safe = F.col("p.y")
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "p.x", zero_safe.alias("y")
    )


@query(
    "convex_hulls",
    """WITH pts AS (SELECT DISTINCT c_nationkey AS k, c_custkey * 37 % 1000 AS x,
                    c_custkey * 91 % 1000 AS y FROM customer),
    pairs AS (SELECT a.k, a.x AS ux, a.y AS uy, b.x AS vx, b.y AS vy
      FROM pts a JOIN pts b ON a.k = b.k AND (a.x <> b.x OR a.y <> b.y)),
    edges AS (SELECT p.k, ux, uy, vx, vy FROM pairs p JOIN pts c ON c.k = p.k
      GROUP BY p.k, ux, uy, vx, vy
      HAVING bool_and((vx-ux)*(c.y-uy)-(vy-uy)*(c.x-ux) > 0
        OR ((vx-ux)*(c.y-uy)-(vy-uy)*(c.x-ux) = 0
            AND c.x BETWEEN least(ux,vx) AND greatest(ux,vx)
            AND c.y BETWEEN least(uy,vy) AND greatest(uy,vy))))
    SELECT k AS c_nationkey, count(*) AS corners, abs(sum(ux*vy - vx*uy)) / 2.0 AS area,
    min(ux)::DOUBLE AS west, max(uy)::DOUBLE AS north FROM edges GROUP BY 1""",
)
def _(t):
    """The hull of the points of each group."""
    x, y = shapes.position(F.col("c_custkey"))
    points = t.customer.select("c_nationkey", x.alias("x"), y.alias("y"))
    hulls = S.convex_hull(points, ["c_nationkey"], "x", "y")
    hull = F.col("hull")
    return hulls.select(
        "c_nationkey",
        F.size(hull).cast("bigint").alias("corners"),
        S.ring_area(hull).alias("area"),
        F.array_min(F.transform(hull, lambda c: c.x)).alias("west"),
        F.array_max(F.transform(hull, lambda c: c.y)).alias("north"),
    )

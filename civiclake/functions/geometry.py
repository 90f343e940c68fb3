"""Geometry as plain structs and arrays, tested with Catalyst expressions.

* point:   struct<srid int, x double, y double>
* polygon: array of rings, each an array<struct<x double, y double>>; the first ring is the shell
* boundary (multipolygon): array of polygons
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiclake.functions.columns import ColumnLike, as_column

POINT_TYPE = "struct<srid:int,x:double,y:double>"
RING_TYPE = "array<struct<x:double,y:double>>"
BOUNDARY_TYPE = f"array<array<{RING_TYPE}>>"
LANDED_TYPE = "struct<type:string,coordinates:string>"

# fixed values: geometry kinds a column can be declared with
KINDS = (
    "GEOMETRY",
    "POINT",
    "LINESTRING",
    "POLYGON",
    "MULTIPOINT",
    "MULTILINESTRING",
    "MULTIPOLYGON",
)


def point(x: ColumnLike, y: ColumnLike, srid: int = 4326) -> Column:
    """NULL when either coordinate is NULL."""
    x, y = as_column(x), as_column(y)
    made = F.struct(
        F.lit(srid).alias("srid"), x.cast("double").alias("x"), y.cast("double").alias("y")
    )
    return F.when(x.isNotNull() & y.isNotNull(), made)


def with_srid(p: ColumnLike, srid: int) -> Column:
    return as_column(p).withField("srid", F.lit(srid))


def transformed(p: ColumnLike, srid: int) -> Column:
    """Change of reference system; only the identity is needed, others raise."""
    p = as_column(p)
    bad = F.raise_error(F.concat(F.lit("no transformation to srid "), F.lit(str(srid))))
    return F.when(p.isNull() | (p.srid == srid), p).otherwise(bad.cast(POINT_TYPE))


def point_from_wkt(c: ColumnLike, srid: int = 4326) -> Column:
    """'POINT(x y)' to a point; an empty point or other text gives NULL."""
    number = r"(-?[0-9.]+(?:[eE][-+]?[0-9]+)?)"
    pattern = rf"(?i)^\s*POINT\s*\(\s*{number}\s+{number}\s*\)\s*$"
    parts = [F.nullif(F.regexp_extract(as_column(c), pattern, i), F.lit("")) for i in (1, 2)]
    return point(parts[0].cast("double"), parts[1].cast("double"), srid)


def point_from_geojson(g: ColumnLike, srid: int = 4326) -> Column:
    """A landed GeoJSON geometry (``LANDED_TYPE``) of kind Point; empty coordinates give NULL."""
    xy = F.from_json(as_column(g).coordinates, "array<double>")
    return F.when(
        (F.upper(as_column(g).type) == "POINT") & (F.size(xy) >= 2),
        F.struct(F.lit(srid).alias("srid"), F.get(xy, 0).alias("x"), F.get(xy, 1).alias("y")),
    )


def _as_rings(polygon: Column) -> Column:
    return F.transform(
        polygon,
        lambda ring: F.transform(
            ring, lambda xy: F.struct(F.get(xy, 0).alias("x"), F.get(xy, 1).alias("y"))
        ),
    )


def boundary_from_geojson(g: ColumnLike) -> Column:
    """A landed Polygon or MultiPolygon as a boundary; other kinds give NULL."""
    g = as_column(g)
    kind = F.upper(g.type)
    one = F.from_json(g.coordinates, "array<array<array<double>>>")
    many = F.from_json(g.coordinates, "array<array<array<array<double>>>>")
    return (
        F.when(kind == "POLYGON", F.array(_as_rings(one)))
        .when(kind == "MULTIPOLYGON", F.transform(many, _as_rings))
        .otherwise(F.lit(None).cast(BOUNDARY_TYPE))
    )


def empty_to_null(g: ColumnLike) -> Column:
    """A landed geometry without coordinates counts as missing."""
    g = as_column(g)
    bare = F.regexp_replace(g.coordinates, r"[\[\]\s]", "")
    return F.when(F.coalesce(F.length(bare), F.lit(0)) > 0, g)


def checked_kind(g: ColumnLike, kind: str, flag_only: bool = False) -> Column:
    """Raise (or with ``flag_only`` return false) unless the landed geometry has the kind."""
    kind = kind.upper()
    if kind not in KINDS:
        raise ValueError(f"unknown geometry kind {kind}")
    g = as_column(g)
    fits = g.isNull() | F.lit(kind == "GEOMETRY") | (F.upper(g.type) == kind)
    if flag_only:
        return fits
    bad = F.raise_error(F.concat(F.lit(f"expected {kind}, found "), g.type))
    return F.when(fits, g).otherwise(bad.cast(LANDED_TYPE))


#: Longitude and latitude as satellites give them; what a column without a declared system is in.
DEFAULT_SRID = 4326


def with_declared_srid(df: DataFrame, srid: int, *columns: str) -> DataFrame:
    """Declare the reference system of geometry columns; it travels with the column as metadata."""
    for c in columns:
        df = df.withMetadata(c, {**df.schema[c].metadata, "srid": srid})
    return df


def srid_of(df: DataFrame, column: str) -> int:
    return df.schema[column].metadata.get("srid", DEFAULT_SRID)


def geometry_columns(df: DataFrame) -> list[str]:
    """Columns that hold landed geometries or boundaries."""
    kinds = {T._parse_datatype_string(t).simpleString() for t in (LANDED_TYPE, BOUNDARY_TYPE)}
    return [f.name for f in df.schema.fields if f.dataType.simpleString() in kinds]


def ring_edges(ring: Column) -> Column:
    """Consecutive corners as segments; an unclosed ring is closed."""
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring), F.lit(1))), F.slice(ring, 1, 1))
    return F.zip_with(
        ring,
        following,
        lambda a, b: F.struct(
            a.x.alias("x1"), a.y.alias("y1"), b.x.alias("x2"), b.y.alias("y2")
        ),
    )


def boundary_edges(boundary: ColumnLike) -> Column:
    """All segments of all rings of all parts, zero-length ones dropped."""
    rings = F.flatten(as_column(boundary))
    edges = F.flatten(F.transform(rings, ring_edges))
    return F.filter(edges, lambda e: (e.x1 != e.x2) | (e.y1 != e.y2))


def _turn(e: Column, x: Column, y: Column) -> Column:
    """Positive when the point lies left of the directed segment, 0 on its line."""
    return (e.x2 - e.x1) * (y - e.y1) - (e.y2 - e.y1) * (x - e.x1)


def odd_crossings(edges: ColumnLike, x: ColumnLike, y: ColumnLike) -> Column:
    """Whether an odd number of segments lies to the right of the point.

    A segment counts when its ends lie on different sides of the point's height, the lower end
    included and the upper one not, so a corner is never counted twice.
    """
    x, y = as_column(x), as_column(y)

    def is_right(e):
        rises = (e.y1 <= y) & (e.y2 > y) & (_turn(e, x, y) > 0)
        falls = (e.y2 <= y) & (e.y1 > y) & (_turn(e, x, y) < 0)
        return rises | falls

    return F.size(F.filter(as_column(edges), is_right)) % 2 == 1


def edges_contain(edges: ColumnLike, x: ColumnLike, y: ColumnLike) -> Column:
    """True for points strictly inside: an odd number of segments to the right, none underneath."""
    x, y = as_column(x), as_column(y)

    def is_under(e):
        return (
            (_turn(e, x, y) == 0)
            & x.between(F.least(e.x1, e.x2), F.greatest(e.x1, e.x2))
            & y.between(F.least(e.y1, e.y2), F.greatest(e.y1, e.y2))
        )

    return odd_crossings(edges, x, y) & ~F.exists(as_column(edges), is_under)


def contains(boundary: ColumnLike, x: ColumnLike, y: ColumnLike) -> Column:
    """Point strictly inside the boundary: holes are out, points on an edge are out."""
    return edges_contain(boundary_edges(boundary), x, y)


def polygon_geojson(polygon: ColumnLike) -> Column:
    """GeoJSON text of one polygon; whole numbers without a decimal point."""
    coords = F.to_json(
        F.transform(
            as_column(polygon),
            lambda ring: F.transform(ring, lambda c: F.array(F.round(c.x, 9), F.round(c.y, 9))),
        )
    )
    return F.concat(
        F.lit('{"type":"Polygon","coordinates":'),
        F.regexp_replace(coords, r"\.0(?=[,\]])", ""),
        F.lit("}"),
    )


def feature_json(polygon: ColumnLike) -> Column:
    """The boundary text the sales mart carries: a kind tag around the polygon's GeoJSON."""
    return F.concat(
        F.lit('{"type" : "Polygon", "geometry" : '), polygon_geojson(polygon), F.lit("}")
    )

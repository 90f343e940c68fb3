"""Boundaries and points derived from the benchmark tables, for Spark and as SQL.

Every nation gets an area of 200 x 200 in a 5 x 5 field: a notched outline with a hole, and a
second part inside the notch. Coordinates are whole numbers, so both engines compute exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OUTLINE = [(0, 0), (190, 0), (190, 190), (100, 150), (0, 190), (0, 0)]
HOLE = [(80, 50), (120, 50), (120, 90), (80, 90), (80, 50)]
SECOND = [(80, 190), (120, 190), (100, 160), (80, 190)]
BEAT = [(0, 0), (200, 0), (200, 200), (0, 200), (0, 0)]


def _ring(corners):
    return F.array(
        *[
            F.struct(
                (F.col("col") * 200 + x).cast("double").alias("x"),
                (F.col("row") * 200 + y).cast("double").alias("y"),
            )
            for x, y in corners
        ]
    )


def _placed(nations: DataFrame) -> DataFrame:
    key = F.col("n_nationkey")
    return nations.withColumns({"col": key % 5, "row": F.floor(key / 5)})


def areas(nations: DataFrame) -> DataFrame:
    """community, geometry_parts: two parts, the first with a hole."""
    parts = F.array(F.array(_ring(OUTLINE), _ring(HOLE)), F.array(_ring(SECOND)))
    return _placed(nations).select(F.col("n_name").alias("community"), parts.alias("geometry_parts"))


def beats(nations: DataFrame) -> DataFrame:
    """beat_num, geometry_parts: squares that share their borders."""
    parts = F.array(F.array(_ring(BEAT)))
    beat = F.format_string("%04d", F.col("n_nationkey"))
    return _placed(nations).select(beat.alias("beat_num"), parts.alias("geometry_parts"))


def districts(regions: DataFrame) -> DataFrame:
    """dist_num, geometry_parts: one strip of the field per region."""
    low = (F.col("r_regionkey") * 200).cast("double")

    def corner(x, y):
        return F.struct(F.lit(float(x)).alias("x"), (low + y).alias("y"))

    ring = F.array(*[corner(x, y) for x, y in [(0, 0), (1000, 0), (1000, 200), (0, 200), (0, 0)]])
    number = F.format_string("%02d", F.col("r_regionkey"))
    return regions.select(number.alias("dist_num"), F.array(F.array(ring)).alias("geometry_parts"))


def position(key):
    """Whole coordinates in the field from a key."""
    return (key * 37) % 1000, (key * 91) % 1000


def _edges(corners) -> str:
    return ", ".join(
        f"({a[0]}, {a[1]}, {b[0]}, {b[1]})" for a, b in zip(corners, corners[1:])
    )


def inside_sql(layer: str, name: str, points: str, corners: str) -> str:
    """Two CTEs: ``<layer>_edges`` and ``<layer>_in`` (id, name of the boundary strictly around)."""
    return f"""
{layer}_edges AS (SELECT {name} AS name, {corners}),
{layer}_in AS (
  SELECT p.id, e.name FROM {points} p JOIN {layer}_edges e ON true
  GROUP BY p.id, e.name
  HAVING count(*) FILTER ((y1 <= y AND y2 > y AND (x2-x1)*(y-y1)-(y2-y1)*(x-x1) > 0)
                       OR (y2 <= y AND y1 > y AND (x2-x1)*(y-y1)-(y2-y1)*(x-x1) < 0)) % 2 = 1
     AND count(*) FILTER ((x2-x1)*(y-y1)-(y2-y1)*(x-x1) = 0
                       AND x BETWEEN least(x1,x2) AND greatest(x1,x2)
                       AND y BETWEEN least(y1,y2) AND greatest(y1,y2)) = 0)"""


def _moved(edges: str) -> str:
    return (
        "c.x1 + (n_nationkey % 5) * 200 AS x1, c.y1 + (n_nationkey // 5) * 200 AS y1, "
        "c.x2 + (n_nationkey % 5) * 200 AS x2, c.y2 + (n_nationkey // 5) * 200 AS y2 "
        f"FROM nation, (VALUES {edges}) c(x1, y1, x2, y2)"
    )


def areas_sql(points: str) -> str:
    edges = ", ".join(_edges(r) for r in (OUTLINE, HOLE, SECOND))
    return inside_sql("area", "n_name", points, _moved(edges))


def beats_sql(points: str) -> str:
    return inside_sql("beat", "printf('%04d', n_nationkey)", points, _moved(_edges(BEAT)))


def districts_sql(points: str) -> str:
    strip = [(0, 0), (1000, 0), (1000, 200), (0, 200), (0, 0)]
    corners = (
        "c.x1, c.y1 + r_regionkey * 200 AS y1, c.x2, c.y2 + r_regionkey * 200 AS y2 "
        f"FROM region, (VALUES {_edges(strip)}) c(x1, y1, x2, y2)"
    )
    return inside_sql("district", "printf('%02d', r_regionkey)", points, corners)

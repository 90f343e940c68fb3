import json
import random

import numpy as np
from conftest import rows
from pyspark.sql import functions as F

from civiclake.functions import geometry as G
from civiclake.operators import spatial as S
from civiclake.plans.skew import BROADCAST_BYTES_CONF

SQUARE = [[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]]
HOLE = [[4, 4], [6, 4], [6, 6], [4, 6], [4, 4]]
ISLAND = [[20, 0], [24, 0], [22, 4], [20, 0]]


def boundary(spark, *polygons, name="a"):
    coords = json.dumps([list(p) for p in polygons])
    df = spark.createDataFrame([(name, "MultiPolygon", coords)], "name string, t string, c string")
    landed = F.struct(F.col("t").alias("type"), F.col("c").alias("coordinates"))
    return df.select("name", G.boundary_from_geojson(landed).alias("parts"))


def inside(spark, b, *points):
    pts = spark.createDataFrame([(float(x), float(y)) for x, y in points], "x double, y double")
    got = pts.crossJoin(b).where(G.contains("parts", F.col("x"), F.col("y")))
    return sorted((x, y) for x, y in rows(got, "x", "y"))


def test_hole_parts_borders_and_corner_heights(spark):
    b = boundary(spark, [SQUARE, HOLE], [ISLAND])
    points = [
        (5, 5),  # in the hole
        (4, 5),  # on the hole's edge
        (1, 4),  # at the height of corners
        (2, 2),
        (0, 5),  # on the border
        (10, 10),  # a corner
        (22, 2),  # second part
        (22, 4),  # its tip
        (21, 2),  # on its slanted edge
        (15, 0),  # between the parts, on the height of both
        (-1, 10),
    ]
    assert inside(spark, b, *points) == [(1.0, 4.0), (2.0, 2.0), (22.0, 2.0)]


def brute_inside(poly, x, y):
    odd, n = False, len(poly)
    for i in range(n):
        (x1, y1), (x2, y2) = poly[i], poly[(i + 1) % n]
        turn = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
        if turn == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
            return False
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


def star(rnd, cx, cy, corners):
    angles = sorted(rnd.uniform(0, 2 * np.pi) for _ in range(corners))
    return [
        (cx + rnd.uniform(3, 15) * np.cos(a), cy + rnd.uniform(3, 15) * np.sin(a)) for a in angles
    ]


def test_grid_join_against_brute_force(spark):
    rnd = random.Random(3)
    polys = {f"p{i}": star(rnd, rnd.uniform(0, 80), rnd.uniform(0, 80), 12) for i in range(12)}
    b = None
    for name, p in polys.items():
        one = boundary(spark, [[list(c) for c in p] + [list(p[0])]], name=name)
        b = one if b is None else b.unionByName(one)
    pts = [(i, rnd.uniform(-5, 85), rnd.uniform(-5, 85)) for i in range(400)]
    pts += [(1000, None, 3.0), (1001, 3.0, None)]
    df = spark.createDataFrame(pts, "id int, x double, y double")
    expected = sorted(
        (i, n)
        for i, x, y in pts
        if x is not None and y is not None
        for n, p in polys.items()
        if brute_inside(p, x, y)
    )
    for limit, cell_points in (("100000000", None), ("0", None), ("0", 3), ("0", 1)):
        spark.conf.set(BROADCAST_BYTES_CONF, limit)
        got = S.join_containing(df, b, "x", "y", "parts", {"name": "area"}, cell_points=cell_points)
        found = got.where("area IS NOT NULL")
        assert sorted((r.id, r.area) for r in found.collect()) == expected
        outside = {i for i, _, _ in pts} - {i for i, _ in expected}
        assert {r.id for r in got.where("area IS NULL").collect()} == outside
    spark.conf.unset(BROADCAST_BYTES_CONF)


def test_broadcast_join_does_not_shuffle_points(spark):
    df = spark.range(100).selectExpr("id", "double(id) AS x", "double(id) AS y")
    b = boundary(spark, [SQUARE])
    got = S.join_containing(df, b, "x", "y", "parts", {"name": "area"})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_hull_against_brute_force(spark):
    rnd = random.Random(5)
    pts = [(k, rnd.randrange(40), rnd.randrange(40)) for k in (1, 2, None) for _ in range(80)]
    pts += [(3, 1, 1), (3, 1, 1), (4, 0, 0), (4, 2, 2), (4, 1, 1)]
    df = spark.createDataFrame(pts, "k int, x int, y int").repartition(6)
    got = {
        r.k: {(c.x, c.y) for c in r.hull}
        for r in S.convex_hull(df, ["k"], "x", "y", fan_in=3).collect()
    }

    def corners(group):
        group = sorted(set(group))
        out = set()
        for a in group:
            for b in group:
                if a == b:
                    continue
                turns = [
                    (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0]) for c in group
                ]
                between = all(
                    t > 0 or (t == 0 and min(a[0], b[0]) <= c[0] <= max(a[0], b[0])
                              and min(a[1], b[1]) <= c[1] <= max(a[1], b[1]))
                    for t, c in zip(turns, group)
                )
                if between:
                    out |= {a, b}
        return out or set(group)

    for k in (1, 2, None, 3, 4):
        assert got[k] == corners([(x, y) for kk, x, y in pts if kk == k]), k


def test_landed_geometry_rules(spark):
    df = spark.createDataFrame(
        [
            (1, "Point", "[1.5,2]"),
            (2, "Point", "[]"),
            (3, None, None),
            (4, "MultiPolygon", "[[]]"),
        ],
        "id int, t string, c string",
    ).select("id", F.when(F.col("t").isNotNull(), F.struct(F.col("t").alias("type"), F.col("c").alias("coordinates"))).alias("g"))
    got = df.select("id", G.empty_to_null("g").isNull().alias("missing"), G.point_from_geojson("g").x.alias("x"))
    assert rows(got) == [(1, False, 1.5), (2, True, None), (3, True, None), (4, True, None)]
    flags = df.select(G.checked_kind("g", "POINT", flag_only=True))
    assert [r[0] for r in flags.collect()] == [True, True, True, False]
    filled = S.impute_empty_geometry(df, "g").where("id = 3").select("g.type", "g.coordinates")
    assert rows(filled) == [("Point", "[]")]


def test_wkt(spark):
    df = spark.createDataFrame([("POINT(0 0)",), ("POINT (-1.5 2e1)",), ("POINT EMPTY",)], "w string")
    got = [r[0] for r in df.select(G.point_from_wkt("w")).collect()]
    assert [(p.x, p.y, p.srid) if p else None for p in got] == [(0, 0, 4326), (-1.5, 20, 4326), None]


def test_feature_text(spark):
    b = boundary(spark, [[[0, 0.5], [1, 0], [1, 1], [0, 0.5]]])
    text = b.select(G.feature_json(F.get("parts", 0))).first()[0]
    assert text == (
        '{"type" : "Polygon", "geometry" : '
        '{"type":"Polygon","coordinates":[[[0,0.5],[1,0],[1,1],[0,0.5]]]}}'
    )
    assert json.loads(text)["geometry"]["type"] == "Polygon"


def test_part_fan_out_and_dissolve(spark):
    b = boundary(spark, [SQUARE, HOLE], [ISLAND])
    assert S.polygon_parts(b, "parts").count() == 2
    assert S.polygon_parts(b, "parts", dissolve=True).count() == 1

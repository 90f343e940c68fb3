"""Joining points with the polygons around them, and hulls around groups of points."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.functions.geometry import boundary_edges, edges_contain, odd_crossings, srid_of
from civiclake.plans.scratch import written
from civiclake.plans.skew import broadcast_limit, hot_row_limit

# The hull functions travel to the workers by value, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELLS_PER_BOUNDARY = 256
HELD_CORNERS = 100_000


def _extent(edges):
    xs = F.concat(F.transform(edges, lambda e: e.x1), F.transform(edges, lambda e: e.x2))
    ys = F.concat(F.transform(edges, lambda e: e.y1), F.transform(edges, lambda e: e.y2))
    return F.array_min(xs), F.array_max(xs), F.array_min(ys), F.array_max(ys)


@dataclass(frozen=True)
class Layer:
    """Boundaries to look points up in: the column of the boundary, and ``{column: new_name}`` of
    what a point gets from the boundary around it."""

    boundaries: DataFrame
    names: dict[str, str]
    boundary: str = "geometry_parts"


def _cell_sizes(boxes: DataFrame, layers: int, cells_per_boundary: int) -> list[float]:
    """Per layer the side of a square cell so that boundaries cover about that many on average."""
    width, height = F.col("__x1") - F.col("__x0"), F.col("__y1") - F.col("__y0")
    measured = boxes.groupBy("__layer").agg(
        F.count(F.lit(1)), F.sum(width * height), F.max(F.greatest(width, height))
    )
    sizes = [1.0] * layers
    for layer, n, area, side in measured.collect():  # one row per layer
        if side:
            # a single long boundary must not explode into cells
            sizes[layer] = max(math.sqrt(area / (n * cells_per_boundary)), side / 4096.0)
    return sizes


def boundary_index(
    layers: list[Layer], cells_per_boundary: int = CELLS_PER_BOUNDARY
) -> tuple[DataFrame, list[float], list[int]]:
    """One row per boundary and grid cell that it may cover; per layer cell size and index bytes.

    A row holds only the segments that matter inside its cell: those at the height of the cell
    and not wholly to its left. A cell that no segment touches is decided once: it is dropped
    when outside, and marked ``__inside`` without segments when inside. All layers are indexed
    together and written out: the index is small, read several times, and costly to recompute.
    """
    boxes = None
    for i, layer in enumerate(layers):
        edges = layer.boundaries.select(
            F.lit(i).alias("__layer"),
            boundary_edges(layer.boundary).alias("__edges"),
            *[F.col(c).alias(f"__b_{n}") for c, n in layer.names.items()],
        )
        boxes = edges if boxes is None else boxes.unionByName(edges, allowMissingColumns=True)
    keep = ["__layer", *[c for c in boxes.columns if c.startswith("__b_")]]
    x0, x1, y0, y1 = _extent(F.col("__edges"))
    boxes = boxes.where(F.size("__edges") > 0).withColumns(
        {"__x0": x0, "__x1": x1, "__y0": y0, "__y1": y1}
    )
    sizes = _cell_sizes(boxes, len(layers), cells_per_boundary)
    boxes = boxes.withColumn(
        "__size", F.element_at(F.array(*[F.lit(s) for s in sizes]), F.col("__layer") + 1)
    )
    size, slack = F.col("__size"), F.col("__size") * 1e-6
    # slack: a point's cell is found by division, its edges by multiplication

    def cells(lo, hi):
        return F.sequence(F.floor(F.col(lo) / size), F.floor(F.col(hi) / size))

    rows = boxes.withColumn("__cy", F.explode(cells("__y0", "__y1")))
    low, high = F.col("__cy") * size - slack, (F.col("__cy") + 1) * size + slack
    rows = rows.withColumn(
        "__edges",
        F.filter(
            "__edges",
            lambda e: (F.least(e.y1, e.y2) <= high) & (F.greatest(e.y1, e.y2) >= low),
        ),
    )
    rows = rows.withColumn("__cx", F.explode(cells("__x0", "__x1")))
    left, right = F.col("__cx") * size - slack, (F.col("__cx") + 1) * size + slack
    rows = rows.withColumn(
        "__edges", F.filter("__edges", lambda e: F.greatest(e.x1, e.x2) >= left)
    )
    centre_x, centre_y = (left + right) / 2, (low + high) / 2
    touched = F.exists("__edges", lambda e: F.least(e.x1, e.x2) <= right)
    none = F.slice("__edges", 1, 0)
    # an array of no or one row per cell: decided once, without a filter that repeats the work
    decided = F.when(
        touched, F.array(F.struct(F.lit(False).alias("__inside"), F.col("__edges")))
    ).when(
        odd_crossings("__edges", centre_x, centre_y),
        F.array(F.struct(F.lit(True).alias("__inside"), none.alias("__edges"))),
    )
    cells_of = rows.select(
        *keep,
        F.col("__cx").cast("bigint").alias("__cx"),
        F.col("__cy").cast("bigint").alias("__cy"),
        decided.alias("__decided"),
    )
    index = written(
        cells_of.select(*keep, "__cx", "__cy", F.inline("__decided")), "boundary-index"
    )
    weights = index.groupBy("__layer").agg(F.count(F.lit(1)), F.sum(F.size("__edges")))
    bytes_of = {i: 200 * rows + 40 * segments for i, rows, segments in weights.collect()}
    return index, sizes, [bytes_of.get(i, 0) for i in range(len(layers))]


def join_layers(
    points: DataFrame,
    layers: list[Layer],
    x: str,
    y: str,
    how: str = "left",
    broadcast_bytes: int | None = None,
    points_srid: int | None = None,
    cell_points: int | None = None,
) -> DataFrame:
    """Add the boundary columns of every boundary strictly around a point, layer after layer.

    Layers in another reference system than the points (``points_srid``, else what ``x`` declares)
    raise.

    Equi-join on grid cells plus an exact test; a point is in one cell, so a (point, boundary)
    pair shows up once. With ``how='left'`` points outside everything keep NULLs.

    The index is measured: up to the broadcast limit it is shipped to the points, which then are
    not shuffled at all. Beyond it both sides are shuffled by cell. The points of each cell are counted, and
    a cell of more than ``cell_points`` (default: the rows of a key that one task may hold) is cut into as many
    parts as it has times that many points; only its boundaries are copied.
    """
    own = srid_of(points, x) if points_srid is None else points_srid
    for layer in layers:
        if (other := srid_of(layer.boundaries, layer.boundary)) != own:
            raise ValueError(f"points are in SRID {own}, boundaries {layer.boundary} in {other}")
    limit = broadcast_limit(points.sparkSession) if broadcast_bytes is None else broadcast_bytes
    index, sizes, weights = boundary_index(layers)
    out = points
    for i, layer in enumerate(layers):
        made = [f"__b_{n}" for n in layer.names.values()]
        own = index.where(F.col("__layer") == i).select(*made, "__cx", "__cy", "__inside", "__edges")
        joined = _join_index(out, own, x, y, sizes[i], how, weights[i] <= limit, cell_points)
        out = joined.select(
            *out.columns, *[F.col(f"__b_{n}").alias(n) for n in layer.names.values()]
        )
    return out


def _join_index(points, index, x, y, size, how, small, cell_points=None):
    # NaN orders above all numbers and would count as inside; it is no coordinate
    px, py = (F.nullif(F.col(c).cast("double"), F.lit(float("nan"))) for c in (x, y))
    located = points.withColumns(
        {
            "__pcx": F.floor(px / size).cast("bigint"),
            "__pcy": F.floor(py / size).cast("bigint"),
        }
    )
    same = (F.col("__pcx") == F.col("__cx")) & (F.col("__pcy") == F.col("__cy"))
    within = F.col("__inside") | edges_contain(F.col("__edges"), px, py)
    if small:
        return located.join(F.broadcast(index), same & within, how)
    # points without coordinates get salts of their own: no partner, but spread out too
    spread = F.xxhash64(*points.columns)
    nowhere = F.col("__pcx").isNull() | F.col("__pcy").isNull()
    limit = hot_row_limit(points.sparkSession) if cell_points is None else cell_points
    counted = located.where(~nowhere).groupBy("__pcx", "__pcy").agg(F.count(F.lit(1)).alias("__n"))
    # at most one row for each ``limit`` points
    crowded = F.broadcast(
        counted.where(F.col("__n") > limit).select(
            F.col("__pcx").alias("__hx"), F.col("__pcy").alias("__hy"), F.ceil(F.col("__n") / limit).cast("int").alias("__salts")
        )
    )
    salts = F.coalesce("__salts", F.lit(1))
    salt = F.when(nowhere, -1 - F.abs(spread % 1024)).otherwise(F.pmod(spread, salts))
    here = (F.col("__pcx") == F.col("__hx")) & (F.col("__pcy") == F.col("__hy"))
    located = located.join(crowded, here, "left").withColumn("__psalt", salt.cast("int")).drop("__hx", "__hy", "__salts")
    located = located.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("__pcx", "__pcy")})
    there = (F.col("__cx") == F.col("__hx")) & (F.col("__cy") == F.col("__hy"))
    copied = index.join(crowded, there, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    salted_index = copied.drop("__hx", "__hy", "__salts").hint("merge")
    return located.join(salted_index, same & (F.col("__psalt") == F.col("__salt")) & within, how)


def join_containing(
    points: DataFrame,
    boundaries: DataFrame,
    x: str,
    y: str,
    boundary: str,
    names: dict[str, str],
    how: str = "left",
    broadcast_bytes: int | None = None,
    cell_points: int | None = None,
) -> DataFrame:
    """``join_layers`` with a single layer."""
    layer = Layer(boundaries, names, boundary)
    return join_layers(points, [layer], x, y, how, broadcast_bytes, cell_points=cell_points)


def polygon_parts(df: DataFrame, boundary: str, part: str = "part", dissolve: bool = False):
    """One row per polygon of a boundary (fans rows out); ``dissolve`` keeps the first row only
    with all parts in it."""
    if dissolve:
        return df.withColumn(part, F.col(boundary))
    return df.withColumn(part, F.explode(boundary))


def most_common(df: DataFrame, column: str) -> DataFrame:
    """(value, count) of the most frequent non-NULL value; the smallest value among ties."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(column)).limit(1)


def impute_empty_geometry(df: DataFrame, geometry: str) -> DataFrame:
    """Missing landed geometries become an empty one of the column's most frequent kind."""
    g = F.col(geometry)
    kinds = df.select(g.type.alias("kind"))
    top = most_common(kinds, "kind").agg(F.first("kind").alias("kind"))  # always exactly one row
    usual = F.when(
        F.upper(F.col("__usual")).isin("POINT", "POLYGON", "MULTIPOLYGON"), F.col("__usual")
    ).otherwise(F.raise_error(F.lit("no usable most common geometry kind")).cast("string"))
    empty = F.struct(usual.alias("type"), F.lit("[]").alias("coordinates"))
    joined = df.crossJoin(F.broadcast(top.select(F.col("kind").alias("__usual"))))
    return joined.withColumn(geometry, F.when(g.isNull(), empty).otherwise(g)).drop("__usual")


def _outside_octagon(xy: np.ndarray) -> np.ndarray:
    """The points not strictly inside the polygon of the extremes in eight directions.

    Such points are no corners of the hull; what is left of evenly spread points is a small rest.
    """
    if len(xy) < 32:
        return xy
    x, y = xy[:, 0], xy[:, 1]
    # counter-clockwise, so that the inside is to the left of each edge
    ends = xy[[np.argmax(a * x + b * y) for a, b in DIRECTIONS]]
    inside = np.ones(len(xy), bool)
    for (ax, ay), (bx, by) in zip(ends, np.roll(ends, -1, axis=0)):
        if (ax, ay) != (bx, by):
            inside &= (bx - ax) * (y - ay) - (by - ay) * (x - ax) > 0
    return xy[~inside]


DIRECTIONS = ((1, 0), (1, 1), (0, 1), (-1, 1), (-1, 0), (-1, -1), (0, -1), (1, -1))


def _hull(xy: np.ndarray) -> np.ndarray:
    """Corners of the convex hull, counter-clockwise from the lowest-left one (monotone chain)."""
    pts = np.unique(_outside_octagon(xy), axis=0)
    if len(pts) <= 2:
        return pts

    def chain(ordered):
        out: list[np.ndarray] = []
        for p in ordered:
            while len(out) > 1:
                (ax, ay), (bx, by) = out[-2], out[-1]
                if (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax) > 0:
                    break
                out.pop()
            out.append(p)
        return out

    return np.array(chain(pts)[:-1] + chain(pts[::-1])[:-1])


def convex_hull(points: DataFrame, keys: list[str], x: str, y: str, fan_in: int = 64) -> DataFrame:
    """The convex hull of each key's points as an array of corners, first one not repeated.

    hull(A + B) = hull(hull(A) + hull(B)), so every partition reduces its points to hull corners
    first, then ``fan_in`` groups per key reduce those, and only their corners meet in one task.
    """
    # keys travel as text: pandas would turn a NULL integer key into a float
    key_types = ", ".join(f"`{k}` string" for k in keys)
    flat = points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        *[F.col(k).cast("string").alias(k) for k in keys],
        F.col(x).cast("double").alias("x"),
        F.col(y).cast("double").alias("y"),
    )
    partial_schema = f"{key_types}, x double, y double"

    def reduced(frame: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for key, rows in frame.groupby(keys, dropna=False, sort=False):
            corners = pd.DataFrame(_hull(rows[["x", "y"]].to_numpy()), columns=["x", "y"])
            for name, value in zip(keys, key):
                known = None if pd.isna(value) else value
                corners[name] = pd.Series([known] * len(corners), dtype=object)
            parts.append(corners)
        out = pd.concat(parts) if parts else frame.iloc[:0]
        return out[[*keys, "x", "y"]]

    def per_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = reduced(batch if held is None else pd.concat([held, batch]))
            if len(held) > HELD_CORNERS:  # very many keys: pass on what is there
                yield held
                held = None
        if held is not None:
            yield held

    def one_group(frame: pd.DataFrame) -> pd.DataFrame:
        return reduced(frame)

    def final(frame: pd.DataFrame) -> pd.DataFrame:
        corners = _hull(frame[["x", "y"]].to_numpy())
        first_row = {k: frame[k].iloc[0] for k in keys}
        row = {
            k: pd.Series([None if pd.isna(v) else v], dtype=object) for k, v in first_row.items()
        }
        row["hull"] = [[{"x": float(a), "y": float(b)} for a, b in corners]]
        return pd.DataFrame(row)

    first = flat.mapInPandas(per_partition, partial_schema)
    spread = F.pmod(F.xxhash64("x", "y"), F.lit(fan_in)).alias("__part")
    second = first.groupBy(*keys, spread).applyInPandas(one_group, partial_schema)
    hulls = second.groupBy(*keys).applyInPandas(
        final, f"{key_types}, hull array<struct<x:double,y:double>>"
    )
    return hulls.withColumns({k: F.col(k).cast(points.schema[k].dataType) for k in keys})


def ring_area(ring):
    """Area inside a ring given as corners in order."""
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring), F.lit(1))), F.slice(ring, 1, 1))
    cross = F.zip_with(ring, following, lambda a, b: a.x * b.y - b.x * a.y)
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda s, v: s + v)) / 2

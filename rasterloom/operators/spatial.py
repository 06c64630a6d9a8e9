"""Box overlap joins and nearest-geometry joins over grid cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.functions import geometry
from rasterloom.session import written

BOX = ("minx", "miny", "maxx", "maxy")


def cells(df: DataFrame, box: tuple[Column, Column, Column, Column], cell: float, margin: int = 0) -> DataFrame:
    """One row per grid cell (``cx``, ``cy``) that the box touches, ``margin`` cells wider on each side."""

    def span(low: Column, high: Column) -> Column:
        return F.explode(F.sequence(F.floor(low / cell) - margin, F.floor(high / cell) + margin))

    return df.withColumn("cx", span(box[0], box[2])).withColumn("cy", span(box[1], box[3]))


def overlap_pairs(boxes: DataFrame, key: str, cell: float) -> DataFrame:
    """``a, b`` with a < b for closed boxes that intersect.

    An equi-join on grid cells; a pair counts only in the cell of its
    intersection's lower left corner, so no distinct is needed. ``cell`` should
    be about the larger side of most boxes. Boxes with a null side pair with none.
    """
    sides = F.array(*BOX)
    valid = boxes.where(~F.exists(sides, lambda v: v.isNull() | F.isnan(v))).select(F.col(key).alias("k"), *BOX)
    dealt = cells(valid, tuple(F.col(c) for c in BOX), cell)
    a = dealt.select("cx", "cy", F.col("k").alias("a"), *(F.col(c).alias(f"a_{c}") for c in BOX))
    b = dealt.select("cx", "cy", F.col("k").alias("b"), *(F.col(c).alias(f"b_{c}") for c in BOX))
    joined = a.join(b, ["cx", "cy"]).where(F.col("a") < F.col("b"))
    box_a, box_b = (tuple(F.col(f"{s}_{c}") for c in BOX) for s in "ab")
    corner = (F.floor(F.greatest("a_minx", "b_minx") / cell) == F.col("cx")) & (F.floor(F.greatest("a_miny", "b_miny") / cell) == F.col("cy"))
    return joined.where(geometry.intersects(box_a, box_b) & corner).select("a", "b")


def nearest(points: DataFrame, shapes: DataFrame, shape_box: tuple[Column, ...], distance: Column, cell: float, span: float) -> DataFrame:
    """``point_id, shape_id, distance`` of each point's nearest shape; equal distances go to the smaller id.

    ``points`` has point_id, px, py; ``shapes`` has shape_id and the columns of
    ``shape_box`` and ``distance``. Points meet the shapes of their cell and its
    neighbours. A shape nearer than the cell's side is the nearest one; the
    points left over go on with doubled cells, until these exceed ``span``, the
    extent of the data. A point with no shape at all gets nulls.
    """
    left, found = points, None
    while True:
        near = cells(shapes, shape_box, cell)
        around = cells(left, (F.col("px"), F.col("py"), F.col("px"), F.col("py")), cell, 1)
        joined = around.join(near, ["cx", "cy"]).select("point_id", F.round(distance, 9).alias("distance"), "shape_id")
        best = joined.groupBy("point_id").agg(F.min(F.struct("distance", "shape_id")).alias("best"))
        last = cell > span
        settled = best.where(F.lit(last) | (F.col("best.distance") <= cell)).select("point_id", "best.shape_id", "best.distance")
        if last:
            rest = left.join(settled, "point_id", "left").select("point_id", "shape_id", "distance")
            return rest if found is None else found.unionByName(rest)
        settled = written(settled, "nearest")
        found = settled if found is None else found.unionByName(settled)
        left = left.join(settled.select("point_id"), "point_id", "left_anti")
        if left.isEmpty():
            return found
        cell *= 2


def nearest_segments(points: DataFrame, segments: DataFrame, cell: float = 4.0, span: float = 720.0) -> DataFrame:
    """``segments`` has line_id, x1, y1, x2, y2."""
    shapes = segments.withColumnRenamed("line_id", "shape_id")
    box = (F.least("x1", "x2"), F.least("y1", "y2"), F.greatest("x1", "x2"), F.greatest("y1", "y2"))
    distance = geometry.segment_distance(*(F.col(c) for c in ("px", "py", "x1", "y1", "x2", "y2")))
    return nearest(points, shapes, box, distance, cell, span).withColumnRenamed("shape_id", "line_id")


def nearest_boxes(points: DataFrame, areas: DataFrame, cell: float = 4.0, span: float = 720.0) -> DataFrame:
    """``areas`` has area_id and a box; the distance inside is 0."""
    shapes = areas.withColumnRenamed("area_id", "shape_id")
    distance = geometry.box_distance(*(F.col(c) for c in ("px", "py", *BOX)))
    return nearest(points, shapes, tuple(F.col(c) for c in BOX), distance, cell, span).withColumnRenamed("shape_id", "area_id")


def area_hits(tiles: DataFrame, areas: DataFrame, cell: float = 4.0) -> DataFrame:
    """``tile_id, intersects, center_inside`` for every tile (tile_id and a box)."""
    dealt = cells(areas.select(*(F.col(c).alias(f"b_{c}") for c in BOX)), tuple(F.col(f"b_{c}") for c in BOX), cell)
    spread = cells(tiles.select("tile_id", *BOX), tuple(F.col(c) for c in BOX), cell)
    a, b = tuple(F.col(c) for c in BOX), tuple(F.col(f"b_{c}") for c in BOX)
    cx, cy = (F.col("minx") + F.col("maxx")) / 2, (F.col("miny") + F.col("maxy")) / 2
    inside = (b[0] < cx) & (cx < b[2]) & (b[1] < cy) & (cy < b[3])
    hits = spread.join(dealt, ["cx", "cy"]).where(geometry.intersects(a, b)).groupBy("tile_id").agg(F.bool_or(inside).alias("inside"))
    rows = tiles.select("tile_id").join(hits, "tile_id", "left")
    return rows.select("tile_id", F.col("inside").isNotNull().alias("intersects"), F.coalesce("inside", F.lit(False)).alias("center_inside"))


def context_clip(rasters: DataFrame, segments: DataFrame, distance: float, cell: float = 4.0) -> DataFrame:
    """``mosaic_id, line_id`` and the segment cut to the raster's box grown by ``distance``.

    Liang-Barsky: the part of the segment for parameters t0..t1 inside the box.
    """
    grown = tuple(F.col(c) + s * distance for c, s in zip(BOX, (-1, -1, 1, 1), strict=True))
    boxes = rasters.select("mosaic_id", *(g.alias(c) for g, c in zip(grown, BOX, strict=True)))
    near = cells(segments, (F.least("x1", "x2"), F.least("y1", "y2"), F.greatest("x1", "x2"), F.greatest("y1", "y2")), cell)
    joined = cells(boxes, tuple(F.col(c) for c in BOX), cell).join(near, ["cx", "cy"]).drop("cx", "cy").distinct()
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    low, high, outside = [F.lit(0.0)], [F.lit(1.0)], F.lit(False)
    for step, room in ((-dx, F.col("x1") - F.col("minx")), (dx, F.col("maxx") - F.col("x1")), (-dy, F.col("y1") - F.col("miny")), (dy, F.col("maxy") - F.col("y1"))):
        at = room / F.when(step != 0, step)
        low.append(F.when(step < 0, at))
        high.append(F.when(step > 0, at))
        outside = outside | ((step == 0) & (room < 0))
    t0, t1 = F.greatest(*low), F.least(*high)
    kept = joined.withColumns({"t0": t0, "t1": t1}).where(~outside & (F.col("t0") <= F.col("t1")))

    def at(t: str) -> list[Column]:
        return [F.col("x1") + F.col(t) * dx, F.col("y1") + F.col(t) * dy]

    (ax, ay), (bx, by) = at("t0"), at("t1")
    return kept.select("mosaic_id", "line_id", ax.alias("cx1"), ay.alias("cy1"), bx.alias("cx2"), by.alias("cy2"))

"""Object masks of tiles: summaries, boxes, crops, class painting and land cover.

A mask has ``tile, py, px, object`` with 0 for the background; pixels have
``tile, band, py, px, value``. A tile's rows meet by its key only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Padding of object crops: with their surroundings, and cut out.
CONTEXT_PAD, MASKED_PAD, BACKGROUND = 56, 28, 128.0
#: Smaller objects are not classified.
MIN_OBJECT_FRACTION = 0.0002


def mask_summary(mask: DataFrame) -> DataFrame:
    """``tile, objects, foreground_pixels, foreground_fraction, largest, largest_fraction``; zeros where there is no object."""
    each = mask.groupBy("tile", "object").agg(F.count("*").alias("n"))
    real, zero, total = F.when(F.col("object") > 0, F.col("n")), F.lit(0).cast("long"), F.sum("n")
    found, largest = F.coalesce(F.sum(real), zero), F.coalesce(F.max(real), zero)
    return each.groupBy("tile").agg(
        F.count(real).alias("objects"), found.alias("foreground_pixels"), (found / total).alias("foreground_fraction"), largest.alias("largest"), (largest / total).alias("largest_fraction")
    )


def object_boxes(mask: DataFrame, pad: int, width: int, height: int, min_fraction: float = 0.0) -> DataFrame:
    """``tile, object, x0, y0, x1, y1, area``: the box of each object, both ends included,
    padded and clipped to the tile; objects under ``min_fraction`` of the tile are left out."""
    zero = F.lit(0).cast("long")
    boxes = mask.where("object > 0").groupBy("tile", "object").agg(
        F.greatest(F.min("px") - pad, zero).alias("x0"), F.greatest(F.min("py") - pad, zero).alias("y0"),
        F.least(F.max("px") + pad, F.lit(width - 1).cast("long")).alias("x1"), F.least(F.max("py") + pad, F.lit(height - 1).cast("long")).alias("y1"), F.count("*").alias("area"),
    )
    return boxes.where(F.col("area") / (width * height) >= min_fraction)


def object_crops(pixels: DataFrame, mask: DataFrame, width: int, height: int, mode: str = "context", pad: int | None = None, background: float = BACKGROUND) -> DataFrame:
    """``tile, object, band, y, x, value``: the pixels of each object's box, counted from its corner.

    ``context`` shows what is around the object; ``masked`` puts ``background`` there.
    """
    if mode not in ("context", "masked"):
        raise ValueError(f"unknown crop mode: {mode}")
    boxes = object_boxes(mask, (CONTEXT_PAD if mode == "context" else MASKED_PAD) if pad is None else pad, width, height)
    rows = pixels.join(boxes, "tile").where("px BETWEEN x0 AND x1 AND py BETWEEN y0 AND y1")
    value = F.col("value")
    if mode == "masked":
        rows = rows.join(mask.withColumnRenamed("object", "here"), ["tile", "py", "px"], "left")
        value = F.when(F.col("here") == F.col("object"), value).otherwise(background)
    return rows.select("tile", "object", "band", (F.col("py") - F.col("y0")).alias("y"), (F.col("px") - F.col("x0")).alias("x"), value.alias("value"))


def paint_classes(mask: DataFrame, objects: DataFrame, min_score: float = 0.0) -> DataFrame:
    """``tile, py, px, class``: each object's class on its pixels, ``other`` below the score,
    ``background`` where there is no classified object. ``objects`` has tile, object, class, score."""
    painted = mask.join(objects.select("tile", "object", "class", "score"), ["tile", "object"], "left")
    return painted.select("tile", "py", "px", F.when(F.col("class").isNull(), "background").when(F.col("score") < min_score, "other").otherwise(F.col("class")).alias("class"))


def object_color(object_id: Column, seed: int = 17) -> Column:
    """Three bytes from 40 to 254 for an object's number, black for the background."""
    shades = [(F.lit(40) + F.pmod(F.xxhash64(object_id.cast("long"), F.lit(seed), F.lit(k)), F.lit(215))).cast("int") for k in range(3)]
    return F.when(object_id > 0, F.array(*shades)).otherwise(F.array(*[F.lit(0)] * 3))


def class_color(name: Column, colors: dict[str, tuple[int, int, int]]) -> Column:
    """The class's color, black for one without."""
    out = F.array(*[F.lit(0)] * 3)
    for key, rgb in colors.items():
        out = F.when(name == key, F.array(*(F.lit(v) for v in rgb))).otherwise(out)
    return out


def overlay(pixels: DataFrame, colored: DataFrame, alpha: float = 0.45) -> DataFrame:
    """``tile, band, py, px, value``: byte bands 1 to 3 with the colors laid over the foreground.

    ``colored`` has tile, py, px, ``color`` (three bytes) and ``foreground``.
    """
    rows = pixels.where("band <= 3").join(colored, ["tile", "py", "px"])
    blended = F.col("value") * (1 - alpha) + F.get("color", (F.col("band") - 1).cast("int")) * alpha
    shown = F.when(F.col("foreground"), blended).otherwise(F.col("value"))
    return rows.select("tile", "band", "py", "px", F.floor(F.least(F.greatest(shown, F.lit(0.0)), F.lit(255.0))).cast("int").alias("value"))


def weighted_landcover(scores: DataFrame, min_fraction: float = MIN_OBJECT_FRACTION) -> DataFrame:
    """``tile, class, weighted, assigned_area_fraction, score``: class scores of a tile's objects weighted by
    area and renormalised, and the share of the tile whose objects have the class on top.

    ``scores`` has tile, object, fraction, class, score; ties go to the class first by name.
    """
    kept = scores.where(F.col("fraction") >= min_fraction)
    best = F.row_number().over(Window.partitionBy("tile", "object").orderBy(F.desc("score"), "class"))
    ranked = kept.withColumn("nth", best)
    assigned = F.sum(F.when(F.col("nth") == 1, F.col("fraction")).otherwise(0.0))
    by_class = ranked.groupBy("tile", "class").agg(F.sum(F.col("fraction") * F.col("score")).alias("weighted"), assigned.alias("assigned_area_fraction"))
    total = F.sum("weighted").over(Window.partitionBy("tile"))
    return by_class.withColumn("score", F.when(total > 0, F.col("weighted") / total).otherwise(0.0))

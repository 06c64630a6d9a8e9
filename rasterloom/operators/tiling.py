"""Window planning, shard assignment and tile metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHARD_SAMPLES = 2048


def _starts(size: Column, tile: int, stride: int, drop_partial: bool) -> Column:
    """Offsets along one side; none for a size that holds no tile."""
    last = size.cast("long") - (tile if drop_partial else 1)
    steps = F.when(last >= 0, F.sequence(F.lit(0).cast("long"), last, F.lit(stride).cast("long")))
    return F.coalesce(steps, F.array().cast("array<bigint>"))


def tile_plan(rasters: DataFrame, tile: int, stride: int, drop_partial: bool = True) -> DataFrame:
    """The rasters' rows, one per window in row-major order: ``row_i, col_i, x, y, w, h``.

    ``rasters`` has ``width`` and ``height``. With ``drop_partial`` only whole
    windows count; else those at the right and bottom edge are cut.
    """
    if not 0 < stride <= tile:
        raise ValueError("0 < stride <= tile")
    rows = rasters.select("*", F.posexplode(_starts(F.col("height"), tile, stride, drop_partial)).alias("row_i", "y"))
    rows = rows.select("*", F.posexplode(_starts(F.col("width"), tile, stride, drop_partial)).alias("col_i", "x"))
    return rows.withColumns({"w": F.least(F.lit(tile).cast("long"), F.col("width") - F.col("x")), "h": F.least(F.lit(tile).cast("long"), F.col("height") - F.col("y"))})


def expected_tiles(width: Column, height: Column, tile: int, stride: int) -> Column:
    def along(size: Column) -> Column:
        return F.greatest(F.lit(1).cast("long"), F.floor((size - tile) / stride) + 1)

    return along(width) * along(height)


def valid_window() -> Column:
    """Offsets not negative, sizes positive, inside the raster."""
    inside = (F.col("x") + F.col("w") <= F.col("width")) & (F.col("y") + F.col("h") <= F.col("height"))
    return (F.col("x") >= 0) & (F.col("y") >= 0) & (F.col("w") > 0) & (F.col("h") > 0) & inside


def shard_positions(tiles: DataFrame, owner: str, order: list[str], shard_size: int = SHARD_SAMPLES) -> DataFrame:
    """``shard_index`` from 1 and ``shard_pos`` from 0: a new shard every ``shard_size`` tiles of an owner."""
    nth = F.row_number().over(Window.partitionBy(owner).orderBy(*order)) - 1
    return tiles.withColumn("nth", nth).withColumns({"shard_index": (F.floor(F.col("nth") / shard_size) + 1).cast("int"), "shard_pos": F.col("nth") % shard_size}).drop("nth")


def canonical_plan(rasters: DataFrame, bundles: DataFrame, tile: int, stride: int) -> DataFrame:
    """One plan per bundle, on its canonical raster; a raster in no bundle gets its own.

    ``bundles`` has mosaic_id, bundle_id, canonical_mosaic_id.
    """
    owners = bundles.select(F.col("canonical_mosaic_id").alias("mosaic_id"), "bundle_id").distinct()
    loose = rasters.join(bundles.select("mosaic_id"), "mosaic_id", "left_anti").select("mosaic_id", F.lit("").alias("bundle_id"))
    jobs = owners.unionByName(loose).join(rasters, "mosaic_id")
    return tile_plan(jobs.select("mosaic_id", "bundle_id", "width", "height"), tile, stride)


def window_geo(box: tuple[Column, Column, Column, Column]) -> dict[str, Column]:
    """Bounds of a window in a north-up raster of the given box."""
    dx = (box[2] - box[0]) / F.col("width")
    dy = (box[3] - box[1]) / F.col("height")
    left, top = box[0] + F.col("x") * dx, box[3] - F.col("y") * dy
    return {"left": left, "top": top, "right": left + F.col("w") * dx, "bottom": top - F.col("h") * dy}


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__nth", nth).where("__nth = 1").drop("__nth")


def merge_bundle(members: DataFrame, key: str) -> DataFrame:
    """Per bundle: bands, dtype or ``mixed``, the common shape or null, sorted distinct raster ids.

    ``members`` has suffix, dtype, height, width, mosaic_id.
    """
    dtypes, shapes = F.collect_set("dtype"), F.collect_set(F.concat_ws("x", "height", "width"))
    return members.groupBy(key).agg(
        F.count("*").alias("bands"),
        F.when(F.size(dtypes) == 1, F.get(dtypes, F.lit(0))).otherwise("mixed").alias("dtype"),
        F.when(F.size(shapes) == 1, F.get(shapes, F.lit(0))).alias("array_shape"),
        F.array_join(F.sort_array(F.collect_set("mosaic_id")), ";").alias("mosaic_ids"),
    )


def downsample_size(width: Column, height: Column, resolution: Column, factor: Column, target_w: Column, target_h: Column) -> Column:
    """The size arguments of exactly one strategy; an error otherwise."""
    from rasterloom.functions.text import percent_text

    given = resolution.isNotNull().cast("int") + factor.isNotNull().cast("int") + (target_w.isNotNull() | target_h.isNotNull()).cast("int")
    percent = F.concat(percent_text(factor * 100), F.lit("%"))
    return (
        F.when(given != 1, F.raise_error(F.lit("exactly one sizing strategy")))
        .when(resolution.isNotNull(), F.concat_ws(" ", F.lit("-tr"), resolution.cast("string"), resolution.cast("string")))
        .when(factor.isNotNull(), F.concat_ws(" ", F.lit("-outsize"), percent, percent))
        .otherwise(F.concat_ws(" ", F.lit("-outsize"), F.coalesce(target_w, F.lit(0)).cast("string"), F.coalesce(target_h, F.lit(0)).cast("string")))
    )

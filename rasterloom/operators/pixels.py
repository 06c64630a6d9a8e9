"""Pixel statistics, content filter, stretching and quantizing.

Pixels are rows (tile, band, py, px, value); masked or unreadable ones are null
or not finite.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PERCENTILES = (1, 2, 5, 50, 95, 98, 99)
# Integer ranges that quantizing maps to.
RANGES = {"float32": (0.0, 1.0), "uint16": (0.0, 65535.0), "uint8": (0.0, 255.0)}


def finite(value: Column) -> Column:
    """The value, or null if it is not a finite number."""
    return F.when(value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf"))), value)


def band_stats(pixels: DataFrame) -> DataFrame:
    """Per tile and band over finite pixels: min, max, mean, population deviation, percentiles; nulls if there are none."""
    v = finite(F.col("value"))
    points = [F.round(F.percentile(v, p / 100), 6).alias(f"p{p:02d}") for p in PERCENTILES]
    return pixels.groupBy("tile", "band").agg(
        F.count(v).alias("n"), F.round(F.min(v), 6).alias("min"), F.round(F.max(v), 6).alias("max"),
        F.round(F.avg(v), 6).alias("mean"), F.round(F.stddev_pop(v), 6).alias("std"), *points,
    )


def rgb_stats(pixels: DataFrame, dark: float = 5.0, bright: float = 250.0) -> DataFrame:
    """Brightness (mean of the first three bands) per tile: mean, deviation, dark and bright shares."""
    grey = pixels.where("band <= 3").groupBy("tile", "py", "px").agg(F.avg("value").alias("g"))
    return grey.groupBy("tile").agg(
        F.round(F.avg("g"), 6).alias("brightness_mean"), F.round(F.stddev_pop("g"), 6).alias("brightness_std"),
        F.round(F.avg((F.col("g") <= dark).cast("double")), 6).alias("dark_fraction"), F.round(F.avg((F.col("g") >= bright).cast("double")), 6).alias("bright_fraction"),
    )


def _thresholds(largest: Column) -> tuple[Column, Column, Column]:
    """(black, white, deviation scale) by the range seen: unit, byte or wider."""
    unit, byte = largest <= 1.5, largest <= 255.0
    black = F.when(unit, 0.02).when(byte, 5.0).otherwise(largest * (5.0 / 255.0))
    white = F.when(unit, 0.98).when(byte, 250.0).otherwise(largest * (250.0 / 255.0))
    scale = F.when(unit, 255.0).when(byte, 1.0).otherwise(F.lit(255.0) / F.greatest(largest, F.lit(1.0)))
    return black, white, scale


def skip_decisions(
    pixels: DataFrame, min_content: float, max_black: float = 0.75, max_white: float = 0.75, min_global_std: float = 2.0, min_channel_std: float = 1.5
) -> DataFrame:
    """Per tile: content, black, white and valid shares, deviations, and the first reason to skip it, or ''."""
    data = pixels.where("band <= 3").withColumn("v", finite(F.col("value")))
    tile = data.groupBy("tile").agg(F.coalesce(F.max("v"), F.lit(0.0)).alias("largest"), F.stddev_pop("v").alias("g_std"))
    channel = data.groupBy("tile", "band").agg(F.stddev_pop("v").alias("s")).groupBy("tile").agg(F.avg("s").alias("c_std"))
    black, white, scale = _thresholds(F.col("largest"))
    limits = tile.join(channel, "tile").select("tile", black.alias("black"), white.alias("white"), (F.col("g_std") * scale).alias("global_std"), (F.col("c_std") * scale).alias("channel_std_mean"))
    pixel = data.join(limits, "tile").groupBy("tile", "py", "px", "global_std", "channel_std_mean").agg(
        F.bool_and(F.col("v").isNotNull()).alias("valid"),
        F.bool_and(F.coalesce(F.col("v") <= F.col("black"), F.lit(False))).alias("is_black"),
        F.bool_and(F.coalesce(F.col("v") >= F.col("white"), F.lit(False))).alias("is_white"),
    )

    def share(flag: Column, name: str) -> Column:
        return F.round(F.avg(flag.cast("double")), 6).alias(name)

    stats = pixel.groupBy("tile").agg(
        share(F.col("valid") & ~F.col("is_black") & ~F.col("is_white"), "content_fraction"), share(F.col("is_black"), "black_fraction"),
        share(F.col("is_white"), "white_fraction"), share(F.col("valid"), "valid_fraction"),
        F.round(F.max("global_std"), 4).alias("global_std"), F.round(F.max("channel_std_mean"), 4).alias("channel_std_mean"),
    )
    reason = (
        F.when(F.col("valid_fraction") <= 0.05, "mostly_invalid")
        .when(F.col("content_fraction") < min_content, "low_content")
        .when(F.col("black_fraction") > max_black, "mostly_black")
        .when(F.col("white_fraction") > max_white, "mostly_white")
        .when(F.col("global_std") < min_global_std, "too_flat_global")
        .when(F.col("channel_std_mean") < min_channel_std, "too_flat_channels")
        .otherwise("")
    )
    return stats.withColumn("reason", reason)


def content_stats(pixels: DataFrame, min_content: float, max_black: float = 0.40, max_white: float = 0.40) -> DataFrame:
    """Valid, non-zero, content, black and white shares of the first three bands, and whether a tile is mostly empty.

    The margins are 2/255 of the range seen: a fixed margin of 2 would call
    every pixel of a unit-range tile both black and white.
    """
    data = pixels.where("band <= 3").select("tile", "py", "px", finite(F.col("value")).alias("v"))
    top = data.groupBy("tile").agg(F.coalesce(F.max("v"), F.lit(1.0)).alias("largest"))
    full = F.when(F.col("largest") <= 1.5, 1.0).otherwise(255.0)
    pixel = data.join(top.select("tile", full.alias("full")), "tile").groupBy("tile", "py", "px").agg(
        F.bool_and(F.col("v").isNotNull()).alias("valid"),
        F.bool_and(F.abs(F.coalesce("v", F.lit(0.0))) <= F.col("full") * (2.0 / 255.0)).alias("is_black"),
        F.bool_and(F.coalesce("v", F.lit(0.0)) >= F.col("full") * (253.0 / 255.0)).alias("is_white"),
    )

    def share(flag: Column, name: str) -> Column:
        return F.round(F.avg(flag.cast("double")), 6).alias(name)

    black, white, valid = F.col("is_black"), F.col("is_white"), F.col("valid")
    stats = pixel.groupBy("tile").agg(
        share(valid, "valid_fraction"), share(~black, "nonzero_fraction"), share(valid & ~black & ~white, "content_fraction"),
        share(black, "black_fraction"), share(white, "white_fraction"),
    )
    return stats.withColumn("mostly_empty", (F.col("content_fraction") < min_content) | (F.col("black_fraction") > max_black) | (F.col("white_fraction") > max_white))


def _between(a: Column, b: Column, t: Column) -> Column:
    """``a * (1 - t) + b * t`` with the sum rounded once (a fused multiply-add); a bit off ``a`` for some equal ends."""
    a, b = F.coalesce(a.cast("double"), F.lit(0.0)), F.coalesce(b.cast("double"), F.lit(0.0))  # the method takes no nulls
    return F.java_method(F.lit("java.lang.Math"), F.lit("fma"), a, 1 - t, b * t).cast("double")


def _bounds(pixels: DataFrame, low: float, high: float) -> DataFrame:
    """``lo, hi, least, most`` per tile and band: percentiles and extremes of the finite values, from counts of each value.

    Percentiles are those of DuckDB's ``quantile_cont``. Spark's own may differ in the last bit, which is a whole step
    for pixels that lie on the edge between two bytes. A band that is one value from the lower to the upper percentile
    has that value as both.
    """
    v = finite(F.col("value"))
    counts = pixels.groupBy("tile", "band", v.alias("v")).agg(F.count(v).alias("n"))
    order = Window.partitionBy("tile", "band").orderBy("v")
    upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    n = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ranked = counts.select("tile", "band", "v", upto.alias("upto"), n.alias("n"))
    at = {"lo": (F.col("n") - 1) * (low / 100), "hi": (F.col("n") - 1) * (high / 100)}
    ends = [F.min(F.when(F.col("upto") > end(x), F.col("v"))).alias(f"{name}_{side}") for name, x in at.items() for side, end in (("a", F.floor), ("b", F.ceil))]
    found = ranked.groupBy("tile", "band").agg(*ends, F.max("n").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))
    level = F.col("lo_a") == F.col("hi_b")
    bounds = [F.when(level, F.col("lo_a")).when(F.col("n") > 0, _between(F.col(f"{name}_a"), F.col(f"{name}_b"), x - F.floor(x))).alias(name) for name, x in at.items()]
    return found.select("tile", "band", *bounds, "least", "most")


def stretch_u8(pixels: DataFrame, low: float = 2.0, high: float = 98.0) -> DataFrame:
    """Percentile stretch per band, truncated to a byte; a constant band is 255 if positive, else 0; no finite pixel gives 0."""
    joined = pixels.join(_bounds(pixels, low, high), ["tile", "band"])
    scaled = F.least(F.lit(255.0), F.greatest(F.lit(0.0), (finite(F.col("value")) - F.col("lo")) * 255.0 / (F.col("hi") - F.col("lo"))))
    constant = F.when(F.col("least") > 0, 255).otherwise(0)
    out = F.when(F.col("lo").isNull(), 0).when(F.col("hi") <= F.col("lo"), constant).otherwise(F.coalesce(F.floor(scaled), F.lit(0)))
    return joined.select("tile", "band", "py", "px", out.cast("int").alias("u8"))


def scale_u8(pixels: DataFrame, low: float = 2.0, high: float = 98.0) -> DataFrame:
    """Rounded variant for classifiers; equal percentiles fall back to the band's extremes, other pixels are 0."""
    joined = pixels.join(_bounds(pixels, low, high), ["tile", "band"])
    flat = F.col("hi") <= F.col("lo")
    lo, hi = F.when(flat, F.col("least")).otherwise(F.col("lo")), F.when(flat, F.col("most")).otherwise(F.col("hi"))
    unit = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (finite(F.col("value")) - lo) / (hi - lo)))
    constant = F.when(F.col("most") > 0, 255).otherwise(0)
    out = F.when(F.col("lo").isNull(), 0).when(F.col("most") <= F.col("least"), constant).otherwise(F.coalesce(F.rint(unit * 255.0), F.lit(0.0)))
    return joined.select("tile", "band", "py", "px", out.cast("int").alias("u8"))


def band_bounds(windows: DataFrame, scale: str = "percentile", low: float = 5.0, high: float = 95.0) -> DataFrame:
    """Per band the least lower and the greatest upper bound of all windows; (0, 1) without a finite pixel.

    ``windows`` has window, band, value.
    """
    v = finite(F.col("value"))
    ends = (F.min(v), F.max(v)) if scale == "minmax" else (F.percentile(v, low / 100), F.percentile(v, high / 100))
    each = windows.groupBy("window", "band").agg(ends[0].alias("lo"), ends[1].alias("hi"))
    return each.groupBy("band").agg(F.round(F.coalesce(F.min(F.least("lo", "hi")), F.lit(0.0)), 6).alias("src_lo"), F.round(F.coalesce(F.max(F.greatest("lo", "hi")), F.lit(1.0)), 6).alias("src_hi"))


def quantize(value: Column, src_lo: Column, src_hi: Column, dtype: str, scale: str = "linear") -> Column:
    """To the range of ``dtype``: clipped only for scale ``none``, else mapped and clipped; integers truncate."""
    lo, hi = RANGES[dtype]
    usable = src_hi > src_lo
    a, b = F.when(usable, src_lo).otherwise(0.0), F.when(usable, src_hi).otherwise(1.0)
    mapped = value if scale == "none" else (value - a) * (hi - lo) / (b - a) + lo
    clipped = F.least(F.lit(hi), F.greatest(F.lit(lo), mapped))
    if dtype == "float32":
        return mapped if scale == "none" else clipped
    return F.floor(clipped).cast("int")


def fill_masked(value: Column, masked: Column, fill: Column) -> Column:
    """Masked pixels get the fill value; an error if there is none."""
    return F.when(~masked, value).otherwise(F.coalesce(fill, F.raise_error(F.lit("masked pixels need a fill value")).cast("double")))


def blend(base: Column, overlay: Column, alpha: Column) -> Column:
    return base * (1 - alpha) + overlay * alpha


def distance_rgb(distance: Column, largest: Column, gamma: float = 0.65) -> Column:
    """Red near, blue far, grey where the distance or the scale is missing."""
    missing = distance.isNull() | largest.isNull() | (largest <= 0)
    t = F.pow(F.least(F.lit(1.0), F.greatest(F.lit(0.0), distance / largest)), F.lit(gamma))
    grey = F.array(F.lit(128), F.lit(128), F.lit(128))
    return F.when(missing, grey).otherwise(F.array(F.rint((1 - t) * 255).cast("int"), F.lit(0), F.rint(t * 255).cast("int")))


def display_range(pixels: DataFrame, windows: int, low: float = 2.0, high: float = 98.0) -> DataFrame:
    """Per band percentiles over a sparse grid of windows: every ``step``-th in both directions,
    ``windows`` of them at most in row-major order. The sampling is the feature.

    ``pixels`` has band, ty, tx, tiles_x, tiles_y, value.
    """
    step = F.greatest(F.lit(1), F.floor(F.sqrt(F.col("tiles_x") * F.col("tiles_y") / windows)).cast("int"))
    per_row = F.ceil(F.col("tiles_x") / step)
    nth = F.floor(F.col("ty") / step) * per_row + F.floor(F.col("tx") / step)
    chosen = pixels.where((F.col("ty") % step == 0) & (F.col("tx") % step == 0) & (nth < windows))
    v = finite(F.col("value"))
    return chosen.groupBy("band").agg(F.count(v).alias("n"), F.round(F.percentile(v, low / 100), 6).alias("lo"), F.round(F.percentile(v, high / 100), 6).alias("hi"))


def downsample(pixels: DataFrame, factor: int, method: str = "average") -> DataFrame:
    """``tile, band, oy, ox, value`` of blocks of ``factor`` by ``factor`` pixels.

    ``average`` is the mean of a block's finite values, of cut ones at the edge
    too; ``nearest`` the pixel whose centre lies nearest to the block's centre,
    past it where two are, and the last one of a block that is cut before it.
    """
    if factor < 1 or method not in ("average", "nearest"):
        raise ValueError("factor of 1 or more; average or nearest")
    rows = pixels.withColumns({"oy": F.expr(f"py div {factor}"), "ox": F.expr(f"px div {factor}")})
    if method == "average":
        return rows.groupBy("tile", "band", "oy", "ox").agg(F.avg(finite(F.col("value"))).alias("value"))
    size = pixels.groupBy("tile").agg(F.max("py").alias("last_y"), F.max("px").alias("last_x")) if factor > 1 else None
    if size is None:
        return rows.select("tile", "band", "oy", "ox", "value")
    middle = factor // 2
    rows = rows.join(size, "tile")
    here = (F.col("py") == F.least(F.col("oy") * factor + middle, F.col("last_y"))) & (F.col("px") == F.least(F.col("ox") * factor + middle, F.col("last_x")))
    return rows.where(here).select("tile", "band", "oy", "ox", "value")


def masked_counts(pixels: DataFrame, masked: Column) -> DataFrame:
    """``tile, band, masked_pixel_count, fully_masked``."""
    return pixels.groupBy("tile", "band").agg(F.count_if(masked).alias("masked_pixel_count"), F.bool_and(masked).alias("fully_masked"))


def max_distance(rows: DataFrame, group: str, distance: str) -> DataFrame:
    """``max_distance`` and the number ``n`` of finite distances of each group."""
    d = finite(F.col(distance))
    return rows.groupBy(group).agg(F.max(d).alias("max_distance"), F.count(d).alias("n"))


def split_bands(pixels: DataFrame, key: Column, variant: str) -> DataFrame:
    """The same pixels with ``member``: the name of the array that holds a tile's band alone, ``KEY.VARIANT.bNN.npy``."""
    return pixels.withColumn("member", F.format_string("%s.%s.b%02d.npy", key.cast("string"), F.lit(variant), F.col("band").cast("int")))

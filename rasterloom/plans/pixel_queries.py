"""Queries on pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.operators import masks
from rasterloom.operators import pixels as px
from rasterloom.plans.fixtures import PIXELS_SQL, pixels
from rasterloom.plans.registry import Registry
from rasterloom.session import table

REGISTRY = Registry()
query = REGISTRY.query
_P = "WITH " + PIXELS_SQL


def _scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-range pixels with a tenth of them masked."""
    value = F.round((F.col("value") + 0.5) * 255, 2)
    return pixels(spark, sf_dir).withColumn("value", F.when((F.col("tile") + F.col("px") * 3 + F.col("py") * 5 + F.col("band")) % 10 != 0, value))


_SCALED = _P + ", s AS (SELECT tile, band, py, px, CASE WHEN (tile + px * 3 + py * 5 + band) % 10 <> 0 THEN round((value + 0.5) * 255, 2) END AS value FROM pixels)"
_QUANTILES = ", ".join(f"round(quantile_cont(value, {p / 100}), 6) AS p{p:02d}" for p in px.PERCENTILES)


@query("q_band_stats", _SCALED + f" SELECT tile, band, count(value) AS n, round(min(value), 6) AS min, round(max(value), 6) AS max, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, {_QUANTILES} FROM s GROUP BY 1, 2")
def q_band_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return px.band_stats(_scaled(spark, sf_dir))


_RGB = _P + ", s AS (SELECT tile, band, py, px, (value + 0.5) * 255 AS value FROM pixels)"


@query("q_rgb_stats", _RGB + """, g AS (SELECT tile, py, px, avg(value) AS g FROM s WHERE band <= 3 GROUP BY 1, 2, 3) SELECT tile, round(avg(g), 6) AS brightness_mean, round(stddev_pop(g), 6) AS brightness_std,
  round(avg((g <= 100)::integer), 6) AS dark_fraction, round(avg((g >= 150)::integer), 6) AS bright_fraction FROM g GROUP BY 1""")
def q_rgb_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return px.rgb_stats(pixels(spark, sf_dir).withColumn("value", (F.col("value") + 0.5) * 255), 100.0, 150.0)


_CONTENT = """, t AS (SELECT tile, CASE WHEN coalesce(max(value), 1) <= 1.5 THEN 1.0::double ELSE 255.0::double END AS f FROM s WHERE band <= 3 GROUP BY 1),
  q AS (SELECT tile, py, px, bool_and(value IS NOT NULL) AS v, bool_and(abs(coalesce(value, 0)) <= f * (2.0::double / 255.0::double)) AS b, bool_and(coalesce(value, 0) >= f * (253.0::double / 255.0::double)) AS w FROM s JOIN t USING (tile) WHERE band <= 3 GROUP BY 1, 2, 3),
  c AS (SELECT tile, round(avg(v::integer), 6) AS valid_fraction, round(avg((NOT b)::integer), 6) AS nonzero_fraction, round(avg((v AND NOT b AND NOT w)::integer), 6) AS content_fraction, round(avg(b::integer), 6) AS black_fraction, round(avg(w::integer), 6) AS white_fraction FROM q GROUP BY 1)
  SELECT *, content_fraction < 0.5 OR black_fraction > 0.4 OR white_fraction > 0.4 AS mostly_empty FROM c"""


@query("q_content_stats", _SCALED + _CONTENT)
def q_content_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return px.content_stats(_scaled(spark, sf_dir), min_content=0.5)


_SKIP = """, d AS (SELECT * FROM s WHERE band <= 3), t AS (SELECT tile, coalesce(max(value), 0) AS m, stddev_pop(value) AS g FROM d GROUP BY 1),
  ch AS (SELECT tile, avg(sd) AS c FROM (SELECT tile, band, stddev_pop(value) AS sd FROM d GROUP BY 1, 2) GROUP BY 1),
  l AS (SELECT tile, CASE WHEN m <= 1.5 THEN 0.02 WHEN m <= 255 THEN 5.0 ELSE m * (5.0::double / 255.0::double) END AS bt, CASE WHEN m <= 1.5 THEN 0.98 WHEN m <= 255 THEN 250.0 ELSE m * (250.0::double / 255.0::double) END AS wt,
    g * CASE WHEN m <= 1.5 THEN 255.0 WHEN m <= 255 THEN 1.0 ELSE 255.0 / greatest(m, 1) END AS gs, c * CASE WHEN m <= 1.5 THEN 255.0 WHEN m <= 255 THEN 1.0 ELSE 255.0 / greatest(m, 1) END AS cs FROM t JOIN ch USING (tile)),
  q AS (SELECT tile, py, px, any_value(gs) AS gs, any_value(cs) AS cs, bool_and(value IS NOT NULL) AS v, bool_and(coalesce(value <= bt, false)) AS b, bool_and(coalesce(value >= wt, false)) AS w FROM d JOIN l USING (tile) GROUP BY 1, 2, 3),
  c AS (SELECT tile, round(avg((v AND NOT b AND NOT w)::integer), 6) AS content_fraction, round(avg(b::integer), 6) AS black_fraction, round(avg(w::integer), 6) AS white_fraction, round(avg(v::integer), 6) AS valid_fraction,
    round(max(gs), 4) AS global_std, round(max(cs), 4) AS channel_std_mean FROM q GROUP BY 1)
  SELECT *, CASE WHEN valid_fraction <= 0.05 THEN 'mostly_invalid' WHEN content_fraction < 0.75 THEN 'low_content' WHEN black_fraction > 0.75 THEN 'mostly_black' WHEN white_fraction > 0.75 THEN 'mostly_white'
    WHEN global_std < 30 THEN 'too_flat_global' WHEN channel_std_mean < 31 THEN 'too_flat_channels' ELSE '' END AS reason FROM c"""


@query("q_skip_decision", _SCALED + _SKIP)
def q_skip_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return px.skip_decisions(_scaled(spark, sf_dir), min_content=0.75, min_global_std=30.0, min_channel_std=31.0)


@query("q_fill_mask", _SCALED + " SELECT tile, band, py, px, coalesce(value, -1) AS value FROM s")
def q_fill_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = px.fill_masked(F.col("value"), F.col("value").isNull(), F.lit(-1.0))
    return _scaled(spark, sf_dir).withColumn("value", value)


@query("q_masked_count", _SCALED + " SELECT tile, band, count(*) - count(value) AS masked_pixel_count, count(value) = 0 AS fully_masked FROM s GROUP BY 1, 2")
def q_masked_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return px.masked_counts(_scaled(spark, sf_dir), F.col("value").isNull())


@query("q_band_split", _P + " SELECT tile, 'T' || tile || '.RGB.b' || lpad(band::varchar, 2, '0') || '.npy' AS member, count(*) AS n, round(sum(value), 6) AS total FROM pixels GROUP BY 1, band")
def q_band_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = px.split_bands(pixels(spark, sf_dir), F.concat(F.lit("T"), F.col("tile")), "RGB")
    return rows.groupBy("tile", "member").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"))


_BOUND = ", b AS (SELECT tile, band, quantile_cont(value, 0.02) AS lo, quantile_cont(value, 0.98) AS hi, min(value) AS least, max(value) AS most FROM s GROUP BY 1, 2)"


@query("q_stretch_u8", _SCALED + _BOUND + """ SELECT tile, band, py, px, (CASE WHEN lo IS NULL THEN 0 WHEN hi <= lo THEN CASE WHEN least > 0 THEN 255 ELSE 0 END
  ELSE coalesce(floor(least(255.0::double, greatest(0.0::double, (value - lo) * 255.0::double / (hi - lo)))), 0) END)::integer AS u8 FROM s JOIN b USING (tile, band)""")
def q_stretch_u8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return px.stretch_u8(_scaled(spark, sf_dir))


@query("q_scale_u8", _SCALED + _BOUND + """ SELECT tile, band, py, px, (CASE WHEN lo IS NULL THEN 0 WHEN most <= least THEN CASE WHEN most > 0 THEN 255 ELSE 0 END
  ELSE coalesce(round_even(255.0::double * least(1.0::double, greatest(0.0::double, (value - CASE WHEN hi <= lo THEN least ELSE lo END) / (CASE WHEN hi <= lo THEN most ELSE hi END - CASE WHEN hi <= lo THEN least ELSE lo END))), 0), 0) END)::integer AS u8 FROM s JOIN b USING (tile, band)""")
def q_scale_u8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return px.scale_u8(_scaled(spark, sf_dir))


@query("q_band_bounds", _P + ", w AS (SELECT tile, band, quantile_cont(value, 0.05) AS lo, quantile_cont(value, 0.95) AS hi FROM pixels GROUP BY 1, 2) SELECT band, round(min(lo), 6) AS src_lo, round(max(hi), 6) AS src_hi FROM w GROUP BY 1")
def q_band_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return px.band_bounds(pixels(spark, sf_dir).withColumnRenamed("tile", "window"))


@query("q_quantize", _P + """ SELECT tile, band, py, px, floor(least(65535, greatest(0, (value + 0.25::double) * 65535 / 0.5::double)))::integer AS u16, floor(least(255, greatest(0, value * 1000)))::integer AS clipped FROM pixels""")
def q_quantize(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo, hi = F.lit(-0.25), F.lit(0.25)
    return pixels(spark, sf_dir).select("tile", "band", "py", "px", px.quantize(F.col("value"), lo, hi, "uint16").alias("u16"), px.quantize(F.col("value") * 1000, lo, hi, "uint8", "none").alias("clipped"))


@query("q_display_range", _P + """, g AS (SELECT band, value, tile % 20 AS tx, (tile // 20) % 25 AS ty FROM pixels), k AS (SELECT * FROM g WHERE tx % 2 = 0 AND ty % 2 = 0 AND (ty // 2) * 10 + tx // 2 < 100)
  SELECT band, count(value) AS n, round(quantile_cont(value, 0.02), 6) AS lo, round(quantile_cont(value, 0.98), 6) AS hi FROM k GROUP BY 1""")
def q_display_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = pixels(spark, sf_dir).selectExpr("band", "value", "tile % 20 as tx", "(tile div 20) % 25 as ty", "20 as tiles_x", "25 as tiles_y")
    return px.display_range(grid, 100)


@query("q_blend", _P + " SELECT tile, band, py, px, round(value * 0.4::double + (band / 4) * 0.6::double, 6) AS blended FROM pixels")
def q_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels(spark, sf_dir).select("tile", "band", "py", "px", F.round(px.blend(F.col("value"), F.col("band") / 4, F.lit(0.6)), 6).alias("blended"))


@query("q_distance_rgb", """WITH d AS (SELECT p_partkey, CASE WHEN p_size % 10 <> 0 THEN p_size::double END AS d, (SELECT max(p_size)::double FROM part WHERE p_size % 10 <> 0) AS m FROM part)
  SELECT p_partkey, CASE WHEN d IS NULL THEN 128 ELSE round_even((1 - pow(least(1, d / m), 0.65)) * 255, 0) END::integer AS red, CASE WHEN d IS NULL THEN 128 ELSE 0 END AS green,
  CASE WHEN d IS NULL THEN 128 ELSE round_even(pow(least(1, d / m), 0.65) * 255, 0) END::integer AS blue FROM d""")
def q_distance_rgb(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") % 10 != 0, F.col("p_size").cast("double")).alias("d"))
    rows = rows.crossJoin(F.broadcast(rows.agg(F.max("d").alias("m"))))  # one row
    rgb = px.distance_rgb(F.col("d"), F.col("m"))
    return rows.select("p_partkey", rgb[0].alias("red"), rgb[1].alias("green"), rgb[2].alias("blue"))


@query("q_max_distance", "SELECT l_suppkey AS shard, max(l_discount) AS max_distance, count(l_discount) AS n FROM lineitem GROUP BY 1")
def q_max_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("shard"), F.col("l_discount").alias("distance"))
    return px.max_distance(rows, "shard", "distance")


@query("q_downsample_nearest", _P + " SELECT tile, band, py // 2 AS oy, px // 2 AS ox, value FROM pixels WHERE py % 2 = 1 AND px % 2 = 1")
def q_downsample_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factor two: the pixel whose centre lies nearest to (and past) the block's centre."""
    return px.downsample(pixels(spark, sf_dir), 2, "nearest")


@query("q_downsample_average", _P + " SELECT tile, band, py // 2 AS oy, px // 2 AS ox, round(avg(value), 6) AS value FROM pixels GROUP BY 1, 2, 3, 4")
def q_downsample_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return px.downsample(pixels(spark, sf_dir), 2, "average").withColumn("value", F.round("value", 6))


#: The objects of every band, each band as a tile of its own.
_MASK = _P + ", m AS (SELECT tile * 4 + band - 1 AS tile, py, px, floor(abs(value) * 20)::bigint AS object FROM pixels)"


def _mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pixels(spark, sf_dir).select((F.col("tile") * 4 + F.col("band") - 1).alias("tile"), "py", "px", F.floor(F.abs("value") * 20).alias("object"))


@query("q_mask_summary", _MASK + """, o AS (SELECT tile, object, count(*) AS n FROM m WHERE object > 0 GROUP BY 1, 2), a AS (SELECT tile, count(*) AS total FROM m GROUP BY 1)
  SELECT tile, count(object) AS objects, round(coalesce(sum(n), 0) / any_value(total), 6) AS foreground_fraction, coalesce(max(n), 0) AS largest FROM a LEFT JOIN o USING (tile) GROUP BY 1""")
def q_mask_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masks.mask_summary(_mask(spark, sf_dir)).select("tile", "objects", F.round("foreground_fraction", 6).alias("foreground_fraction"), "largest")


@query("q_mask_bbox", _MASK + " SELECT tile, object, greatest(min(px) - 1, 0) AS x0, greatest(min(py) - 1, 0) AS y0, least(max(px) + 1, 3) AS x1, least(max(py) + 1, 3) AS y1, count(*) AS area FROM m WHERE object > 0 GROUP BY 1, 2 HAVING count(*) / 16 >= 0.1")
def q_mask_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of objects of at least a tenth of the tile, padded by one pixel and clipped."""
    return masks.object_boxes(_mask(spark, sf_dir), 1, 4, 4, 0.1)


@query("q_object_crops", _MASK + """, b AS (SELECT tile, object, greatest(min(px) - 1, 0) AS x0, greatest(min(py) - 1, 0) AS y0, least(max(px) + 1, 3) AS x1, least(max(py) + 1, 3) AS y1 FROM m WHERE object > 0 GROUP BY 1, 2)
  SELECT b.tile, b.object, m.py - y0 AS y, m.px - x0 AS x, CASE WHEN m.object = b.object THEN m.object::double ELSE 128 END AS value FROM b JOIN m ON m.tile = b.tile AND m.px BETWEEN x0 AND x1 AND m.py BETWEEN y0 AND y1""")
def q_object_crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every object cut out of its tile; here the object numbers are the picture."""
    mask = _mask(spark, sf_dir)
    picture = mask.select("tile", F.lit(1).alias("band"), "py", "px", F.col("object").cast("double").alias("value"))
    return masks.object_crops(picture, mask, 4, 4, "masked", 1).drop("band")


def _objects(mask: DataFrame) -> DataFrame:
    rows = mask.where("object > 0").select("tile", "object").distinct()
    name = F.get(F.array(F.lit("roads"), F.lit("trees"), F.lit("grass")), (F.col("object") % 3).cast("int"))
    return rows.select("tile", "object", name.alias("class"), ((F.col("tile") * 7 + F.col("object")) % 10 / 10).alias("score"))


_PAINTED = "SELECT tile, py, px, CASE WHEN object = 0 THEN 'background' WHEN (tile * 7 + object) % 10 < 3 THEN 'other' ELSE ['roads', 'trees', 'grass'][(object % 3 + 1)::integer] END AS class FROM m"


@query("q_class_mask", _MASK + " " + _PAINTED)
def q_class_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each object's class painted on its pixels; ``other`` below the score floor."""
    mask = _mask(spark, sf_dir)
    return masks.paint_classes(mask, _objects(mask), 0.3)


COLORS = {"roads": (200, 100, 50), "trees": (0, 128, 0), "grass": (120, 220, 80)}


@query("q_class_overlay", _MASK + f", c AS ({_PAINTED}), k AS (SELECT tile, py, px, unnest([1, 2, 3]) AS band, class FROM c)" + """
  SELECT tile, band, py, px, floor(CASE WHEN class = 'background' THEN 100 ELSE 55 + 0.45::double * CASE class WHEN 'roads' THEN [200, 100, 50][band] WHEN 'trees' THEN [0, 128, 0][band] WHEN 'grass' THEN [120, 220, 80][band] ELSE 0 END END)::integer AS value FROM k""")
def q_class_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class colors over an even grey picture."""
    mask = _mask(spark, sf_dir)
    painted = masks.paint_classes(mask, _objects(mask), 0.3)
    colored = painted.select("tile", "py", "px", masks.class_color(F.col("class"), COLORS).alias("color"), (F.col("class") != "background").alias("foreground"))
    grey = mask.select("tile", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("band"), "py", "px", F.lit(100.0).alias("value"))
    return masks.overlay(grey, colored)


@query("q_weighted_landcover", _MASK + """, o AS (SELECT tile, object, object % 3 AS c, count(*) / 16 AS f, ((tile * 7 + object) % 10) / 10.0::double AS s FROM m WHERE object > 0 GROUP BY tile, object),
  k AS (SELECT tile, c, sum(f * s) AS w, sum(f) AS assigned FROM o GROUP BY 1, 2)
  SELECT tile, c AS class, round(assigned, 6) AS assigned_area_fraction, round(CASE WHEN sum(w) OVER (PARTITION BY tile) > 0 THEN w / sum(w) OVER (PARTITION BY tile) ELSE 0 END, 6) AS score FROM k""")
def q_weighted_landcover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area-weighted class scores of a tile's objects, renormalised; here an object scores in one class."""
    scores = _mask(spark, sf_dir).where("object > 0").groupBy("tile", "object").agg((F.count("*") / 16).alias("fraction"))
    scores = scores.select("tile", "object", "fraction", (F.col("object") % 3).alias("class"), ((F.col("tile") * 7 + F.col("object")) % 10 / 10).alias("score"))
    return masks.weighted_landcover(scores).select("tile", "class", F.round("assigned_area_fraction", 6).alias("assigned_area_fraction"), F.round("score", 6).alias("score"))

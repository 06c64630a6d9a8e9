"""Queries that write tiles to archives and GeoTIFF files and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.plans.fixtures import PIXELS_SQL, pixels
from rasterloom.plans.registry import Registry
from rasterloom.session import shared_path
from rasterloom.sources import geotiff, shards

REGISTRY = Registry()
query = REGISTRY.query
_P = "WITH " + PIXELS_SQL


def _tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tile_id, bands`` with bands as array<array<double>> in row-major order."""
    band = F.transform(F.sort_array(F.collect_list(F.struct("py", "px", "value"))), lambda e: e["value"])
    rows = pixels(spark, sf_dir).groupBy("tile", "band").agg(band.alias("values"))
    bands = F.transform(F.sort_array(F.collect_list(F.struct("band", "values"))), lambda e: e["values"])
    return rows.groupBy("tile").agg(bands.alias("bands")).select(F.format_string("T%06d", "tile").alias("tile_id"), F.col("tile").alias("tile"), "bands")


@query("q_shard_roundtrip", _P + " SELECT 'T' || lpad(tile::varchar, 6, '0') AS tile_id, band::integer AS band, count(*) AS n, round(sum(value), 6) AS total, min(value) AS least, max(value) AS most FROM pixels GROUP BY 1, 2")
def q_shard_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles to tar shards and back, member by member."""
    path = shared_path(spark, "shards")
    tiles = _tiles(spark, sf_dir).withColumn("shard", F.expr("tile div 64"))
    written = shards.write_shards(tiles, path, height=4, width=4, variant="RGB", shard_size=2048)
    found = shards.read_members(spark, [r.path for r in written.select("path").collect()])  # one row per shard
    value = F.explode("values").alias("v")
    return found.select("tile_id", "band", value).groupBy("tile_id", "band").agg(F.count("*").alias("n"), F.round(F.sum("v"), 6).alias("total"), F.min("v").alias("least"), F.max("v").alias("most"))


@query("q_geotiff_roundtrip", _P + """ SELECT 'T' || lpad(tile::varchar, 6, '0') AS tile_id, 4 AS width, 4 AS height, 4 AS count, 'float64' AS dtype, 4326 AS srid, round(min(tile) % 360 - 180, 6) AS minx, round(-90 + (min(tile) // 360) % 180 + 4 * 0.25::double, 6) AS maxy,
  round(sum(value) FILTER (band = 2 AND py >= 1 AND py < 3 AND px >= 1 AND px < 4), 6) AS window_sum FROM pixels GROUP BY tile""")
def q_geotiff_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles to GeoTIFF files; headers and one window of one band read back."""
    path = shared_path(spark, "tiffs")
    west, south = F.col("tile") % 360 - 180, F.expr("-90 + (tile div 360) % 180")
    tiles = _tiles(spark, sf_dir).select("tile_id", "bands", F.array(west.cast("double"), F.lit(0.25), F.lit(0.0), (south + 1).cast("double"), F.lit(0.0), F.lit(-0.25)).alias("transform"))
    files = geotiff.write_tiles(tiles, path, height=4, width=4, srid=4326)
    headers = geotiff.read_headers(files)
    windows = geotiff.read_windows(files.select("tile_id", "path", F.lit(1).alias("x"), F.lit(1).alias("y"), F.lit(3).alias("w"), F.lit(2).alias("h"), F.array(F.lit(2)).alias("bands")))
    total = F.aggregate("values", F.lit(0.0), lambda s, v: s + v)
    joined = headers.join(windows.select("tile_id", F.round(total, 6).alias("window_sum")), "tile_id")
    return joined.select("tile_id", "width", "height", "count", "dtype", "srid", F.round(F.col("transform")[0], 6).alias("minx"), F.round(F.col("transform")[3], 6).alias("maxy"), "window_sum")

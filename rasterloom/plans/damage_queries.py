"""Queries on spatial evidence and damage scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.functions import scoring
from rasterloom.operators import damage, spatial
from rasterloom.plans.fixtures import view, with_views
from rasterloom.plans.registry import Registry
from rasterloom.session import table, written

REGISTRY = Registry()
query = REGISTRY.query
#: The fixture's geometries lie degrees apart, not thousandths of a degree.
SIGMA_AREA, SIGMA_LINE = 0.7, 1.0

_P = with_views("mosaics", "segments", "areas") + """, pt AS (SELECT mosaic_key AS point_id, (minx + maxx) / 2 AS px, (miny + maxy) / 2 AS py FROM mosaics)"""
_LINE = """, sd AS (SELECT point_id, line_id, greatest(0, least(1, ((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) / (pow(x2 - x1, 2) + pow(y2 - y1, 2)))) AS t, px, py, x1, y1, x2, y2 FROM pt, segments),
  nl AS (SELECT point_id, line_id, round(sqrt(pow(px - (x1 + t * (x2 - x1)), 2) + pow(py - (y1 + t * (y2 - y1)), 2)), 9) AS distance FROM sd QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY distance, line_id) = 1)"""
_AREA = """, na AS (SELECT point_id, area_id, round(sqrt(pow(greatest(minx - px, px - maxx, 0), 2) + pow(greatest(miny - py, py - maxy, 0), 2)), 9) AS distance FROM pt, areas QUALIFY row_number() OVER (PARTITION BY point_id ORDER BY distance, area_id) = 1)"""
_HIT = """, hit AS (SELECT m.mosaic_key AS tile_id, count(a.area_id) > 0 AS intersects, coalesce(bool_or((m.minx + m.maxx) / 2 > a.minx AND (m.minx + m.maxx) / 2 < a.maxx AND (m.miny + m.maxy) / 2 > a.miny AND (m.miny + m.maxy) / 2 < a.maxy), false) AS center_inside
  FROM mosaics m LEFT JOIN areas a ON m.minx <= a.maxx AND a.minx <= m.maxx AND m.miny <= a.maxy AND a.miny <= m.maxy GROUP BY 1)"""


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "mosaics").select(F.col("mosaic_key").alias("point_id"), ((F.col("minx") + F.col("maxx")) / 2).alias("px"), ((F.col("miny") + F.col("maxy")) / 2).alias("py"))


def _tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "mosaics").withColumnRenamed("mosaic_key", "tile_id")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.nearest_segments(_points(spark, sf_dir), view(spark, sf_dir, "segments"))


def _areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.nearest_boxes(_points(spark, sf_dir), view(spark, sf_dir, "areas"))


@query("q_nearest_segment", _P + _LINE + " SELECT point_id, line_id, round(distance, 6) AS distance FROM nl")
def q_nearest_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).withColumn("distance", F.round("distance", 6))


@query("q_nearest_area", _P + _AREA + " SELECT point_id, area_id, round(distance, 6) AS distance FROM na")
def q_nearest_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _areas(spark, sf_dir).withColumn("distance", F.round("distance", 6))


@query("q_area_intersects", _P + _HIT + " SELECT * FROM hit")
def q_area_intersects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.area_hits(_tiles(spark, sf_dir), view(spark, sf_dir, "areas"))


@query("q_context_clip", _P + """, b AS (SELECT mosaic_id, line_id, x1, y1, x2, y2, (m.minx - 1.5 - x1) / (x2 - x1) AS ta, (m.maxx + 1.5 - x1) / (x2 - x1) AS tb, (m.miny - 1.5 - y1) / (y2 - y1) AS tc, (m.maxy + 1.5 - y1) / (y2 - y1) AS td FROM mosaics m, segments),
  c AS (SELECT *, greatest(0, ta, tc) AS t0, least(1, tb, td) AS t1 FROM b)
  SELECT mosaic_id, line_id, round(x1 + t0 * (x2 - x1), 6) AS cx1, round(y1 + t0 * (y2 - y1), 6) AS cy1, round(x1 + t1 * (x2 - x1), 6) AS cx2, round(y1 + t1 * (y2 - y1), 6) AS cy2 FROM c WHERE t0 <= t1""")
def q_context_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spatial.context_clip(view(spark, sf_dir, "mosaics"), view(spark, sf_dir, "segments"), 1.5)
    return rows.withColumns({c: F.round(c, 6) for c in ("cx1", "cy1", "cx2", "cy2")})


@query("q_spatial_router", _P + _LINE + _HIT + " SELECT tile_id, CASE WHEN intersects THEN 'intersects' ELSE 'nointersects' END AS bucket, line_id, round(distance, 6) AS distance FROM hit JOIN nl ON point_id = tile_id")
def q_spatial_router(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = spatial.area_hits(_tiles(spark, sf_dir), view(spark, sf_dir, "areas"))
    return damage.spatial_router(_tiles(spark, sf_dir), hits, _lines(spark, sf_dir)).withColumn("distance", F.round("distance", 6))


@query("q_gaussian_score", "SELECT l_orderkey, l_linenumber, l_partkey, round(exp(-pow(l_discount / 0.05::double, 2)), 6) AS score FROM lineitem")
def q_gaussian_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(scoring.gaussian(F.col("l_discount"), 0.05), 6).alias("score"))


@query("q_noisy_or", "SELECT l_orderkey, l_linenumber, l_partkey, round(1 - (1 - least(1, greatest(0, l_discount * 3))) * (1 - least(1, greatest(0, l_tax))) * (1 - least(1, greatest(0, l_quantity / 50 - 0.2))), 6) AS score FROM lineitem")
def q_noisy_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = scoring.noisy_or(F.col("l_discount") * 3, F.col("l_tax"), F.col("l_quantity") / 50 - 0.2)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(score, 6).alias("score"))


_SEMANTIC = ["case tile_id % 3 when 0 then 'low' when 1 then 'medium' else 'high' end as confidence", "cast(tile_id % 20 as double) / 100 as margin", "cast(tile_id % 10 as double) / 10 as debris", "cast(tile_id % 7 as double) / 7 as structure", "cast(tile_id % 4 as double) / 4 as tree"]
_EVIDENCE = "CASE WHEN confidence IN ('medium', 'high') THEN least(1, greatest(0, least((0.2::double * debris + 0.06::double * structure * line_score + 0.05::double * tree * line_score) * least(1, margin / 0.1::double), 0.2::double))) ELSE 0 END"
_ALL = _P + _LINE + _AREA + _HIT + f""", f AS (SELECT tile_id, intersects OR center_inside AS hit, na.distance AS area_distance, nl.distance AS line_distance, exp(-pow(nl.distance / 1.0, 2)) AS line_score, exp(-pow(na.distance / 0.7::double, 2)) AS area_score, {', '.join(_SEMANTIC)}
    FROM hit JOIN nl ON nl.point_id = tile_id JOIN na ON na.point_id = tile_id), e AS (SELECT *, {_EVIDENCE} AS semantic FROM f),
  s AS (SELECT tile_id, semantic, 1 - (1 - 0.9::double * hit::integer) * (1 - 0.35::double * area_score) * (1 - 0.6::double * line_score) * (1 - 0.1::double * semantic) AS score FROM e)"""


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = _tiles(spark, sf_dir)
    hits = spatial.area_hits(tiles, view(spark, sf_dir, "areas"))
    lines = _lines(spark, sf_dir).select(F.col("point_id").alias("tile_id"), F.col("distance").alias("line_distance"))
    areas = _areas(spark, sf_dir).select(F.col("point_id").alias("tile_id"), F.col("distance").alias("area_distance"))
    rows = hits.join(lines, "tile_id").join(areas, "tile_id").selectExpr("*", *_SEMANTIC)
    evidence = damage.semantic_evidence(*(F.col(c) for c in ("confidence", "margin", "debris", "structure", "tree")), scoring.gaussian(F.col("line_distance"), SIGMA_LINE))
    rows = rows.withColumn("semantic", evidence)
    score = damage.damage_score(F.col("intersects") | F.col("center_inside"), F.col("area_distance"), F.col("line_distance"), F.col("semantic"), SIGMA_AREA, SIGMA_LINE)
    return rows.select("tile_id", "semantic", score.alias("score"))


@query("q_semantic_evidence", _ALL + " SELECT tile_id, round(semantic, 6) AS semantic FROM s")
def q_semantic_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("tile_id", F.round("semantic", 6).alias("semantic"))


@query("q_damage_score", _ALL + " SELECT tile_id, round(score, 6) AS score FROM s")
def q_damage_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("tile_id", F.round("score", 6).alias("score"))


@query("q_damage_bucket", _ALL + """ SELECT tile_id, CASE WHEN score >= 0.7 THEN 'damage_review/01_likely_damage' WHEN score >= 0.35 THEN 'damage_review/02_possible_damage' WHEN score >= 0.1 THEN 'damage_review/03_near_context' ELSE 'damage_review/05_likely_negative_sample' END AS bucket,
  CASE WHEN score >= 0.7 THEN 'likely_damage' WHEN score >= 0.35 THEN 'possible_damage' WHEN score >= 0.1 THEN 'near_context' ELSE 'likely_negative_sample' END AS label, score >= 0.1 AS review_required FROM s""")
def q_damage_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(_scored(spark, sf_dir), "scores").select("tile_id", damage.damage_bucket(F.col("score")).alias("b")).select("tile_id", "b.*")

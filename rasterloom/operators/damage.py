"""Damage evidence of tiles from geometry and semantic labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.functions.scoring import clamp01, gaussian, noisy_or

# Decay lengths, evidence weights, semantic bonuses and bucket bounds.
SIGMA_AREA, SIGMA_LINE = 0.0007, 0.0010
W_AREA_HIT, W_AREA, W_LINE, W_SEMANTIC = 0.90, 0.35, 0.60, 0.10
DEBRIS_BONUS, STRUCTURE_BONUS, TREE_BONUS, SEMANTIC_CAP, MARGIN_SCALE = 0.20, 0.06, 0.05, 0.20, 0.10
BUCKETS = [(0.70, "01_likely_damage", "likely_damage"), (0.35, "02_possible_damage", "possible_damage"), (0.10, "03_near_context", "near_context")]
NEGATIVE = ("05_likely_negative_sample", "likely_negative_sample")
ROOT = "damage_review"


def semantic_evidence(confidence: Column, margin: Column, debris: Column, structure: Column, tree: Column, line_score: Column) -> Column:
    """0 unless the confidence is medium or high; weak, and weaker where classes tie."""
    raw = DEBRIS_BONUS * debris + STRUCTURE_BONUS * structure * line_score + TREE_BONUS * tree * line_score
    scaled = F.least(raw * clamp01(F.coalesce(margin, F.lit(0.0)) / MARGIN_SCALE), F.lit(SEMANTIC_CAP))
    return F.when(F.coalesce(confidence.isin("medium", "high"), F.lit(False)), clamp01(scaled)).otherwise(0.0)


def damage_score(area_hit: Column, area_distance: Column, line_distance: Column, semantic: Column, sigma_area: float = SIGMA_AREA, sigma_line: float = SIGMA_LINE) -> Column:
    return noisy_or(
        W_AREA_HIT * F.when(area_hit, 1.0).otherwise(0.0), W_AREA * gaussian(area_distance, sigma_area),
        W_LINE * gaussian(line_distance, sigma_line), W_SEMANTIC * semantic,
    )


def damage_bucket(score: Column) -> Column:
    """struct<bucket, label, review_required>."""

    def entry(name: str, label: str, review: bool) -> Column:
        return F.struct(F.lit(f"{ROOT}/{name}").alias("bucket"), F.lit(label).alias("label"), F.lit(review).alias("review_required"))

    out = entry(*NEGATIVE, False)
    for least, name, label in reversed(BUCKETS):
        out = F.when(score >= least, entry(name, label, True)).otherwise(out)
    return out


def spatial_router(tiles: DataFrame, hits: DataFrame, lines: DataFrame) -> DataFrame:
    """``tile_id, bucket, line_id, distance``: intersects or nointersects, with the nearest line."""
    near = lines.withColumnRenamed("point_id", "tile_id")
    rows = tiles.select("tile_id").join(hits, "tile_id", "left").join(near, "tile_id", "left")
    return rows.select("tile_id", F.when(F.coalesce("intersects", F.lit(False)), "intersects").otherwise("nointersects").alias("bucket"), "line_id", "distance")

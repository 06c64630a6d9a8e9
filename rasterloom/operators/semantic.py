"""Prompt scoring, class collapse and triage of tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rasterloom.functions.scoring import clamp01

REVIEW = "review"
# Target classes in the order that breaks ties.
CLASSES = ("structures", "roads", "vehicle_tracks", "trees", "grass", "dirt", "crops", "debris")
# Class, least score, least margin, largest second score for high confidence.
THRESHOLDS = [
    ("structures", 0.50, 0.08, 0.38),
    ("roads", 0.42, 0.06, 0.40),
    ("vehicle_tracks", 0.42, 0.06, 0.38),
    ("trees", 0.60, 0.07, 0.40),
    ("grass", 0.45, 0.05, 0.42),
    ("dirt", 0.45, 0.05, 0.42),
    ("crops", 0.60, 0.06, 0.40),
    ("debris", 0.60, 0.04, 0.42),
]
# Detailed classes of each target class.
DETAILED = {
    "structures": ["residential_roof", "large_structure_roof", "small_outbuilding_roof", "damaged_structure_roof", "roofless_structure_remains"],
    "roads": ["paved_road", "gravel_road", "full_width_dirt_road", "parking_or_driveway", "rural_access_road", "damaged_road_surface"],
    "vehicle_tracks": ["paired_tire_ruts", "paired_tire_ruts_in_grass", "paired_tire_ruts_in_dirt", "paired_tire_ruts_through_crops"],
    "trees": ["single_tree_crown", "dense_tree_canopy", "conifer_tree_canopy", "damaged_or_downed_tree"],
    "grass": ["mowed_grass", "rough_grassland", "pasture_or_meadow"],
    "dirt": ["bare_soil", "disturbed_bare_ground"],
    "crops": ["green_crop_rows", "bare_soil_crop_rows"],
    "debris": ["rubble_or_scattered_debris"],
}
# Review gates and confidence levels.
MIN_TOP_SCORE, LOW_EVIDENCE, TIE_MARGIN = 0.26, 0.34, 0.02
MEDIUM_SCORE, MEDIUM_MARGIN = 0.38, 0.035
DETAIL_SCORE, DETAIL_MARGIN = 0.26, 0.04


#: Rows of a table that is sent to every executor whole.
BROADCAST_ROWS = 10_000


def small(rows: DataFrame, most: int | None = None) -> DataFrame:
    """``rows`` marked for a broadcast if they are few, looked at up to the bound; else left to the planner."""
    most = most or BROADCAST_ROWS
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows


def threshold_table(spark: SparkSession, rules: dict[str, dict[str, float]] | None = None) -> DataFrame:
    """``class, min_score, min_margin, max_second``; from a config's rules, where what a rule lacks is 0, or the built-in ones."""
    rows = THRESHOLDS if rules is None else [(c, *(float(r.get(k, 0.0)) for k in ("min_score", "min_margin", "max_second_score"))) for c, r in rules.items()]
    return spark.createDataFrame(rows, "class string, min_score double, min_margin double, max_second double")


def class_score(scores: Column, top_class: Column, top_score: Column, name: str) -> Column:
    """A class's score: from the map of scores, else the top score if it is the top class, else 0; between 0 and 1."""
    top = F.when(top_class == name, F.coalesce(top_score, F.lit(0.0)))
    has = F.coalesce(F.map_contains_key(scores, F.lit(name)), F.lit(False))
    return clamp01(F.coalesce(F.when(has, F.coalesce(F.try_element_at(scores, F.lit(name)), F.lit(0.0))).otherwise(top), F.lit(0.0)))


def detailed_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(d, c) for c, ds in DETAILED.items() for d in ds], "detailed string, class string")


def class_order(name: Column) -> Column:
    """Place in the tie-breaking order; names outside it come last."""
    place = F.lit(len(CLASSES))
    for n, c in enumerate(CLASSES):
        place = F.when(name == c, n).otherwise(place)
    return place


def l2_normalize(vector: Column) -> Column:
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(vector, lambda x: F.when(norm > 0, x / norm).otherwise(0.0))


def prompt_logits(images: DataFrame, prompts: DataFrame, scale: float = 100.0) -> DataFrame:
    """``image_id, prompt_id, class, logit``: scaled cosine of every image with every prompt.

    The prompts (prompt_id, class, vector) go to every executor in blocks of
    about BROADCAST_ROWS; images (image_id, vector) are not shuffled.
    """
    a = images.select("image_id", l2_normalize(F.col("vector")).alias("v"))
    b = prompts.select("prompt_id", "class", l2_normalize(F.col("vector")).alias("p"))
    dot = F.aggregate(F.zip_with("v", "p", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    blocks = max(1, -(-prompts.count() // BROADCAST_ROWS))
    out = None
    for n in range(blocks):
        part = b if blocks == 1 else b.where(F.pmod(F.xxhash64("prompt_id", "class"), F.lit(blocks)) == n)
        rows = a.crossJoin(F.broadcast(part)).select("image_id", "prompt_id", "class", (dot * scale).alias("logit"))
        out = rows if out is None else out.unionByName(rows)
    return out


def class_logits(logits: DataFrame, top: int = 2) -> DataFrame:
    """``image_id, class, logit``: mean of the ``top`` best prompts of each class."""
    best = F.slice(F.sort_array(F.collect_list("logit"), asc=False), 1, max(1, top))
    mean = F.aggregate("best", F.lit(0.0), lambda s, x: s + x) / F.size("best")
    return logits.groupBy("image_id", "class").agg(best.alias("best")).select("image_id", "class", mean.alias("logit"))


def softmax(logits: DataFrame) -> DataFrame:
    """``image_id, class, p`` within each image."""
    each = Window.partitionBy("image_id")
    e = logits.withColumn("e", F.exp(F.col("logit") - F.max("logit").over(each)))
    return e.select("image_id", "class", (F.col("e") / F.sum("e").over(each)).alias("p"))


def collapse(scores: DataFrame, detailed_to_class: DataFrame, how: str = "max") -> DataFrame:
    """``image_id, class, p`` from ``image_id, detailed, p``: the greatest (or the sum of) detailed
    scores of each class, renormalised; unknown detailed classes count as review."""
    joined = scores.join(small(detailed_to_class), "detailed", "left").withColumn("class", F.coalesce("class", F.lit(REVIEW)))
    combined = joined.groupBy("image_id", "class").agg((F.max("p") if how == "max" else F.sum("p")).alias("s"))
    total = F.sum("s").over(Window.partitionBy("image_id"))
    return combined.select("image_id", "class", F.when(total > 0, F.col("s") / total).otherwise(0.0).alias("p"))


def stable_rank(scores: DataFrame) -> DataFrame:
    """``rank`` from 1: score down, then class order, then name."""
    order = Window.partitionBy("image_id").orderBy(F.desc("p"), class_order(F.col("class")), "class")
    return scores.withColumn("rank", F.row_number().over(order))


def top_two(scores: DataFrame) -> DataFrame:
    """``image_id, top_class, top_score, second_class, second_score, margin`` by one aggregation."""
    key = F.struct((-F.col("p")).alias("k"), class_order(F.col("class")).alias("o"), F.col("class").alias("c"))
    ranked = scores.groupBy("image_id").agg(F.sort_array(F.collect_list(key)).alias("r"))
    first, second = F.get("r", F.lit(0)), F.get("r", F.lit(1))
    rows = ranked.select(
        "image_id", first["c"].alias("top_class"), (-first["k"]).alias("top_score"),
        F.coalesce(second["c"], F.lit("none")).alias("second_class"), F.coalesce(-second["k"], F.lit(0.0)).alias("second_score"),
    )
    return rows.withColumn("margin", F.col("top_score") - F.col("second_score"))


def triage(tops: DataFrame, details: DataFrame, thresholds: DataFrame) -> DataFrame:
    """The decision for each image.

    ``tops`` and ``details`` come from ``top_two`` on coarse and detailed scores;
    the details carry the class of their top entry.
    """
    d = details.select("image_id", F.col("top_class").alias("top_detail"), F.col("top_score").alias("detail_score"), F.col("margin").alias("detail_margin"))
    rows = tops.join(d, "image_id", "left").join(small(thresholds), tops["top_class"] == thresholds["class"], "left")
    weak = F.col("top_score") < MIN_TOP_SCORE
    tied = (F.col("top_score") < LOW_EVIDENCE) & (F.col("margin") < TIE_MARGIN)
    agrees = F.coalesce(F.col("top_detail") == F.col("top_class"), F.lit(False))
    high = (
        (F.col("top_score") >= F.col("min_score")) & (F.col("margin") >= F.col("min_margin")) & (F.col("second_score") <= F.col("max_second"))
        & (F.col("detail_score") >= DETAIL_SCORE) & (F.col("detail_margin") >= DETAIL_MARGIN) & agrees
    )
    medium = (F.col("top_score") >= MEDIUM_SCORE) | (F.col("margin") >= MEDIUM_MARGIN)
    review = weak | tied
    level = F.when(F.coalesce(high, F.lit(False)), "high").when(medium, "medium").otherwise("low")
    return rows.select(
        "image_id", "top_class", "top_score", "second_class", "second_score", "margin",
        (~review).alias("accepted"),
        F.when(review, REVIEW).otherwise(F.col("top_class")).alias("bucket"),
        F.when(review, "review").otherwise(level).alias("confidence"),
        F.when(review, F.col("top_score")).otherwise((F.col("top_score") + F.greatest(F.col("margin"), F.lit(0.0))) / 2).alias("confidence_score"),
        F.when(weak, "true_edge_low_evidence").when(tied, "true_edge_weak_tie").otherwise("real_class_assigned").alias("reason"),
        agrees.alias("detail_agrees"),
    )


def decide(scores: DataFrame, detailed: DataFrame, thresholds: DataFrame) -> DataFrame:
    """``triage`` of raw scores: only target classes count, reasons carry their numbers, and an image
    with no target class goes to review with ``no_real_class``.

    ``scores`` has image_id, class, p; ``detailed`` the same of detailed scores, named by their class.
    """
    real = scores.where(F.col("class").isin(*CLASSES))
    rows = triage(top_two(real), top_two(detailed), thresholds)
    number = {"true_edge_low_evidence": F.format_string(f"true_edge_low_evidence:%.4f<{MIN_TOP_SCORE:.4f}", "top_score")}
    number["true_edge_weak_tie"] = F.format_string(f"true_edge_weak_tie:score=%.4f<{LOW_EVIDENCE:.4f},margin=%.4f<{TIE_MARGIN:.4f}", "top_score", "margin")
    reason = F.col("reason")
    for name, text in number.items():
        reason = F.when(F.col("reason") == name, text).otherwise(reason)
    rows = rows.withColumns({"reasons": F.array(reason), "dominant": F.col("top_class")}).drop("reason")
    none = scores.select("image_id").distinct().join(real.select("image_id").distinct(), "image_id", "left_anti")
    blank = {"top_class": F.lit(REVIEW), "top_score": F.lit(0.0), "second_class": F.lit("none"), "second_score": F.lit(0.0), "margin": F.lit(0.0), "accepted": F.lit(False), "bucket": F.lit(REVIEW), "dominant": F.lit(REVIEW)}
    blank |= {"confidence": F.lit("review"), "confidence_score": F.lit(0.0), "detail_agrees": F.lit(False), "reasons": F.array(F.lit("no_real_class: no evidence"))}
    return rows.unionByName(none.withColumns(blank))


def prefer_structures(scores: DataFrame, near: tuple[str, ...] = ("roads", "tracks", "dirt", "shadow", "mixed"), margin: float = 0.08, least: float = 0.22) -> DataFrame:
    """Where structures come within ``margin`` of a top class that is often confused with
    them, the two change places by 0.001; then scores are renormalised."""
    tops = scores.groupBy("image_id").agg(
        F.max(F.struct("p", (-class_order(F.col("class"))).alias("o"), "class")).alias("t"),
        F.coalesce(F.max(F.when(F.col("class") == "structures", F.col("p"))), F.lit(0.0)).alias("s"),
    )
    swap = F.col("t.class").isin(*near) & (F.col("s") >= least) & (F.col("t.p") - F.col("s") <= margin)
    rows = scores.join(tops, "image_id").withColumn(
        "q",
        F.when(swap & (F.col("class") == "structures"), F.col("t.p") + 0.001)
        .when(swap & (F.col("class") == F.col("t.class")), F.greatest(F.lit(0.0), F.col("s") - 0.001))
        .otherwise(F.col("p")),
    )
    total = F.sum("q").over(Window.partitionBy("image_id"))
    return rows.select("image_id", "class", F.when(total > 0, F.col("q") / total).otherwise(F.col("q")).alias("p"))


def mostly_bucket(tops: DataFrame, mostly: float = 0.60, second: float = 0.25, mode: str = "hybrid") -> DataFrame:
    """``mostly_X``, ``hybrid_X_Y`` or ``mixed``."""
    mixed = (F.col("top_score") < mostly) | (F.col("second_score") >= second)
    hybrid = F.when(F.col("second_score") >= second, F.concat_ws("_", F.lit("hybrid"), "top_class", "second_class")).otherwise("mixed")
    bucket = F.when(~mixed, F.concat(F.lit("mostly_"), "top_class")).otherwise(hybrid if mode == "hybrid" else F.lit("mixed"))
    return tops.withColumns({"mixed": mixed, "bucket": bucket})

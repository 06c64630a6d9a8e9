"""Label, review and routing rows of tiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rasterloom.functions.text import safe_bucket
from rasterloom.operators.semantic import CLASSES, REVIEW
from rasterloom.session import written

TEXT = ("dominant", "confidence", "top_class", "second_class")
NUMBERS = ("confidence_score", "top_score", "second_score", "margin")


#: A tile's semantic payload, as far as label rows read it.
SEMANTIC = (
    "struct<bucket:string,dominant:string,confidence:string,confidence_score:double,top_class:string,top_score:double,second_class:string,second_score:double,margin:double,"
    "top_detailed_class:string,detail_agrees:boolean,reasons:array<string>>"
)


def is_review(label: Column) -> Column:
    """Review, or no target class."""
    return ~F.coalesce(label.isin(*CLASSES), F.lit(False))


def label_rows(tiles: DataFrame) -> DataFrame:
    """Flat label rows; what a payload lacks is '' or 0.

    ``tiles`` has tile_id, shard, bucket and a nullable struct ``semantic``.
    """
    s = F.col("semantic")
    return tiles.select(
        "tile_id", "shard", F.coalesce(s["bucket"], "bucket").alias("label"), F.coalesce("bucket", F.lit("")).alias("bucket"),
        *(F.coalesce(s[c], F.lit("")).alias(c) for c in TEXT), *(F.coalesce(s[c], F.lit(0.0)).alias(c) for c in NUMBERS),
        F.coalesce(F.array_join(s["reasons"], "|"), F.lit("")).alias("review_reasons"),
    )


def sidecars(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(label rows, review rows): a tile goes to one of the two."""
    review = is_review(F.col("label"))
    return rows.where(~review), rows.where(review).withColumn("bucket", F.lit(REVIEW))


#: A tile's damage payload.
_SCORES = ("area_intersection_score", "area_distance_score", "centerline_distance_score", "semantic_score", "debris_score", "structure_score", "tree_score")
DAMAGE = (
    "struct<bucket:string,dominant:string,damage_likelihood:double,damage_label:boolean,route_source:string,review_required:boolean,review_reason:string,has_master_damage_geometry:boolean,inside_damage_area:boolean,"
    "intersects_damage_area:boolean,tile_center_inside_damage_area:boolean,distance_to_damage_line:double,distance_to_damage_centerline:double,distance_to_damage_area:double,nearest_damage_line_id:string,"
    "nearest_damage_area_id:string,metamosaic_id:string,master_gpkg_path:string,damage_line_layer:string,damage_area_layer:string,mosaic_crs:string,geometry_clipped_to_mosaic_context:boolean,router_version:string,"
    "geometry_context_distance:double,sigma_centerline:double,sigma_area:double,semantic_top_class:string,semantic_confidence:string,semantic_top_score:double,semantic_second_class:string,semantic_second_score:double,"
    "semantic_margin:double,score:struct<" + ",".join(f"{c}:double" for c in _SCORES) + ">>"
)


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def _number(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def _flag(value: Column, default: bool = False) -> Column:
    return F.coalesce(value, F.lit(default))


def _label_json(*parts: str) -> Column:
    """The payloads that a tile has, as JSON text."""
    names = {"semantic": "semantic", "damage": "damage_review"}
    return F.to_json(F.struct(*(F.col(p).alias(names[p]) for p in parts))).alias("label_json")


def label_metadata(tiles: DataFrame) -> DataFrame:
    """The 16 columns of the label sidecar. ``tiles`` has tile_id, shard, key, bucket and a nullable struct ``semantic``."""
    s = F.col("semantic").cast(SEMANTIC)
    return tiles.select(
        "tile_id", "shard", "key", F.coalesce(s["bucket"], _text(F.col("bucket"))).alias("label"), _text(F.col("bucket")).alias("bucket"), _text(s["dominant"]).alias("dominant"), _text(s["confidence"]).alias("confidence"),
        _number(s["confidence_score"]).alias("confidence_score"), _text(s["top_class"]).alias("top_class"), _number(s["top_score"]).alias("top_score"), _text(s["second_class"]).alias("second_class"),
        _number(s["second_score"]).alias("second_score"), _number(s["margin"]).alias("margin"), _text(s["top_detailed_class"]).alias("top_detailed_class"), _flag(s["detail_agrees"]).alias("detail_agrees"), _label_json("semantic"),
    )


def review_rows(tiles: DataFrame) -> DataFrame:
    """The 14 columns of the review sidecar, from the semantic payload."""
    s = F.col("semantic").cast(SEMANTIC)
    return tiles.select(
        "tile_id", "shard", "key", _text(F.coalesce(s["dominant"], s["top_class"])).alias("suggested_label"), F.lit(REVIEW).alias("bucket"), F.coalesce(s["confidence"], F.lit("review")).alias("confidence"),
        _number(s["confidence_score"]).alias("confidence_score"), _text(s["top_class"]).alias("top_class"), _number(s["top_score"]).alias("top_score"), _text(s["second_class"]).alias("second_class"),
        _number(s["second_score"]).alias("second_score"), _number(s["margin"]).alias("margin"), _text(F.array_join(s["reasons"], "|")).alias("review_reasons"), _label_json("semantic"),
    )


def review_rows_from_damage(tiles: DataFrame) -> DataFrame:
    """The same 14 columns from the damage payload."""
    d = F.col("damage").cast(DAMAGE)
    return tiles.select(
        "tile_id", "shard", "key", _text(d["dominant"]).alias("suggested_label"), F.coalesce(d["bucket"], F.lit(REVIEW)).alias("bucket"), F.coalesce(d["route_source"], F.lit("damage_review")).alias("confidence"),
        _number(d["damage_likelihood"]).alias("confidence_score"), _text(d["semantic_top_class"]).alias("top_class"), _number(d["semantic_top_score"]).alias("top_score"), _text(d["semantic_second_class"]).alias("second_class"),
        _number(d["semantic_second_score"]).alias("second_score"), _number(d["semantic_margin"]).alias("margin"), _text(d["review_reason"]).alias("review_reasons"), _label_json("damage"),
    )


def damage_routes(tiles: DataFrame) -> DataFrame:
    """The 19 columns of the damage route sidecar. ``tiles`` has tile_id, shard, key, bucket and a nullable struct ``damage``."""
    d = F.col("damage").cast(DAMAGE)
    return tiles.select(
        "tile_id", "shard", "key", F.coalesce(d["bucket"], _text(F.col("bucket"))).alias("bucket"), _text(d["dominant"]).alias("dominant"), F.initcap(_text(d["damage_label"])).alias("damage_label"),
        _number(d["damage_likelihood"]).alias("damage_likelihood"), _text(d["route_source"]).alias("route_source"), _flag(d["inside_damage_area"]).alias("inside_damage_area"), _flag(d["intersects_damage_area"]).alias("intersects_damage_area"),
        _text(d["distance_to_damage_line"]).alias("distance_to_damage_line"), _flag(d["review_required"], True).alias("review_required"), _text(d["review_reason"]).alias("review_reason"),
        _text(d["semantic_top_class"]).alias("semantic_top_class"), _text(d["semantic_confidence"]).alias("semantic_confidence"), _number(d["semantic_top_score"]).alias("semantic_top_score"),
        _text(d["semantic_second_class"]).alias("semantic_second_class"), _number(d["semantic_margin"]).alias("semantic_margin"), _label_json("damage"),
    )


def label_json_rows(tiles: DataFrame) -> DataFrame:
    """The 34 columns of the label table: routing, geometry and scores of the damage payload, in order."""
    d = F.col("damage").cast(DAMAGE)

    def texts(*names: str) -> list[Column]:
        return [_text(d[n]).alias(n) for n in names]

    return tiles.select(
        "tile_id", "shard", "key", F.coalesce(d["bucket"], _text(F.col("bucket"))).alias("bucket"), _text(d["dominant"]).alias("dominant"), _number(d["damage_likelihood"]).alias("damage_likelihood"),
        F.initcap(_text(d["damage_label"])).alias("damage_label"), _text(d["route_source"]).alias("route_source"), _flag(d["review_required"], True).alias("review_required"), _text(d["review_reason"]).alias("review_reason"),
        *(_flag(d[n]).alias(n) for n in ("has_master_damage_geometry", "intersects_damage_area", "tile_center_inside_damage_area")),
        *texts("distance_to_damage_centerline", "distance_to_damage_area", "nearest_damage_line_id", "nearest_damage_area_id", "metamosaic_id", "master_gpkg_path", "damage_line_layer", "damage_area_layer", "mosaic_crs"),
        _flag(d["geometry_clipped_to_mosaic_context"]).alias("geometry_clipped_to_mosaic_context"), *(_number(d["score"][n]).alias(n) for n in _SCORES),
        *texts("router_version", "geometry_context_distance", "sigma_centerline", "sigma_area"),
    )


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``nth`` from 0 of each row in its group.

    Rows are dealt out by ranges of (group, order) and numbered in each range; what
    earlier ranges of a group hold is added, so a group of any size is no single task.
    """
    dealt = rows.repartitionByRange(*(F.col(c) for c in (group, *order))).withColumn("__range", F.spark_partition_id())
    dealt = written(dealt, "ranges")
    each = Window.partitionBy("__range", group).orderBy(*order)
    counts = dealt.groupBy("__range", group).agg(F.count("*").alias("__n"))
    before = Window.partitionBy(group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("__range", F.col(group).alias("__group"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))  # a row per group and range
    local = dealt.withColumn("nth", F.row_number().over(each) - 1)
    same = (local["__range"] == counts["__range"]) & local[group].eqNullSafe(counts["__group"])
    return local.join(counts, same).withColumn("nth", F.col("nth") + F.col("__before")).select(*rows.columns, "nth")


def route(rows: DataFrame, bucket: str, order: list[str], shard_size: int) -> DataFrame:
    """Sanitized bucket and the shard inside it."""
    safe = numbered(rows.withColumn("route", safe_bucket(F.col(bucket))), "route", order)
    return safe.withColumn("shard_index", (F.floor(F.col("nth") / shard_size) + 1).cast("int")).drop("nth")


def split_on(rows: DataFrame, bucket: str, name: str) -> DataFrame:
    """Two routes, ``X`` and ``notX``."""
    return rows.withColumn("route", F.when(F.col(bucket) == name, name).otherwise(f"not{name}"))

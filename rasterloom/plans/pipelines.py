"""Whole jobs: from files to a catalogue, from a catalogue to groups, bundles and plans."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.functions import text
from rasterloom.operators import bundles, location, spatial, tiling
from rasterloom.operators.components import connected_components
from rasterloom.session import written


def manifest_of(files: DataFrame) -> DataFrame:
    """Manifest rows of ``path`` rows: identity from file names alone.

    Equal names in different folders get equal ids; ``duplicates`` counts them.
    """
    path = F.col("path")
    rows = files.select("path", text.short_hash(text.file_name(path)).alias("alias"), text.acquisition_date(path).alias("date"), text.variant(path).alias("v"))
    rows = rows.select("alias", F.concat(F.lit("M"), "date", "v.variant_id", "alias").alias("mosaic_id"), text.as_uri(path).alias("source_uri"), "path", "date", "v.*")
    return rows.withColumns({"id_scheme": F.lit("blake2b-name"), "id_version": F.lit("1")})


def duplicates(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("mosaic_id").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("path")).alias("paths")).where("n > 1")


@dataclass
class Grouping:
    members: DataFrame
    intersections: DataFrame
    summary: DataFrame
    bundles: DataFrame
    manifest: DataFrame
    branches: DataFrame


def group_rasters(manifest: DataFrame, metadata: DataFrame, threshold: float = bundles.DEFAULT_COVERAGE, stem: str = "auto", cell: float = 2.5, resolver: location.LocationResolver | None = None) -> Grouping:
    """Overlap groups and canonical bundles, the groups' summary with where they lie, a branch per bundle.

    ``metadata`` has mosaic_id, a box, width, height, bands, dtype. Rasters
    without metadata stay in the manifest with blank assignments.
    """
    rows = metadata.join(manifest.select("mosaic_id", "path", "variant_id", F.when(F.col("date") != "nulldate", F.col("date")).otherwise("").alias("event_date")), "mosaic_id")
    rows = written(rows, "georows")
    pairs = written(spatial.overlap_pairs(rows, "mosaic_id", cell), "pairs")
    roots = connected_components(pairs, "a", "b").select(F.col("node").alias("mosaic_id"), "root")
    members = rows.join(roots, "mosaic_id", "left").withColumn("root", F.coalesce("root", "mosaic_id"))
    groups = location.group_summary(members, "root", resolver).withColumn("metamosaic_alias", text.short_hash(F.replace("members", F.lit(";"), F.lit("|"))))
    named = F.col("hint_location_name")
    name = F.lit(stem) if stem.lower() not in ("locale", "unknown", "auto") else F.when(named != "", named).otherwise("unknown")
    groups = groups.withColumn("metamosaic_id", F.concat(F.lit("MM_"), F.upper(text.slug(name)), F.lit("_"), "metamosaic_alias"))
    groups = written(groups, "groups")
    members = members.join(groups.select("root", "metamosaic_id", "metamosaic_alias"), "root").withColumn("group_id", F.col("metamosaic_id"))
    members = written(members, "members")
    found = written(bundles.greedy_bundles(members, threshold), "bundles")
    ids = found.select("group_id", "bundle_no", "canonical_mosaic_id").distinct()
    ids = ids.withColumn("bundle_id", bundles.bundle_id(F.col("group_id"), F.col("canonical_mosaic_id")))
    found = found.join(ids, ["group_id", "bundle_no", "canonical_mosaic_id"])
    assigned = members.select("mosaic_id", "metamosaic_id", "metamosaic_alias").join(found.select("mosaic_id", "bundle_id", "canonical_mosaic_id"), "mosaic_id")
    enriched = manifest.join(assigned, "mosaic_id", "left")
    enriched = enriched.withColumns({c: F.coalesce(c, F.lit("")) for c in ("metamosaic_id", "metamosaic_alias", "bundle_id", "canonical_mosaic_id")})
    crossing = pairs.join(members.select(F.col("mosaic_id").alias("a"), "metamosaic_id"), "a").select(F.col("a").alias("mosaic_a"), F.col("b").alias("mosaic_b"), "metamosaic_id")
    summary = groups.drop("root").orderBy("metamosaic_id")
    return Grouping(members, crossing, summary, found, enriched, bundles.branches(members, found))


def plan_tiles(grouping: Grouping, tile: int = 512, stride: int = 512) -> DataFrame:
    """The tile plan of every bundle's canonical raster."""
    of = grouping.bundles.select("mosaic_id", "bundle_id", "canonical_mosaic_id")
    return tiling.canonical_plan(grouping.members.select("mosaic_id", "width", "height"), of, tile, stride)


@dataclass
class Step:
    name: str
    run: Callable[[], object]
    required: bool = True


def run_steps(steps: list[Step]) -> tuple[int, list[tuple[str, str]]]:
    """(exit code, status of each step); stops at the first required step that fails."""
    done, code = [], 0
    for step in steps:
        try:
            step.run()
            done.append((step.name, "ok"))
        except Exception as failed:  # a step's failure is its result
            done.append((step.name, f"{type(failed).__name__}: {failed}"))
            code = 1
            if step.required:
                break
    return code, done

"""Where groups of rasters lie: resolvers of a box, hints from folders, the group summary."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.functions import text
from rasterloom.operators.spatial import BOX

LOCATION = ("name", "state", "county", "kind", "source", "distance_m", "confidence", "lon", "lat")
HINT = ("event_date", "location_name", "state", "suffix", "source")


class LocationResolver(Protocol):
    """Anything that tells a place from a box and a folder's hint, as a struct of the LOCATION fields."""

    def resolve(self, box: tuple[Column, Column, Column, Column], hint: Column) -> Column: ...


def _record(box: tuple[Column, Column, Column, Column], name: Column, state: Column, kind: Column, source: Column, confidence: Column) -> Column:
    lon, lat = (box[0] + box[2]) / 2, (box[1] + box[3]) / 2
    values = (name, state, F.lit(""), kind, source, F.lit(None).cast("double"), confidence, lon, lat)
    return F.struct(*(v.alias(c) for v, c in zip(values, LOCATION, strict=True)))


class NullResolver:
    """Does not guess: the box's centre for a later lookup."""

    def resolve(self, box: tuple[Column, Column, Column, Column], hint: Column) -> Column:
        return _record(box, F.lit(""), F.lit(""), F.lit("unknown"), F.lit("bbox_center_unresolved"), F.lit(0.0))


class HintResolver:
    """The folder's hint with a confidence of one half, the centre where there is none."""

    def resolve(self, box: tuple[Column, Column, Column, Column], hint: Column) -> Column:
        known = F.coalesce(hint["name"] != "", F.lit(False))
        pick = F.when(known, hint["name"]).otherwise(""), F.when(known, hint["state"]).otherwise("")
        return _record(box, *pick, F.when(known, "folder_hint").otherwise("unknown"), F.when(known, hint["source"]).otherwise("bbox_center_unresolved"), F.when(known, 0.5).otherwise(0.0))


def group_summary(members: DataFrame, group: str, resolver: LocationResolver | None = None, order: str = "path") -> DataFrame:
    """A row per group, ordered by it: ``n_mosaics``, sorted ``members``, box, ``location_*``, ``hint_*``, ``location_warning``, ``display_name``.

    ``members`` has mosaic_id, path and a box. The hint is the most frequent one of
    the members' folders; of equally frequent ones that seen first in ``order``.
    """
    hinted = members.withColumn("hint", text.location_hint(F.col("path")))
    counts = hinted.where("hint.source <> ''").groupBy(group, F.col("hint.name").alias("n"), F.col("hint.state").alias("s")).agg(F.count("*").alias("times"), F.min(F.struct(F.col(order).alias("first"), F.col("hint"))).alias("seen"))
    ranked = counts.groupBy(group).agg(F.max("times").alias("times")).join(counts, [group, "times"])
    best = ranked.groupBy(group).agg(F.min("seen").alias("seen")).select(group, F.col("seen.hint").alias("hint"))
    ends = (F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"))
    rows = members.groupBy(group).agg(F.count("*").alias("n_mosaics"), F.array_join(F.array_sort(F.collect_list("mosaic_id")), ";").alias("members"), *ends).join(best, group, "left")
    place = (resolver or NullResolver()).resolve(tuple(F.col(c) for c in BOX), F.col("hint"))
    rows = rows.withColumn("place", place)
    hint = {c: F.coalesce(F.col(f"hint.{'name' if c == 'location_name' else c}"), F.lit("")) for c in HINT}
    shown = F.when(text.display_name(F.col("place.name"), F.col("place.county"), F.col("place.state")) != "unknown", text.display_name(F.col("place.name"), F.col("place.county"), F.col("place.state")))
    guess = F.when(hint["location_name"] != "", text.display_name(hint["location_name"], F.lit(""), hint["state"])).otherwise("unknown")
    return rows.select(
        group, "n_mosaics", "members", *BOX, *(F.col(f"place.{c}").alias(f"location_{c}") for c in LOCATION), *(v.alias(f"hint_{c}") for c, v in hint.items()),
        text.location_warning(hint["location_name"], hint["state"], F.col("place.name"), F.col("place.state")).alias("location_warning"), F.coalesce(shown, guess).alias("display_name"),
    ).orderBy(group)

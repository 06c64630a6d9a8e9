"""Canonical rasters and bundles inside a group of overlapping rasters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rasterloom.functions import geometry
from rasterloom.functions.text import VARIANT_PRIORITY, short_hash
from rasterloom.operators.labels import numbered
from rasterloom.operators.spatial import BOX, overlap_pairs
from rasterloom.session import discard, written

EIGHT_BIT = ("byte", "uint8", "int8")
DEFAULT_COVERAGE = 0.97
#: Larger groups are bundled over their links, in rounds; smaller ones are a unit of work each.
GROUP_ROWS = 10_000


def variant_priority(variant: Column) -> Column:
    value = F.lit(0)
    for name, worth in VARIANT_PRIORITY.items():
        value = F.when(F.upper(F.trim(variant)) == name, worth).otherwise(value)
    return value


def canonical_score() -> Column:
    """What ranks a raster: area, pixels, full-range type, variant, bands, then its id."""
    return F.struct(
        geometry.area(*(F.col(c) for c in BOX)).alias("area"),
        (F.col("width") * F.col("height")).alias("pixels"),
        (~F.lower(F.trim("dtype")).isin(*EIGHT_BIT)).cast("int").alias("full_range"),
        variant_priority(F.col("variant_id")).alias("priority"),
        F.col("bands").alias("bands"),
        F.col("mosaic_id").alias("mosaic_id"),
    )


def canonical_rank(members: DataFrame) -> DataFrame:
    """``group_id, mosaic_id, canonical_rank``, 1 for the best."""
    order = Window.partitionBy("group_id").orderBy(canonical_score().desc())
    return members.select("group_id", "mosaic_id", F.row_number().over(order).alias("canonical_rank"))


def canonical(members: DataFrame) -> DataFrame:
    """``group_id, canonical_mosaic_id`` by one aggregation."""
    best = members.groupBy("group_id").agg(F.max(canonical_score()).alias("best"))
    return best.select("group_id", F.col("best.mosaic_id").alias("canonical_mosaic_id"))


def compatible_dates(a: Column, b: Column) -> Column:
    """Equal where both are given."""
    return (F.coalesce(a, F.lit("")) == "") | (F.coalesce(b, F.lit("")) == "") | (a == b)


def greedy_bundles(members: DataFrame, threshold: float = DEFAULT_COVERAGE, cell: float = 2.5, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``group_id, mosaic_id, bundle_no, canonical_mosaic_id, similarity``.

    In the order of the canonical score the first free raster anchors a bundle
    and takes every free one with a compatible date and a coverage of at least
    ``threshold``. The order matters, so a group of up to ``group_rows`` rasters
    is one unit of work; larger ones are bundled over their links. ``members``
    is read more than once, so it should be a written table. Without a positive
    threshold disjoint rasters attach too, so that every group is one unit.
    """
    if threshold <= 0:
        return _by_group(members, threshold)
    sizes = members.groupBy("group_id").agg(F.count("*").alias("n"))
    large = written(sizes.where(F.col("n") > group_rows).select("group_id"), "large-groups")
    if large.isEmpty():
        return _by_group(members, threshold)
    apart = _by_links(members.join(large, "group_id", "left_semi"), threshold, cell)
    return _by_group(members.join(large, "group_id", "left_anti"), threshold).unionByName(apart)


def _by_links(members: DataFrame, threshold: float, cell: float) -> DataFrame:
    """The same bundles from the pairs of rasters that may share one.

    A raster is an anchor unless an anchor before it links to it, and goes to the
    first one that does. In each round those that nothing before them can take
    any more are anchors, and what they link to is taken; rounds grow with the
    longest chain of such dependencies.
    """
    rows = members.select(F.col("group_id").cast("string").alias("group_id"), "mosaic_id", *BOX, F.coalesce("event_date", F.lit("")).alias("event_date"), canonical_score().alias("score"))
    rows = written(rows, "scored")
    sides = [rows.select(F.col("mosaic_id").alias(s), F.struct("group_id", "event_date", "score", *BOX).alias(f"of_{s}")) for s in "ab"]
    pairs = overlap_pairs(rows, "mosaic_id", cell).join(sides[0], "a").join(sides[1], "b").where("of_a.group_id = of_b.group_id")
    similarity = geometry.coverage(*(tuple(F.col(f"of_{s}.{c}") for c in BOX) for s in "ab"))
    first = F.col("of_a.score") > F.col("of_b.score")
    links = pairs.where(compatible_dates(F.col("of_a.event_date"), F.col("of_b.event_date"))).withColumn("similarity", similarity).where(F.col("similarity") >= threshold)
    links = written(links.select(F.when(first, F.col("of_a.score")).otherwise(F.col("of_b.score")).alias("score"), F.when(first, F.col("a")).otherwise(F.col("b")).alias("first"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("later"), "similarity"), "links")
    taken, left = links.select("later").limit(0), links.select("first", "later")
    while not left.isEmpty():
        waiting = left.select(F.col("later").alias("first")).distinct()
        now = written(left.join(waiting, "first", "left_anti").select("later").distinct(), "taken")
        rest = written(left.join(now, "later", "left_anti").join(now.withColumnRenamed("later", "first"), "first", "left_anti"), "left")
        after = written(taken.unionByName(now), "taken")
        for done in (left, taken, now):
            discard(done)
        left, taken = rest, after
    best = links.join(taken.withColumnRenamed("later", "first"), "first", "left_anti").groupBy("later").agg(F.max(F.struct("score", "first", "similarity")).alias("anchor"))
    anchors = rows.join(taken.withColumnRenamed("later", "mosaic_id"), "mosaic_id", "left_anti").select("group_id", "mosaic_id", "score")
    anchors = written(numbered(anchors, "group_id", ["score"]), "anchors")  # from the last one up
    anchors = anchors.join(anchors.groupBy("group_id").agg(F.count("*").alias("n")), "group_id")
    anchors = anchors.select("group_id", F.col("mosaic_id").alias("canonical_mosaic_id"), (F.col("n") - F.col("nth")).cast("int").alias("bundle_no"))
    own = anchors.select("group_id", F.col("canonical_mosaic_id").alias("mosaic_id"), "bundle_no", "canonical_mosaic_id", F.lit(1.0).alias("similarity"))
    attached = best.select(F.col("later").alias("mosaic_id"), F.col("anchor.first").alias("canonical_mosaic_id"), F.col("anchor.similarity").alias("similarity"))
    return own.unionByName(attached.join(anchors, "canonical_mosaic_id").select(*own.columns))


def _by_group(members: DataFrame, threshold: float) -> DataFrame:
    """Group by group, in the order of the canonical score."""
    order = Window.partitionBy("group_id").orderBy(canonical_score().desc())
    keyed = members.withColumn("group_id", F.col("group_id").cast("string"))
    # The window leaves each group's rows together and in order, so no further shuffle is needed.
    slim = keyed.select("group_id", "mosaic_id", *BOX, F.coalesce("event_date", F.lit("")).alias("event_date"), F.row_number().over(order).alias("nth"))

    def cluster(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], schema=_BUNDLES)

    def _groups(batches: Iterator[pa.RecordBatch], size: int = 4096) -> Iterator[list[tuple]]:
        held: list[dict] = []
        out: list[tuple] = []
        for row in (r for b in batches for r in b.to_pylist()):
            if held and (row["nth"] == 1 or row["group_id"] != held[0]["group_id"]):
                out += attach(held, threshold)
                held = []
                if len(out) >= size:
                    yield out
                    out = []
            held.append(row)
        out += attach(held, threshold)
        if out:
            yield out

    schema = "group_id string, mosaic_id string, bundle_no int, canonical_mosaic_id string, similarity double"
    return slim.mapInArrow(cluster, schema)


_BUNDLES = pa.schema([("group_id", pa.string()), ("mosaic_id", pa.string()), ("bundle_no", pa.int32()), ("canonical_mosaic_id", pa.string()), ("similarity", pa.float64())])


def attach(rows: list[dict], threshold: float) -> list[tuple[str, str, int, str, float]]:
    """The bundles of one group, whose rows come in the order of the canonical score."""
    box = np.array([[r[c] for c in BOX] for r in rows], float).reshape(-1, 4)
    dates = np.array([r["event_date"] for r in rows], str)
    sizes = (box[:, 2] - box[:, 0]).clip(0) * (box[:, 3] - box[:, 1]).clip(0)
    free, out, number = np.arange(len(rows)), [], 0
    while len(free):
        anchor, rest, number = free[0], free[1:], number + 1
        name = (rows[anchor]["group_id"], rows[anchor]["mosaic_id"])
        out.append((name[0], name[1], number, name[1], 1.0))
        w = (box[rest, 2].clip(max=box[anchor, 2]) - box[rest, 0].clip(min=box[anchor, 0])).clip(0)
        h = (box[rest, 3].clip(max=box[anchor, 3]) - box[rest, 1].clip(min=box[anchor, 1])).clip(0)
        least = sizes[rest].clip(max=sizes[anchor])
        cover = (w * h / least.clip(1e-300)).clip(0, 1) * (least > 0)
        same = (dates[rest] == "") | (dates[anchor] == "") | (dates[rest] == dates[anchor])
        take = same & (cover >= threshold)
        out += [(name[0], rows[m]["mosaic_id"], number, name[1], float(c)) for m, c in zip(rest[take], cover[take], strict=True)]
        free = rest[~take]
    return out


def bundle_summary(members: DataFrame) -> DataFrame:
    """Per ``group_id``: canonical raster, members, least coverage by it, common date, union box."""
    best = canonical(members)
    anchor = members.select(F.col("group_id"), F.col("mosaic_id").alias("anchor_id"), *(F.col(c).alias(f"a_{c}") for c in BOX))
    anchor = anchor.join(best, (anchor["group_id"] == best["group_id"]) & (anchor["anchor_id"] == best["canonical_mosaic_id"])).select(anchor["group_id"], "canonical_mosaic_id", *(f"a_{c}" for c in BOX))
    cover = geometry.coverage(tuple(F.col(c) for c in BOX), tuple(F.col(f"a_{c}") for c in BOX))
    dates = F.collect_set(F.when(F.col("event_date") != "", F.col("event_date")))
    return (
        members.join(anchor, "group_id")
        .groupBy("group_id", "canonical_mosaic_id")
        .agg(
            F.count("*").alias("n_mosaics"),
            F.round(F.min(cover), 9).alias("min_canonical_similarity"),
            F.when(F.size(dates) == 1, F.get(dates, F.lit(0))).otherwise("nodate").alias("date"),
            F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"),
        )
    )


# The columns of the branches table.
BRANCHES = ["metamosaic_id", "bundle_id", "date", "canonical_mosaic_id", "n_mosaics", "min_canonical_similarity", "members", *BOX]


def branches(members: DataFrame, found: DataFrame) -> DataFrame:
    """A row per bundle of ``greedy_bundles``, ordered by group and bundle: its canonical raster, which is
    the best of its members, their number and sorted ids, the least coverage by it, their common date and box.

    ``members`` is what the bundles were found in, ``group_id`` the metamosaic.
    """
    rows = found.select(F.col("group_id").alias("g"), F.col("mosaic_id").alias("m"), "bundle_no").join(members.withColumn("g", F.col("group_id").cast("string")).withColumn("m", F.col("mosaic_id")), ["g", "m"])
    key = ["g", "bundle_no"]
    best = rows.groupBy(*key).agg(F.max(F.struct(canonical_score().alias("s"), *(F.col(c).alias(f"c_{c}") for c in BOX))).alias("c"))
    rows = rows.join(best, key)
    cover = geometry.coverage(tuple(F.col(f"c.c_{c}") for c in BOX), tuple(F.col(c) for c in BOX))
    dates = F.array_sort(F.collect_set(F.when(F.col("event_date") != "", F.col("event_date"))))
    ends = (F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"))
    out = rows.groupBy(*key, F.col("c.s.mosaic_id").alias("canonical_mosaic_id")).agg(
        F.count("*").alias("n_mosaics"), F.min(cover).alias("min_canonical_similarity"), F.array_join(F.array_sort(F.collect_list("m")), ";").alias("members"),
        F.when(F.size(dates) == 1, F.get(dates, F.lit(0))).otherwise("nodate").alias("date"), *ends,
    )
    out = out.withColumnRenamed("g", "metamosaic_id").withColumn("bundle_id", bundle_id(F.col("metamosaic_id"), F.col("canonical_mosaic_id")))
    return out.select(*BRANCHES).orderBy("metamosaic_id", "bundle_id")


def bundle_id(group: Column, canonical_mosaic_id: Column) -> Column:
    return F.concat(F.lit("B"), short_hash(F.concat_ws("|", group, canonical_mosaic_id), 8))

"""Queries on boxes, overlaps, components and bundles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.functions import geometry
from rasterloom.operators import bundles, location, spatial
from rasterloom.operators.components import connected_components
from rasterloom.plans.fixtures import view, with_views
from rasterloom.plans.registry import Registry
from rasterloom.session import written

REGISTRY = Registry()
query = REGISTRY.query
CELL = 2.5

_M = with_views("mosaics")
_PAIRS = """, pairs AS (SELECT a.mosaic_key AS a, b.mosaic_key AS b FROM mosaics a JOIN mosaics b
  ON a.mosaic_key < b.mosaic_key AND a.minx <= b.maxx AND b.minx <= a.maxx AND a.miny <= b.maxy AND b.miny <= a.maxy)"""
_LABELS = _PAIRS + """, edge AS (SELECT a AS u, b AS v FROM pairs UNION SELECT b, a FROM pairs),
  reach AS (SELECT mosaic_key AS node, mosaic_key AS r FROM mosaics UNION SELECT e.v, reach.r FROM reach JOIN edge e ON e.u = reach.node),
  labels AS (SELECT node AS mosaic_key, min(r) AS group_key FROM reach GROUP BY node)"""
_GROUPED = _M.replace("WITH ", "WITH RECURSIVE ", 1) + _LABELS + ", members AS (SELECT * FROM mosaics JOIN labels USING (mosaic_key))"
_AREA = "greatest(maxx - minx, 0) * greatest(maxy - miny, 0)"
_PRIORITY = "CASE variant_id WHEN 'RGB' THEN 100 WHEN 'NIR' THEN 85 WHEN 'NLL' THEN 70 WHEN 'ERIK2' THEN 49 WHEN 'NDVI' THEN 40 WHEN 'DSM' THEN 20 ELSE 0 END"
_RANK = f"row_number() OVER (PARTITION BY group_key ORDER BY {_AREA} DESC, width * height DESC, CASE WHEN dtype = 'uint8' THEN 0 ELSE 1 END DESC, {_PRIORITY} DESC, bands DESC, mosaic_id DESC)"


def _columns(prefix: str = "") -> tuple:
    return tuple(F.col(f"{prefix}{c}") for c in spatial.BOX)


@query("q_bbox_props", _M + " SELECT mosaic_key, round(greatest(maxx - minx, 0), 6) AS width_deg, round(greatest(maxy - miny, 0), 6) AS height_deg, round(greatest(maxx - minx, 0) * greatest(maxy - miny, 0), 6) AS area, round((minx + maxx) / 2, 6) AS lon, round((miny + maxy) / 2, 6) AS lat FROM mosaics")
def q_bbox_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    minx, miny, maxx, maxy = _columns()
    return view(spark, sf_dir, "mosaics").select(
        "mosaic_key", F.round(geometry.width(minx, maxx), 6).alias("width_deg"), F.round(geometry.width(miny, maxy), 6).alias("height_deg"),
        F.round(geometry.area(minx, miny, maxx, maxy), 6).alias("area"), F.round((minx + maxx) / 2, 6).alias("lon"), F.round((miny + maxy) / 2, 6).alias("lat"),
    )


@query("q_point_in_box", with_views("mosaics", "areas") + " SELECT mosaic_key, (minx + maxx) / 2 BETWEEN -90 AND 90 AND (miny + maxy) / 2 BETWEEN -45 AND 45 AS inside FROM mosaics")
def q_point_in_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    minx, miny, maxx, maxy = _columns()
    return view(spark, sf_dir, "mosaics").select("mosaic_key", geometry.point_in_box((minx + maxx) / 2, (miny + maxy) / 2, (-90, -45, 90, 45)).alias("inside"))


@query("q_haversine", _M + """, h AS (SELECT mosaic_key, pow(sin(radians(maxy - miny) / 2), 2) + cos(radians(miny)) * cos(radians(maxy)) * pow(sin(radians(maxx - minx) / 2), 2) AS h FROM mosaics)
  SELECT mosaic_key, round(2 * 6371000 * atan2(sqrt(h), sqrt(1 - h)), 3) AS diagonal_m FROM h""")
def q_haversine(spark: SparkSession, sf_dir: str) -> DataFrame:
    minx, miny, maxx, maxy = _columns()
    return view(spark, sf_dir, "mosaics").select("mosaic_key", F.round(geometry.haversine_m(minx, miny, maxx, maxy), 3).alias("diagonal_m"))


@query("q_footprint_wkt", _M + """ SELECT mosaic_key, format('SRID=4326;POLYGON(({:.8f} {:.8f}, {:.8f} {:.8f}, {:.8f} {:.8f}, {:.8f} {:.8f}, {:.8f} {:.8f}))', minx, miny, maxx, miny, maxx, maxy, minx, maxy, minx, miny) AS footprint FROM mosaics""")
def q_footprint_wkt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "mosaics").select("mosaic_key", geometry.footprint_ewkt(*_columns()).alias("footprint"))


@query("q_reproject", _M + """, p AS (SELECT mosaic_key, minx, miny, radians(minx) * 6378137 AS x, ln(tan(radians(miny) / 2 + pi() / 4)) * 6378137 AS y FROM mosaics WHERE abs(miny) < 85)
  SELECT mosaic_key, round(x, 3) AS x, round(y, 3) AS y, round(degrees(x / 6378137), 6) AS lon, round(degrees(2 * atan(exp(y / 6378137)) - pi() / 2), 6) AS lat FROM p""")
def q_reproject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web Mercator and back, inside its bounds."""
    rows = view(spark, sf_dir, "mosaics").where("abs(miny) < 85")
    x, y = geometry.web_mercator(F.col("minx"), F.col("miny"))
    rows = rows.select("mosaic_key", x.alias("x"), y.alias("y"))
    lon, lat = geometry.from_web_mercator(F.col("x"), F.col("y"))
    return rows.select("mosaic_key", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.overlap_pairs(view(spark, sf_dir, "mosaics"), "mosaic_key", CELL)


@query("q_overlap_pairs", _M + _PAIRS + " SELECT a, b FROM pairs")
def q_overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir)


@query("q_coverage_similarity", _M + _PAIRS + """ SELECT p.a, p.b, round(CASE WHEN s > 0 THEN least(i / s, 1.0::double) ELSE 0 END, 6) AS similarity FROM (SELECT p.a, p.b,
  greatest(least(x.maxx, y.maxx) - greatest(x.minx, y.minx), 0) * greatest(least(x.maxy, y.maxy) - greatest(x.miny, y.miny), 0) AS i,
  least(greatest(x.maxx - x.minx, 0) * greatest(x.maxy - x.miny, 0), greatest(y.maxx - y.minx, 0) * greatest(y.maxy - y.miny, 0)) AS s
  FROM pairs p JOIN mosaics x ON x.mosaic_key = p.a JOIN mosaics y ON y.mosaic_key = p.b) p""")
def q_coverage_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = view(spark, sf_dir, "mosaics")
    left = boxes.select(F.col("mosaic_key").alias("a"), *(F.col(c).alias(f"a_{c}") for c in spatial.BOX))
    right = boxes.select(F.col("mosaic_key").alias("b"), *(F.col(c).alias(f"b_{c}") for c in spatial.BOX))
    rows = pairs(spark, sf_dir).join(left, "a").join(right, "b")
    return rows.select("a", "b", F.round(geometry.coverage(_columns("a_"), _columns("b_")), 6).alias("similarity"))


def grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rasters with the least key of their overlap component; singletons are groups of their own."""
    found = connected_components(pairs(spark, sf_dir), "a", "b").select(F.col("node").alias("mosaic_key"), F.col("root").alias("root"))
    rows = view(spark, sf_dir, "mosaics").join(found, "mosaic_key", "left")
    return rows.withColumn("group_key", F.coalesce("root", "mosaic_key")).drop("root")


@query("q_components", _GROUPED + " SELECT mosaic_key, group_key FROM labels")
def q_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(spark, sf_dir).select("mosaic_key", "group_key")


@query("q_union_bbox", _GROUPED + " SELECT group_key, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM members GROUP BY 1")
def q_union_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = [F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy")]
    return grouped(spark, sf_dir).groupBy("group_key").agg(*ends)


@query("q_metamosaic_summary", _GROUPED + " SELECT group_key, count(*) AS n_mosaics, string_agg(mosaic_id, ';' ORDER BY mosaic_id) AS members FROM members GROUP BY 1")
def q_metamosaic_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(spark, sf_dir).groupBy("group_key").agg(F.count("*").alias("n_mosaics"), F.array_join(F.sort_array(F.collect_list("mosaic_id")), ";").alias("members"))


def _members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped(spark, sf_dir).withColumnRenamed("group_key", "group_id")


@query("q_canonical_rank", _GROUPED + f" SELECT group_key AS group_id, mosaic_id, {_RANK}::integer AS canonical_rank FROM members")
def q_canonical_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundles.canonical_rank(_members(spark, sf_dir))


#: Walks each group in the order of the ranks and carries its anchors along as a list.
_COVER = """greatest(least(r.maxx, a.maxx) - greatest(r.minx, a.minx), 0) * greatest(least(r.maxy, a.maxy) - greatest(r.miny, a.miny), 0)
      / least((r.maxx - r.minx) * (r.maxy - r.miny), (a.maxx - a.minx) * (a.maxy - a.miny))"""
_ANCHOR = "{'nth': %s, 'id': r.mosaic_id, 'day': coalesce(r.event_date, ''), 'minx': r.minx, 'miny': r.miny, 'maxx': r.maxx, 'maxy': r.maxy}"
_CLUSTERS = _GROUPED + f""", ranked AS MATERIALIZED (SELECT *, {_RANK} AS n FROM members), walk AS (
    SELECT r.group_key, r.n, r.mosaic_id, [{_ANCHOR % "1::bigint"}] AS anchors, 1::bigint AS bundle_no, r.mosaic_id AS canonical_mosaic_id, 1.0::double AS similarity FROM ranked r WHERE n = 1
    UNION ALL
    SELECT group_key, n, mosaic_id, CASE WHEN hit IS NULL THEN list_append(anchors, own) ELSE anchors END, coalesce(hit.nth, own.nth), coalesce(hit.id, mosaic_id),
      coalesce(hit.cover, 1.0::double)
    FROM (SELECT r.group_key, r.n, r.mosaic_id, w.anchors, {_ANCHOR % "len(w.anchors) + 1"} AS own,
        list_filter(list_transform(w.anchors, lambda a: {{'nth': a.nth, 'id': a.id, 'same': a.day = '' OR coalesce(r.event_date, '') IN ('', a.day), 'cover': least({_COVER}, 1.0::double)}}),
          lambda a: a.same AND a.cover >= 0.97)[1] AS hit
      FROM walk w JOIN ranked r ON r.group_key = w.group_key AND r.n = w.n + 1)
  )
  SELECT group_key::varchar AS group_id, mosaic_id, bundle_no::integer AS bundle_no, canonical_mosaic_id, similarity FROM walk"""


@query("q_canonical_clusters", _CLUSTERS)
def q_canonical_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy bundles at the default coverage, 0.97."""
    return bundles.greedy_bundles(written(_members(spark, sf_dir), "members"))


@query("q_bundle_summary", _GROUPED + f""", ranked AS (SELECT *, {_RANK} AS n FROM members), c AS (SELECT * FROM ranked WHERE n = 1)
  SELECT m.group_key AS group_id, c.mosaic_id AS canonical_mosaic_id, count(*) AS n_mosaics,
    round(min(least(greatest(least(m.maxx, c.maxx) - greatest(m.minx, c.minx), 0) * greatest(least(m.maxy, c.maxy) - greatest(m.miny, c.miny), 0)
      / least((m.maxx - m.minx) * (m.maxy - m.miny), (c.maxx - c.minx) * (c.maxy - c.miny)), 1.0::double)), 9) AS min_canonical_similarity,
    CASE WHEN count(DISTINCT nullif(m.event_date, '')) = 1 THEN max(nullif(m.event_date, '')) ELSE 'nodate' END AS date,
    min(m.minx) AS minx, min(m.miny) AS miny, max(m.maxx) AS maxx, max(m.maxy) AS maxy FROM members m JOIN c USING (group_key) GROUP BY 1, 2""")
def q_bundle_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bundles.bundle_summary(written(_members(spark, sf_dir), "members"))


@query("q_canonical_self_join", _GROUPED + f""", ranked AS (SELECT *, {_RANK} AS n FROM members)
  SELECT m.mosaic_id, c.mosaic_id AS canonical_mosaic_id, c.width AS canonical_width, c.height AS canonical_height FROM members m JOIN ranked c ON c.group_key = m.group_key AND c.n = 1""")
def q_canonical_self_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = written(_members(spark, sf_dir), "members")
    best = bundles.canonical(members)
    sizes = members.select(F.col("mosaic_id").alias("canonical_mosaic_id"), F.col("width").alias("canonical_width"), F.col("height").alias("canonical_height"))
    return members.select("mosaic_id", "group_id").join(best, "group_id").join(sizes, "canonical_mosaic_id").select("mosaic_id", "canonical_mosaic_id", "canonical_width", "canonical_height")


@query("q_missing_canonical_anti", _M + " SELECT mosaic_id FROM mosaics WHERE mosaic_key * 2 NOT IN (SELECT mosaic_key FROM mosaics)")
def q_missing_canonical_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rasters whose canonical record (here: of twice their key) is missing."""
    rows = view(spark, sf_dir, "mosaics")
    wanted = rows.select("mosaic_id", (F.col("mosaic_key") * 2).alias("k"))
    return wanted.join(rows.select(F.col("mosaic_key").alias("k")), "k", "left_anti").select("mosaic_id")


@query("q_group_locations", _GROUPED + """ SELECT group_key, count(*) AS n_mosaics, string_agg(mosaic_id, ';' ORDER BY mosaic_id) AS members, round((min(minx) + max(maxx)) / 2, 6) AS location_lon, round((min(miny) + max(maxy)) / 2, 6) AS location_lat,
  'bbox_center_unresolved' AS location_source, 'Site' || (group_key % 50) AS hint_location_name, 'Site' || (group_key % 50) AS display_name FROM members GROUP BY 1""")
def q_group_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full group summary; all of a group lie in one folder here."""
    path = F.concat(F.lit("/drive/2025_01_02_Site"), (F.col("group_key") % 50).cast("string"), F.lit("/"), "mosaic_id")
    rows = location.group_summary(grouped(spark, sf_dir).withColumn("path", path), "group_key")
    return rows.select("group_key", "n_mosaics", "members", F.round("location_lon", 6).alias("location_lon"), F.round("location_lat", 6).alias("location_lat"), "location_source", "hint_location_name", "display_name")


@query("q_branches")
def q_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per greedy bundle at the default coverage."""
    members = written(_members(spark, sf_dir), "members")
    return bundles.branches(members, written(bundles.greedy_bundles(members), "bundles"))

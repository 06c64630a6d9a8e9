"""Queries on window plans and tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.operators import tiling
from rasterloom.plans.fixtures import view, with_views
from rasterloom.plans.registry import Registry
from rasterloom.session import table

REGISTRY = Registry()
query = REGISTRY.query
_M = with_views("mosaics")
_OUT = ["mosaic_id", "row_i", "col_i", "x", "y", "w", "h"]


def _plan_sql(tile: int, stride: int, drop: bool) -> str:
    last = f"- {tile} + 1" if drop else ""
    rows = f"SELECT *, unnest(range(0, greatest(height {last}, 0), {stride})) AS y FROM mosaics"
    return _M + f""", r AS ({rows}), plan AS (SELECT *, unnest(range(0, greatest(width {last}, 0), {stride})) AS x FROM r)
    SELECT mosaic_id, (y // {stride})::integer AS row_i, (x // {stride})::integer AS col_i, x, y, least({tile}, width - x) AS w, least({tile}, height - y) AS h FROM plan"""


def _plan(spark: SparkSession, sf_dir: str, tile: int, stride: int, drop: bool) -> DataFrame:
    return tiling.tile_plan(view(spark, sf_dir, "mosaics"), tile, stride, drop)


@query("q_tile_plan", _plan_sql(512, 512, True))
def q_tile_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir, 512, 512, True).select(*_OUT)


@query("q_tile_plan_partial", _plan_sql(512, 512, False))
def q_tile_plan_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir, 512, 512, False).select(*_OUT)


@query("q_tile_plan_overlap", _plan_sql(512, 256, True))
def q_tile_plan_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir, 512, 256, True).select(*_OUT)


@query("q_num_tiles", _M + " SELECT mosaic_id, greatest(1, (width - 512) // 256 + 1) * greatest(1, (height - 512) // 256 + 1) AS n_tiles FROM mosaics")
def q_num_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "mosaics").select("mosaic_id", tiling.expected_tiles(F.col("width"), F.col("height"), 512, 256).alias("n_tiles"))


@query("q_valid_windows", _M + """, w AS (SELECT mosaic_id, width, height, mosaic_key % 700 - 50 AS x, mosaic_key % 300 AS y, 512 AS w, mosaic_key % 3 * 256 AS h FROM mosaics)
  SELECT mosaic_id, x, y FROM w WHERE x >= 0 AND y >= 0 AND w > 0 AND h > 0 AND x + w <= width AND y + h <= height""")
def q_valid_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "mosaics").selectExpr("mosaic_id", "width", "height", "mosaic_key % 700 - 50 as x", "mosaic_key % 300 as y", "512 as w", "mosaic_key % 3 * 256 as h")
    return rows.where(tiling.valid_window()).select("mosaic_id", "x", "y")


@query("q_window_bounds", _plan_sql(512, 512, True).rpartition("SELECT mosaic_id")[0] + """ SELECT mosaic_id, x, y, round(minx + x * (maxx - minx) / width, 6) AS west, round(maxy - y * (maxy - miny) / height, 6) AS north,
  round(minx + (x + 512) * (maxx - minx) / width, 6) AS east, round(maxy - (y + 512) * (maxy - miny) / height, 6) AS south FROM plan""")
def q_window_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _plan(spark, sf_dir, 512, 512, True)
    geo = tiling.window_geo(tuple(F.col(c) for c in ("minx", "miny", "maxx", "maxy")))
    names = {"left": "west", "top": "north", "right": "east", "bottom": "south"}
    return rows.select("mosaic_id", "x", "y", *(F.round(c, 6).alias(names[n]) for n, c in geo.items()))


_BUNDLES = "mosaic_key % 7 < 5"
_CANON = "mosaic_key - mosaic_key % 7"


def _bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seven rasters in a row: the first five are a bundle on the first, two are loose."""
    rows = view(spark, sf_dir, "mosaics")
    ids = rows.select(F.col("mosaic_key").alias("c_key"), F.col("mosaic_id").alias("canonical_mosaic_id"))
    members = rows.where(_BUNDLES).select("mosaic_id", F.expr(_CANON).alias("c_key")).join(ids, "c_key")
    return members.select("mosaic_id", F.concat(F.lit("B"), F.col("c_key").cast("string")).alias("bundle_id"), "canonical_mosaic_id")


_BUNDLE_SQL = _M + f""", b AS (SELECT m.mosaic_id, 'B' || c.mosaic_key AS bundle_id, c.mosaic_id AS canonical_mosaic_id FROM mosaics m JOIN mosaics c ON c.mosaic_key = m.mosaic_key - m.mosaic_key % 7 WHERE m.{_BUNDLES}),
  jobs AS (SELECT DISTINCT canonical_mosaic_id AS mosaic_id, bundle_id FROM b UNION ALL SELECT mosaic_id, '' FROM mosaics WHERE mosaic_id NOT IN (SELECT mosaic_id FROM b)),
  r AS (SELECT mosaic_id, bundle_id, width, unnest(range(0, height - 511, 512)) AS y FROM jobs JOIN mosaics USING (mosaic_id)),
  plan AS (SELECT *, unnest(range(0, width - 511, 512)) AS x FROM r)"""


@query("q_canonical_plan", _BUNDLE_SQL + " SELECT mosaic_id, bundle_id, count(*) AS n_windows FROM plan GROUP BY 1, 2")
def q_canonical_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = tiling.canonical_plan(view(spark, sf_dir, "mosaics"), _bundles(spark, sf_dir), 512, 512)
    return plan.groupBy("mosaic_id", "bundle_id").agg(F.count("*").alias("n_windows"))


@query("q_bundle_windows", _BUNDLE_SQL + " SELECT p.bundle_id, x, y, count(*) AS n_members, min(b.mosaic_id) AS first_member FROM plan p JOIN b ON b.bundle_id = p.bundle_id GROUP BY 1, 2, 3")
def q_bundle_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every window of a bundle with the rasters that are read for it."""
    bundles = _bundles(spark, sf_dir)
    plan = tiling.canonical_plan(view(spark, sf_dir, "mosaics"), bundles, 512, 512)
    return plan.join(bundles.select("bundle_id", F.col("mosaic_id").alias("member")), "bundle_id").groupBy("bundle_id", "x", "y").agg(F.count("*").alias("n_members"), F.min("member").alias("first_member"))


@query("q_member_order", _BUNDLE_SQL + " SELECT mosaic_id, bundle_id, row_number() OVER (PARTITION BY bundle_id ORDER BY mosaic_id <> canonical_mosaic_id, mosaic_id)::integer AS nth FROM b")
def q_member_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical raster first, then by id."""
    from pyspark.sql.window import Window

    order = Window.partitionBy("bundle_id").orderBy(F.col("mosaic_id") != F.col("canonical_mosaic_id"), "mosaic_id")
    return _bundles(spark, sf_dir).select("mosaic_id", "bundle_id", F.row_number().over(order).alias("nth"))


@query("q_shard_assign", "SELECT l_suppkey, l_orderkey, l_linenumber, (n // 128 + 1)::integer AS shard_index, (n % 128)::integer AS shard_pos FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 AS n FROM lineitem)")
def q_shard_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return tiling.shard_positions(tiles, "l_suppkey", ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"], 128).select("l_suppkey", "l_orderkey", "l_linenumber", "shard_index", "shard_pos")


_SHAPED = "p_brand AS bundle, p_name AS mosaic_id, CASE WHEN p_size % 2 = 0 OR p_brand LIKE '%1' THEN 'uint8' ELSE 'uint16' END AS dtype, 512 AS height, CASE WHEN p_brand LIKE '%2' THEN p_size ELSE 512 END AS width"


@query(
    "q_bundle_merge_meta",
    f"""WITH m AS (SELECT {_SHAPED} FROM part) SELECT bundle, count(*) AS bands, CASE WHEN count(DISTINCT dtype) = 1 THEN max(dtype) ELSE 'mixed' END AS dtype,
    CASE WHEN count(DISTINCT width) = 1 THEN max(height) || 'x' || max(width) END AS array_shape, string_agg(DISTINCT mosaic_id, ';' ORDER BY mosaic_id) AS mosaic_ids FROM m GROUP BY 1""",
)
def q_bundle_merge_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.merge_bundle(table(spark, sf_dir, "part").selectExpr(*_split(_SHAPED)), "bundle")


def _split(expressions: str) -> list[str]:
    """Select list parts; the expressions hold no comma of their own."""
    return [e.strip() for e in expressions.split(",")]


@query(
    "q_member_lookup",
    """WITH listed AS (SELECT o_orderkey, unnest(range(1, 4)) AS member FROM orders)
    SELECT o_orderkey, member, l_partkey IS NOT NULL AS found FROM listed LEFT JOIN (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY 1, 2) ON l_orderkey = o_orderkey AND l_linenumber = member""",
)
def q_member_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members that a record lists, and whether each is in its archive."""
    listed = table(spark, sf_dir, "orders").select("o_orderkey", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("m"))
    items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"))
    joined = listed.join(items, (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_linenumber") == F.col("m")), "left")
    return joined.select("o_orderkey", F.col("m").cast("long").alias("member"), F.col("p").isNotNull().alias("found"))


@query(
    "q_stitch_extent",
    _BUNDLE_SQL + " SELECT mosaic_id, min(x) AS x0, min(y) AS y0, max(x) + 512 AS width, max(y) + 512 AS height, count(*) AS tiles FROM plan GROUP BY 1",
)
def q_stitch_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = tiling.canonical_plan(view(spark, sf_dir, "mosaics"), _bundles(spark, sf_dir), 512, 512)
    return plan.groupBy("mosaic_id").agg(F.min("x").alias("x0"), F.min("y").alias("y0"), (F.max(F.col("x")) + 512).alias("width"), (F.max(F.col("y")) + 512).alias("height"), F.count("*").alias("tiles"))


@query(
    "q_downsample_size",
    """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '-tr ' || p_size || ' ' || p_size WHEN 1 THEN '-outsize ' || p_size || '% ' || p_size || '%' ELSE '-outsize ' || p_size || ' 0' END AS size_args FROM part""",
)
def q_downsample_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None)
    k = F.col("p_partkey") % 3
    args = tiling.downsample_size(none, none, F.when(k == 0, F.col("p_size")), F.when(k == 1, F.col("p_size").cast("double") / 100), F.when(k == 2, F.col("p_size")), none.cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", args.alias("size_args"))


@query("q_incremental_plan", _M + " SELECT mosaic_id FROM mosaics WHERE mosaic_key NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 49)")
def q_incremental_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rasters that have no output yet."""
    done = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' AND l_quantity >= 49").select(F.col("l_partkey").alias("mosaic_key")).distinct()
    return view(spark, sf_dir, "mosaics").join(done, "mosaic_key", "left_anti").select("mosaic_id")

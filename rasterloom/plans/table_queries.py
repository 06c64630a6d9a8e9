"""Queries on catalogue tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.functions import text
from rasterloom.operators import catalog, labels, tiling
from rasterloom.plans import experiments
from rasterloom.plans.fixtures import view, with_views
from rasterloom.plans.registry import Registry
from rasterloom.session import table

REGISTRY = Registry()
query = REGISTRY.query


@query("q_discover", with_views("manifest") + " SELECT mosaic_key, path FROM manifest WHERE path LIKE '%.tif' AND NOT list_contains(string_split(path, '/'), '2025_01_01_Site0_SD_S1')")
def q_discover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.rasters(view(spark, sf_dir, "manifest"), exempt=("2025_01_01_Site0_SD_S1",)).select("mosaic_key", "path")


_NOTE = "case p_partkey % 6 when 0 then ' NaN ' when 1 then 'none' when 2 then '' when 3 then '  ' when 4 then cast(p_size as string) else concat(' ', cast(p_partkey as string), '.5 ') end"


@query("q_manifest_column", f"WITH m AS (SELECT p_partkey, {_NOTE} AS note FROM part) SELECT note FROM m WHERE trim(note) <> ''")
def q_manifest_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.column_values(table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_NOTE} as note"), "note")


@query("q_clean_nulls", f"WITH m AS (SELECT p_partkey, {_NOTE} AS note FROM part) SELECT p_partkey, CASE WHEN lower(trim(note)) IN ('', 'nan', 'none', 'null') THEN NULL ELSE trim(note) END AS note FROM m")
def q_clean_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_NOTE} as raw").select("p_partkey", text.clean(F.col("raw")).alias("note"))


@query(
    "q_georows",
    f"""WITH m AS (SELECT p_partkey, {_NOTE} AS minx, cast(p_size as string) AS miny, '10' AS maxx, '20.25' AS maxy FROM part),
    c AS (SELECT p_partkey, try_cast(CASE WHEN lower(trim(minx)) IN ('', 'nan', 'none', 'null') THEN NULL ELSE trim(minx) END AS double) AS minx, miny::double AS miny, maxx::double AS maxx, maxy::double AS maxy FROM m)
    SELECT * FROM c WHERE minx IS NOT NULL""",
)
def q_georows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_NOTE} as minx", "cast(p_size as string) as miny", "'10' as maxx", "'20.25' as maxy")
    return catalog.geo_rows(rows)


_SELECTED = "variant_id IN ('DSM', 'RGB') AND event_date IN ('240110', '240112')"


@query("q_selector", with_views("mosaics") + f" SELECT mosaic_id, variant_id, event_date FROM mosaics WHERE {_SELECTED}")
def q_selector(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "mosaics")
    return catalog.select_rasters(rows, variant_id=["DSM", "RGB"], event_date=["240110", "240112"]).select("mosaic_id", "variant_id", "event_date")


@query("q_limit", with_views("mosaics") + f" SELECT mosaic_id FROM mosaics WHERE {_SELECTED} ORDER BY mosaic_key LIMIT 25")
def q_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = catalog.select_rasters(view(spark, sf_dir, "mosaics"), variant_id=["DSM", "RGB"], event_date=["240110", "240112"])
    return rows.orderBy("mosaic_key").limit(25).select("mosaic_id")


@query("q_selected_semi", with_views("mosaics") + " SELECT mosaic_id FROM mosaics WHERE mosaic_key IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 45)")
def q_selected_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "lineitem").where("l_quantity >= 45").select(F.col("l_partkey").alias("mosaic_key"))
    return view(spark, sf_dir, "mosaics").join(wanted, "mosaic_key", "left_semi").select("mosaic_id")


_GROUPED = "CASE WHEN p_partkey % 9 = 0 THEN '' WHEN p_partkey % 9 = 1 THEN 'None' ELSE concat('MM_', cast(p_partkey % 40 as string)) END"


@query(
    "q_manifest_geo_join",
    with_views("manifest", "mosaics")
    + f""", g AS (SELECT p_partkey AS mosaic_key, {_GROUPED} AS metamosaic_id FROM part)
    SELECT mosaic_key, path, metamosaic_id, minx, maxy FROM manifest JOIN g USING (mosaic_key) JOIN mosaics USING (mosaic_key) WHERE metamosaic_id NOT IN ('', 'None')""",
)
def q_manifest_geo_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = table(spark, sf_dir, "part").selectExpr("p_partkey as mosaic_key", f"{_GROUPED} as metamosaic_id")
    rows = view(spark, sf_dir, "manifest").join(groups, "mosaic_key").where(text.clean(F.col("metamosaic_id")).isNotNull())
    return rows.join(view(spark, sf_dir, "mosaics").select("mosaic_key", "minx", "maxy"), "mosaic_key").select("mosaic_key", "path", "metamosaic_id", "minx", "maxy")


@query(
    "q_enrich_manifest",
    with_views("manifest", "segments") + " SELECT mosaic_key, path, coalesce(cast(line_id AS varchar), '') AS line_id FROM manifest LEFT JOIN segments ON mosaic_key = line_id",
)
def q_enrich_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = view(spark, sf_dir, "segments").select(F.col("line_id").alias("mosaic_key"), "line_id")
    return catalog.enrich(view(spark, sf_dir, "manifest"), lines, "mosaic_key", ["line_id"]).select("mosaic_key", "path", "line_id")


@query("q_metamosaic_counts", f"SELECT {_GROUPED} AS metamosaic_id, count(*) AS n_mosaics FROM part GROUP BY 1")
def q_metamosaic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy(F.expr(_GROUPED).alias("metamosaic_id")).agg(F.count("*").alias("n_mosaics"))


@query("q_scope_groups", f"WITH g AS (SELECT p_partkey, {_GROUPED} AS m FROM part) SELECT CASE WHEN m IN ('', 'None') THEN 'mosaic:' || p_partkey ELSE m END AS scope, count(*) AS n FROM g GROUP BY 1")
def q_scope_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = catalog.scope_key(F.expr(_GROUPED), F.col("p_partkey").cast("string"))
    return table(spark, sf_dir, "part").groupBy(key.alias("scope")).agg(F.count("*").alias("n"))


@query(
    "q_alias_resolve",
    """WITH t AS (SELECT DISTINCT p_brand AS token FROM part UNION SELECT DISTINCT 'Customer#' || c_custkey FROM customer),
    ids AS (SELECT p_name AS id, p_brand AS alias FROM part UNION SELECT 'Customer#' || c_custkey, c_mktsegment FROM customer),
    m AS (SELECT token, count(DISTINCT CASE WHEN alias = token THEN id END) AS matches, max(CASE WHEN id = token THEN id END) AS exact, min(CASE WHEN alias = token THEN id END) AS named FROM t JOIN ids ON id = token OR alias = token GROUP BY token)
    SELECT token, matches::integer AS matches, coalesce(exact, CASE WHEN matches = 1 THEN named END) AS resolved FROM m""",
)
def q_alias_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, customer = table(spark, sf_dir, "part"), table(spark, sf_dir, "customer")
    name = F.concat(F.lit("Customer#"), F.col("c_custkey").cast("string"))
    tokens = part.select(F.col("p_brand").alias("token")).union(customer.select(name)).distinct()
    ids = part.select(F.col("p_name").alias("id"), F.col("p_brand").alias("alias")).union(customer.select(name, "c_mktsegment")).distinct()
    # Two equi-joins in place of one with OR, which would compare all pairs.
    hits = tokens.join(ids, F.col("id") == F.col("token")).unionByName(tokens.join(ids, F.col("alias") == F.col("token")))
    return catalog.resolve_alias(hits, F.col("token"), F.col("id"), F.col("alias"))


@query(
    "q_scan_report",
    with_views("manifest") + r" SELECT count(DISTINCT regexp_extract(path, '^(.*)/[^/]*$', 1)) AS n_dirs, count(*) AS n_files, sum(byte_size)::bigint AS total_bytes FROM manifest",
)
def q_scan_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.scan_report(view(spark, sf_dir, "manifest"))


@query("q_suffix_bytes", with_views("manifest") + r" SELECT regexp_extract(path, '(\.[^.]*)$', 1) AS suffix, count(*) AS n_files, sum(byte_size)::bigint AS total_bytes FROM manifest GROUP BY 1")
def q_suffix_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.suffix_bytes(view(spark, sf_dir, "manifest"))


@query("q_topk_largest", with_views("manifest") + " SELECT path, byte_size FROM manifest ORDER BY byte_size DESC, path LIMIT 500")
def q_topk_largest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "manifest").orderBy(F.desc("byte_size"), "path").limit(500).select("path", "byte_size")


@query(
    "q_flatten_union",
    """SELECT '' AS doc, cast(event_id as varchar) AS id, event_type AS kind, '["' || event_type || '"]' AS tags FROM events
    UNION ALL SELECT cast(doc_id as varchar), '', coalesce(lang, ''), '' FROM documents""",
)
def q_flatten_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.array("event_type").alias("tags"))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), F.col("lang").alias("kind"))
    return catalog.union_tables(events, docs)


@query(
    "q_incremental_union",
    """SELECT o_orderkey, 'cached' AS origin FROM orders WHERE o_orderpriority = '1-URGENT'
    UNION ALL SELECT o_orderkey, 'fresh' FROM orders WHERE o_orderpriority <> '1-URGENT'""",
)
def q_incremental_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    cached = orders.where("o_orderpriority = '1-URGENT'").select("o_orderkey", F.lit("cached").alias("origin"))
    return catalog.incremental(cached, orders.select("o_orderkey", F.lit("fresh").alias("origin")), "o_orderkey")


@query("q_json_flatten", "SELECT event_id, '{\"event_type\":\"' || event_type || '\",\"user_id\":' || user_id || '}' AS body FROM events")
def q_json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.to_json(F.struct("event_type", "user_id")).alias("body"))


@query("q_dotted_flatten", "SELECT event_id, cast(props->>'$.k' AS bigint) AS props__k, event_type AS source__kind, user_id AS source__user__id FROM events")
def q_dotted_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "struct<k:bigint>").alias("props"),
        F.struct(F.col("event_type").alias("kind"), F.struct(F.col("user_id").alias("id")).alias("user")).alias("source"),
    )
    return catalog.dotted(nested)


@query(
    "q_run_summary",
    """SELECT count(*) AS seen, count(*) FILTER (o_orderstatus = 'F') AS written, count(*) FILTER (o_orderstatus = 'O') AS skipped, count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS errors,
    CASE WHEN count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) > 0 THEN 1 ELSE 0 END AS exit_code FROM orders""",
)
def q_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "written").when(F.col("o_orderstatus") == "O", "skipped").otherwise("error")
    return catalog.run_summary(table(spark, sf_dir, "orders").select(status.alias("status")))


_FIELDS = ["event_date", "name", "state", "suffix", "source", "reviewer", "status", "confidence", "notes", "created_at"]


@query(
    "q_stage_layers",
    f"""SELECT s_suppkey AS metamosaic_key, s_name || '_' || kind AS layer, CASE kind WHEN 'line' THEN 'LineString' ELSE 'Polygon' END AS geometry, field, '' AS default_value
    FROM supplier, (SELECT unnest(['line', 'area']) AS kind), (SELECT unnest({_FIELDS}) AS field)""",
)
def q_stage_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layer and field rows of the empty label packages, one line and one area layer each."""
    kinds = F.explode(F.array(F.lit("line"), F.lit("area"))).alias("kind")
    fields = F.explode(F.array(*(F.lit(f) for f in _FIELDS))).alias("field")
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", kinds).select("*", fields)
    geometry = F.when(F.col("kind") == "line", "LineString").otherwise("Polygon")
    return rows.select(F.col("s_suppkey").alias("metamosaic_key"), F.concat_ws("_", "s_name", "kind").alias("layer"), geometry.alias("geometry"), "field", F.lit("").alias("default_value"))


@query("q_identical_arrays", "SELECT sha256(text) AS sha256, count(*) AS n, min(doc_id) AS first_doc FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def q_identical_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("text is not null")
    return docs.groupBy(F.sha2("text", 256).alias("sha256")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc")).where("n > 1")


_ROUTE = "regexp_replace(regexp_replace(lower(trim(o_orderpriority)), '[^a-z0-9_.-]+', '_', 'g'), '^[._-]+|[._-]+$', '', 'g')"


@query(
    "q_route_buckets",
    f"SELECT o_orderkey, {_ROUTE} AS route, ((row_number() OVER (PARTITION BY {_ROUTE} ORDER BY o_orderkey) - 1) // 100 + 1)::integer AS shard_index FROM orders",
)
def q_route_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.route(table(spark, sf_dir, "orders"), "o_orderpriority", ["o_orderkey"], 100).select("o_orderkey", "route", "shard_index")


@query("q_split_route", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'notF' END AS route FROM orders")
def q_split_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.split_on(table(spark, sf_dir, "orders"), "o_orderstatus", "F").select("o_orderkey", "route")


@query("q_first_wins", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def q_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.first_wins(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "q_config_grid",
    """SELECT tile_size, stride, dtype, p_low, p_high, num_samples FROM (SELECT unnest([256, 512]) AS tile_size), (SELECT unnest([0, 256, 512]) AS stride), (SELECT unnest(['uint16', 'uint8']) AS dtype),
    (SELECT unnest([5.0::double, 98.0::double]) AS p_low), (SELECT unnest([95.0::double]) AS p_high), (SELECT unnest([1024, 2048]) AS num_samples)
    WHERE stride > 0 AND stride <= tile_size AND p_low >= 0 AND p_low < p_high AND p_high <= 100""",
)
def q_config_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The experiment grid: a product of option lists, invalid settings left out."""
    grid = {"tile_size": [256, 512], "stride": [0, 256, 512], "dtype": ["uint16", "uint8"], "p_low": [5.0, 98.0], "p_high": [95.0], "num_samples": [1024, 2048]}
    return experiments.settings(spark, grid).where(experiments.is_valid())


@query(
    "q_throughput",
    """SELECT o_custkey AS run_id, count(*) AS tiles, round(sum(o_totalprice) / count(*), 6) AS bytes_per_tile, round(count(*) / nullif(sum(o_totalprice) / 1000, 0), 9) AS tiles_per_second FROM orders GROUP BY 1""",
)
def q_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("run_id")).agg(F.count("*").alias("tiles"), F.sum("o_totalprice").alias("out_bytes"))
    per_second, per_tile = experiments.rates(F.col("tiles"), F.col("out_bytes") / 1000, F.col("out_bytes"))
    return runs.select("run_id", "tiles", F.round(per_tile, 6).alias("bytes_per_tile"), F.round(per_second, 9).alias("tiles_per_second"))

"""Queries on names, dates, ids and locations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.functions import text
from rasterloom.operators import catalog
from rasterloom.plans.fixtures import view, with_views
from rasterloom.plans.registry import Registry
from rasterloom.session import table

REGISTRY = Registry()
query = REGISTRY.query

_STEM = r"regexp_extract(path, '([^/]+?)(?:\.[^./]*)?$', 1)"
_IDS = "'" + "', '".join(v[0] for v in text.VARIANTS) + "'"
_CONTAINS = "CASE " + " ".join(f"WHEN contains(upper(stem), '{v[0]}') THEN '{v[0]}'" for v in text.VARIANTS) + " ELSE 'NLL' END"
_KIND = "CASE v " + " ".join(f"WHEN '{i}' THEN '{k}'" for i, k, _ in text.VARIANTS) + " ELSE 'unknown' END"
_SPECTRAL = "CASE v " + " ".join(f"WHEN '{i}' THEN '{s}'" for i, _, s in text.VARIANTS if s) + " END"


@query(
    "q_variant_parse",
    with_views("manifest")
    + f""", s AS (SELECT mosaic_key, {_STEM} AS stem FROM manifest),
    t AS (SELECT *, coalesce(list_filter(string_split_regex(upper(stem), '[^A-Z0-9]+'), lambda x: x IN ({_IDS}))[1], {_CONTAINS}) AS v FROM s)
    SELECT mosaic_key, v AS variant_id, {_KIND} AS variant_type, {_SPECTRAL} AS spectral_id FROM t""",
)
def q_variant_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "manifest").select("mosaic_key", text.variant(F.col("path")).alias("v")).select("mosaic_key", "v.*")


def _date_sql(pattern: str, century: str) -> str:
    part = [f"regexp_extract(stem, '{pattern}', {k})" for k in (1, 2, 3)]
    return f"strftime(try_strptime('{century}' || {' || '.join(part)}, '%Y%m%d'), '%y%m%d')"


@query(
    "q_date_parse",
    with_views("manifest")
    + f""", s AS (SELECT mosaic_key, {_STEM} AS stem FROM manifest)
    SELECT mosaic_key, coalesce({_date_sql('(?:^|[^0-9])(20[0-9]{2})[-_]?([01][0-9])[-_]?([0-3][0-9])(?:[^0-9]|$)', '')},
      {_date_sql('(?:^|[^0-9])([0-9]{2})([01][0-9])([0-3][0-9])(?:[^0-9]|$)', '20')}, 'nulldate') AS date FROM s""",
)
def q_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "manifest").select("mosaic_key", text.acquisition_date(F.col("path")).alias("date"))


@query(
    "q_acquired_at",
    with_views("manifest")
    + f""", s AS (SELECT mosaic_key, regexp_extract({_STEM}, '^[0-9]{{2}}(?:0[1-9]|1[0-2])(?:0[1-9]|[12][0-9]|3[01])', 0) AS d FROM manifest)
    SELECT mosaic_key, CASE WHEN d <> '' THEN '20' || d[1:2] || '-' || d[3:4] || '-' || d[5:6] END AS acquired_at FROM s""",
)
def q_acquired_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "manifest").select("mosaic_key", text.acquired_at(text.stem(F.col("path"))).alias("acquired_at"))


@query("q_slug", "SELECT p_partkey, coalesce(nullif(lower(regexp_replace(p_name, '[^A-Za-z0-9]+', '', 'g')), ''), 'locale') AS slug FROM part")
def q_slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", text.slug(F.col("p_name")).alias("slug"))


@query(
    "q_tile_ids",
    with_views("mosaics")
    + """ SELECT mosaic_id, format('T{}r{:04d}c{:04d}', substr(mosaic_id, 2), height % 97, width % 89) AS tile_id,
      format('{}r{:04d}c{:04d}', lower(variant_id), height % 97, width % 89) AS tile_key FROM mosaics""",
)
def q_tile_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    row, col = F.col("height") % 97, F.col("width") % 89
    return view(spark, sf_dir, "mosaics").select(
        "mosaic_id", text.tile_id(F.col("mosaic_id"), row, col).alias("tile_id"), text.tile_key(F.lower("variant_id"), row, col).alias("tile_key")
    )


_HINT = """, p AS (SELECT mosaic_key, list_filter(list_reverse(string_split(path, '/')), lambda x: regexp_matches(x, '^20[0-9]{2}_[0-9]{2}_[0-9]{2}_.+$'))[1] AS part FROM manifest),
  r AS (SELECT *, substr(part, 12) AS rest, string_split(substr(part, 12), '_') AS tokens FROM p),
  i AS (SELECT *, coalesce(list_position(list_transform(tokens, lambda x: regexp_matches(x, '^[A-Z]{2}$')), true), 0) AS pos FROM r),
  hints AS (SELECT mosaic_key, coalesce(replace(substr(part, 1, 10), '_', '-'), '') AS event_date,
    coalesce(CASE WHEN pos > 0 THEN array_to_string(tokens[1:pos - 1], '_') ELSE rest END, '') AS name,
    CASE WHEN pos > 0 THEN tokens[pos] ELSE '' END AS state,
    CASE WHEN pos > 0 THEN array_to_string(tokens[pos + 1:], '_') ELSE '' END AS suffix, coalesce(part, '') AS source FROM i)"""


@query("q_location_hint", with_views("manifest") + _HINT + " SELECT * FROM hints")
def q_location_hint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "manifest").select("mosaic_key", text.location_hint(F.col("path")).alias("h")).select("mosaic_key", "h.*")


@query(
    "q_modal_hint",
    with_views("manifest")
    + _HINT
    + """, c AS (SELECT mosaic_key % 100 AS site, name, count(*) AS n, min(mosaic_key) AS first FROM hints WHERE name <> '' GROUP BY 1, 2)
    SELECT site, name, n FROM c QUALIFY row_number() OVER (PARTITION BY site ORDER BY n DESC, first) = 1""",
)
def q_modal_hint(spark: SparkSession, sf_dir: str) -> DataFrame:
    hints = q_location_hint(spark, sf_dir).select((F.col("mosaic_key") % 100).alias("site"), "name", "mosaic_key")
    return catalog.modal_hint(hints, "site", "name", "mosaic_key")


_PLACE = "CASE mosaic_key % 3 WHEN 0 THEN 'SD' WHEN 1 THEN 'AR' ELSE '' END AS at_state, CASE WHEN mosaic_key % 2 = 0 THEN 'site' ELSE concat('Site', cast(mosaic_key % 50 as string)) END AS at_name"


@query(
    "q_location_warning",
    with_views("manifest")
    + _HINT
    + f""", x AS (SELECT *, {_PLACE}, lower(regexp_replace(name, '[^A-Za-z0-9]+', '', 'g')) AS a FROM hints), y AS (SELECT *, lower(regexp_replace(at_name, '[^A-Za-z0-9]+', '', 'g')) AS b FROM x)
    SELECT mosaic_key, concat_ws(';', CASE WHEN state <> '' AND at_state <> '' AND state <> at_state THEN 'state_hint_mismatch' END,
      CASE WHEN name <> '' AND at_name <> '' AND NOT contains(a, b) AND NOT contains(b, a) THEN 'location_hint_mismatch' END) AS warning,
      CASE WHEN at_name <> '' AND at_state <> '' THEN concat(at_name, ', ', at_state) WHEN at_name <> '' THEN at_name WHEN at_state <> '' THEN at_state ELSE 'unknown' END AS display_name FROM y""",
)
def q_location_warning(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = q_location_hint(spark, sf_dir).selectExpr("*", *_PLACE.split(", CASE WHEN")[:1], "CASE WHEN" + _PLACE.split(", CASE WHEN")[1])
    warning = text.location_warning(F.col("name"), F.col("state"), F.col("at_name"), F.col("at_state"))
    return rows.select("mosaic_key", warning.alias("warning"), text.display_name(F.col("at_name"), F.lit(""), F.col("at_state")).alias("display_name"))


@query(
    "q_resolve_location",
    with_views("manifest", "mosaics")
    + _HINT
    + """ SELECT mosaic_key, name, state, CASE WHEN name <> '' THEN 'folder_hint' ELSE 'unknown' END AS kind, CASE WHEN name <> '' THEN source ELSE 'bbox_center_unresolved' END AS source,
      CASE WHEN name <> '' THEN 0.5::double ELSE 0.0::double END AS confidence, round((minx + maxx) / 2, 6) AS lon, round((miny + maxy) / 2, 6) AS lat FROM hints JOIN mosaics USING (mosaic_key)""",
)
def q_resolve_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = q_location_hint(spark, sf_dir).join(view(spark, sf_dir, "mosaics").select("mosaic_key", "minx", "miny", "maxx", "maxy"), "mosaic_key")
    known = F.col("name") != ""
    return rows.select(
        "mosaic_key", "name", "state", F.when(known, "folder_hint").otherwise("unknown").alias("kind"),
        F.when(known, F.col("source")).otherwise("bbox_center_unresolved").alias("source"), F.when(known, 0.5).otherwise(0.0).alias("confidence"),
        F.round((F.col("minx") + F.col("maxx")) / 2, 6).alias("lon"), F.round((F.col("miny") + F.col("maxy")) / 2, 6).alias("lat"),
    )


_RAW_BUCKET = "concat(' Damage_Review/', case when p_partkey % 3 = 0 then '../' when p_partkey % 3 = 1 then './' else '' end, p_name, '/', case when p_partkey % 5 = 0 then '..' else p_brand end, ' ')"


@query(
    "q_safe_bucket",
    f"""WITH b AS (SELECT p_partkey, list_filter(list_transform(string_split(lower(trim({_RAW_BUCKET})), '/'), lambda x: trim(x)), lambda x: x NOT IN ('', '.', '..')) AS parts FROM part)
    SELECT p_partkey, coalesce(nullif(array_to_string(list_filter(list_transform(parts, lambda x: regexp_replace(regexp_replace(x, '[^a-z0-9_.-]+', '_', 'g'), '^[._-]+|[._-]+$', '', 'g')), lambda x: x <> ''), '/'), ''), 'unknown') AS bucket FROM b""",
)
def q_safe_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", text.safe_bucket(F.expr(_RAW_BUCKET)).alias("bucket"))


@query(
    "q_storage_uri",
    with_views("manifest")
    + r""" SELECT mosaic_key, 'shard://' || regexp_extract(path, '(?:^|/)(drive(?:/.*)?)$', 1) || '!/' || mosaic_key || '.json' AS tile_json_uri, 'file://' || path AS source_uri FROM manifest""",
)
def q_storage_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    member = F.concat(F.col("mosaic_key").cast("string"), F.lit(".json"))
    path = F.col("path")
    return view(spark, sf_dir, "manifest").select("mosaic_key", text.logical_uri(path, "drive", "shard", member).alias("tile_json_uri"), text.as_uri(path).alias("source_uri"))


@query("q_sha_members", "SELECT doc_id, sha256(coalesce(text, '')) AS npy_sha256 FROM documents")
def q_sha_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("npy_sha256"))


@query("q_short_hash")
def q_short_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = text.file_name(F.col("path"))
    return view(spark, sf_dir, "manifest").select("mosaic_key", text.short_hash(name).alias("alias"))


@query("q_mosaic_ids")
def q_mosaic_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full manifest rows: alias, raster id, date, variant."""
    path = F.col("path")
    rows = view(spark, sf_dir, "manifest").select("mosaic_key", "path", text.short_hash(text.file_name(path)).alias("alias"), text.acquisition_date(path).alias("date"), text.variant(path).alias("v"))
    return rows.select("alias", F.concat(F.lit("M"), "date", "v.variant_id", "alias").alias("mosaic_id"), text.as_uri(path).alias("source_uri"), "path", "date", "v.*")


@query(
    "q_member_token",
    "SELECT p_partkey, trim(regexp_replace(trim(p_type), '[^A-Za-z0-9_-]+', '_', 'g'), '_') || '.b' || lpad((p_size)::varchar, 2, '0') AS member FROM part",
)
def q_member_token(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.concat(text.member_token(F.col("p_type")), F.lit(".b"), F.lpad(F.col("p_size").cast("string"), 2, "0")).alias("member"))

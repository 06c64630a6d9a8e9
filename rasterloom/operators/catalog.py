"""Catalogue tables: selection, enrichment, summaries and incremental upkeep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.functions.text import clean, file_name, number


def rasters(paths: DataFrame, suffixes: tuple[str, ...] = ("tif", "tiff"), exempt: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose ``path`` has one of the suffixes and no directory called by an exempt name."""
    suffix = F.lower(F.regexp_extract("path", r"\.([^./]*)$", 1))
    parts = F.split("path", "/")
    kept = paths.where(suffix.isin(*suffixes))
    return kept.where(~F.arrays_overlap(parts, F.array(*(F.lit(e) for e in exempt)))) if exempt else kept


def column_values(manifest: DataFrame, name: str) -> DataFrame:
    """One column, blanks left out; an error if it is missing."""
    if name not in manifest.columns:
        raise ValueError(f"manifest has no column {name!r}")
    return manifest.select(name).where(F.trim(F.coalesce(F.col(name).cast("string"), F.lit(""))) != "")


def geo_rows(metadata: DataFrame) -> DataFrame:
    """Rows whose four bounds read as numbers, as doubles; the others are left out."""
    sides = {c: number(F.col(c)) for c in ("minx", "miny", "maxx", "maxy")}
    return metadata.withColumns(sides).dropna(subset=list(sides))


def select_rasters(manifest: DataFrame, scope: dict[str, list[str]] | None = None, **wanted: list[str]) -> DataFrame:
    """AND over the columns named, OR inside each list.

    ``alias`` matches the raster's or its group's alias. ``scope`` supplies
    defaults, only where no id is asked for.
    """
    if scope and not any(wanted.get(k) for k in ("mosaic_id", "metamosaic_id", "alias")):
        wanted = {**scope, **wanted}
    for name, values in wanted.items():
        if not values:
            continue
        if name == "alias":
            manifest = manifest.where(F.arrays_overlap(F.array("alias", "metamosaic_alias"), F.array(*(F.lit(v) for v in values))))
        else:
            manifest = manifest.where(F.col(name).isin(*values))
    return manifest


def resolve_alias(rows: DataFrame, token: Column, ids: Column, alias: Column) -> DataFrame:
    """``token, matches, resolved``: an exact id beats aliases; several ids for an alias are ambiguous (null)."""
    exact, named = F.max(F.when(ids == token, ids)), F.collect_set(F.when(alias == token, ids))
    out = rows.groupBy(token.alias("token")).agg(exact.alias("exact"), F.sort_array(named).alias("named"))
    return out.select("token", F.size("named").alias("matches"), F.coalesce("exact", F.when(F.size("named") == 1, F.get("named", F.lit(0)))).alias("resolved"))


def enrich(manifest: DataFrame, assignment: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Left join with '' where nothing is assigned."""
    joined = manifest.join(assignment.select(key, *columns), key, "left")
    return joined.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns})


def scan_report(files: DataFrame) -> DataFrame:
    """Directories, files and bytes."""
    directory = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    return files.agg(F.countDistinct(directory).alias("n_dirs"), F.count("*").alias("n_files"), F.sum("byte_size").alias("total_bytes"))


def suffix_bytes(files: DataFrame) -> DataFrame:
    suffix = F.lower(F.regexp_extract(file_name(F.col("path")), r"(\.[^.]*)$", 1))
    return files.groupBy(suffix.alias("suffix")).agg(F.count("*").alias("n_files"), F.sum("byte_size").alias("total_bytes"))


def incremental(existing: DataFrame, fresh: DataFrame, key: str, force: bool = False) -> DataFrame:
    """Cached rows and those fresh ones that are not cached yet; all fresh ones when forced."""
    if force:
        return existing.join(fresh.select(key), key, "left_anti").unionByName(fresh, allowMissingColumns=True)
    return existing.unionByName(fresh.join(existing.select(key), key, "left_anti"), allowMissingColumns=True)


def scope_key(metamosaic_id: Column, mosaic_id: Column) -> Column:
    group = clean(metamosaic_id)
    return F.coalesce(group, F.concat(F.lit("mosaic:"), mosaic_id))


def modal_hint(hints: DataFrame, group: str, hint: str, order: str) -> DataFrame:
    """The most frequent hint of each group; ties go to the one seen first."""
    counts = hints.where(F.col(hint) != "").groupBy(group, hint).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    best = F.max(F.struct("n", (-F.col("first")).alias("f"), hint))
    return counts.groupBy(group).agg(best.alias("b")).select(group, F.col(f"b.{hint}").alias(hint), F.col("b.n").alias("n"))


def run_summary(results: DataFrame) -> DataFrame:
    """Seen, written, skipped and failed, and the exit code: 1 if any failed."""
    of = {s: F.count_if(F.col("status") == s) for s in ("written", "skipped", "error")}
    return results.agg(F.count("*").alias("seen"), of["written"].alias("written"), of["skipped"].alias("skipped"), of["error"].alias("errors"), F.when(of["error"] > 0, 1).otherwise(0).alias("exit_code"))


def union_tables(*tables: DataFrame) -> DataFrame:
    """Union of differing columns, in sorted order, '' where one is absent, nested values as JSON text."""
    def flat(df: DataFrame) -> DataFrame:
        nested = [f.name for f in df.schema if f.dataType.typeName() in ("struct", "map", "array")]
        return df.select(*((F.to_json(c) if c in nested else F.col(c)).cast("string").alias(c) for c in df.columns))

    out = flat(tables[0])
    for t in tables[1:]:
        out = out.unionByName(flat(t), allowMissingColumns=True)
    return out.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in sorted(out.columns)))


def dotted(df: DataFrame) -> DataFrame:
    """Nested structs as columns named by their dotted path, the dots as ``__``."""
    def walk(schema, prefix: str):
        for f in schema:
            path = f"{prefix}`{f.name}`"
            if f.dataType.typeName() == "struct":
                yield from walk(f.dataType, path + ".")
            else:
                yield F.col(path).alias(path.replace("`", "").replace(".", "__"))

    return df.select(*walk(df.schema, ""))


# Default columns of the raster table and of the catalogue.
MOSAIC_COLUMNS = ["mosaic_id", "uri", "uri_etag", "byte_size", "crs", "srid", "pixel_width", "pixel_height", "band_count", "dtype", "nodata", "footprint", "acquired_at", "created_at"]
CATALOG_COLUMNS = ["uri", "mosaic_id", "pixel_width", "pixel_height", "band_count", "dtype", "crs"]


def requested(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The columns asked for, in that order (MOSAIC_COLUMNS if none are named); null where the table has none. Others are not read."""
    return rows.select(*(F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns or MOSAIC_COLUMNS))


def stamped(rows: DataFrame) -> DataFrame:
    """``created_at`` of this run in UTC, to the second."""
    return rows.withColumn("created_at", F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def staging_rows(rows: DataFrame) -> DataFrame:
    """Every column as text, '' where there is nothing, as a staging table takes them."""
    return rows.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in rows.columns))

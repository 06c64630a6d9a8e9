"""The tiling job: planned windows to tiles, shards, a tile manifest and sidecars.

Every window of a bundle's canonical grid is read from every member raster, put
on that grid, filtered and encoded band by band in its own type; members of one
tile are merged with the canonical raster first, labelled where labels are
given, and go to tar shards in row-major order, by bucket if they are routed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rasterloom.functions import geometry, raster, text
from rasterloom.operators import display, labels
from rasterloom.operators.resample import same_grid, warp
from rasterloom.operators.tiling import SHARD_SAMPLES, shard_positions, window_geo
from rasterloom.session import written
from rasterloom.sources import geotiff, shards, storage, tiff

_LAYER = pa.struct(
    [("suffix", pa.string()), ("variant", pa.string()), ("mosaic_id", pa.string()), ("source_uri", pa.string()), ("source_band", pa.int32()), ("dtype", pa.string()), ("shape", pa.list_(pa.int64()))]
    + [("masked_pixel_count", pa.int64()), ("fill_value", pa.float64()), ("npy_sha256", pa.string()), ("minimum", pa.float64()), ("maximum", pa.float64()), ("mean", pa.float64()), ("std", pa.float64()), ("payload", pa.binary())]
)
_LAYER_SQL = (
    "struct<suffix:string,variant:string,mosaic_id:string,source_uri:string,source_band:int,dtype:string,shape:array<bigint>,masked_pixel_count:bigint,fill_value:double,npy_sha256:string,"
    "minimum:double,maximum:double,mean:double,std:double,payload:binary>"
)
_SOURCE = pa.struct([("source_uri", pa.string()), ("source_name", pa.string()), ("source_driver", pa.string()), ("source_width", pa.int32()), ("source_height", pa.int32()), ("source_count", pa.int32()), ("source_dtypes", pa.list_(pa.string())), ("source_colorinterp", pa.list_(pa.string())), ("source_nodata", pa.float64())])
_CONTENT = pa.struct([(c, pa.float64()) for c in ("valid_fraction", "nonzero_fraction", "content_fraction", "black_fraction", "white_fraction")] + [("mostly_empty", pa.bool_())])
_KEYS = [("owner", "string", pa.string()), ("tile_id", "string", pa.string()), ("row_i", "int", pa.int32()), ("col_i", "int", pa.int32())] + [(c, "long", pa.int64()) for c in "xywh"]
_REST = [("nth", "int", pa.int32()), ("mosaic_id", "string", pa.string()), ("variant_id", "string", pa.string())]
_ARROW = pa.schema(
    [(n, t) for n, _, t in _KEYS + _REST] + [("layers", pa.list_(_LAYER)), ("srid", pa.int32()), ("transform", pa.list_(pa.float64())), ("source", _SOURCE), ("content", _CONTENT), ("reason", pa.string())]
)
READ = (
    ", ".join(f"{n} {t}" for n, t, _ in _KEYS + _REST) + f", layers array<{_LAYER_SQL}>, srid int, transform array<double>, "
    "source struct<source_uri:string,source_name:string,source_driver:string,source_width:int,source_height:int,source_count:int,source_dtypes:array<string>,source_colorinterp:array<string>,source_nodata:double>, "
    "content struct<valid_fraction:double,nonzero_fraction:double,content_fraction:double,black_fraction:double,white_fraction:double,mostly_empty:boolean>, reason string"
)
# The schema of the tile record and the columns of the tile manifest.
SCHEMA_NAME, SCHEMA_VERSION = "tile", "6.1"
MANIFEST = [
    "tile_id", "shard", "key", "source_uri", "x_off", "y_off", "w", "h", "crs", "minx", "miny", "maxx", "maxy", "bands", "dtype", "row_i", "col_i", "bucket",
    "bundle_id", "mosaic_id", "pixel_size_x", "pixel_size_y", "pixel_size_units", "shard_uri", "tile_uri", "tile_json_uri",
]


def jobs(plan: DataFrame, members: DataFrame) -> DataFrame:
    """A row per window and member raster. ``plan`` comes from ``tiling.canonical_plan``; ``members`` has
    mosaic_id, bundle_id ('' for a loose raster), canonical_mosaic_id, variant_id and path."""
    order = Window.partitionBy("owner").orderBy(F.col("mosaic_id") != F.col("canonical_mosaic_id"), "mosaic_id")
    owner = F.when(F.col("bundle_id") != "", F.col("bundle_id")).otherwise(F.col("mosaic_id")).alias("owner")
    ranked = members.select(owner, "mosaic_id", "variant_id", "path", "canonical_mosaic_id").withColumn("nth", F.row_number().over(order))
    grids = members.select(F.col("mosaic_id").alias("c_id"), F.col("path").alias("grid_path"))
    windows = plan.select(owner, F.col("mosaic_id").alias("c_id"), "row_i", "col_i", "x", "y", "w", "h").join(grids, "c_id").drop("c_id")
    rows = windows.join(ranked.drop("canonical_mosaic_id"), "owner")
    return rows.withColumn("tile_id", text.tile_id(F.col("owner"), F.col("row_i"), F.col("col_i")))


def read_tiles(rows: DataFrame, skip_empty: bool = True, min_content: float = 0.05, masked: bool = False, fill: float | None = None) -> DataFrame:
    """Windows as layers, one npy payload per band in the raster's own type.

    ``reason`` tells why a tile is left out ('' if it is kept): a check of the
    content, or ``fully_masked`` if ``masked`` is set and no pixel is valid. With
    ``masked`` the no-data value and what is no number are invalid; ``fill`` takes
    their place if it is given. An unreadable raster gives ``error: ...`` and the
    job goes on. Windows at the edge may be partial. Memory grows with the window.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads: dict[str, tiff.Tiff] = {}

        def head(uri: str) -> tiff.Tiff:
            if uri not in heads:
                with storage.reopen(uri) as src:
                    found = tiff.parse(src)
                if len(heads) > 16:
                    heads.clear()
                heads[uri] = found
            return heads[uri]

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                row = {n: r[n] for n, *_ in _KEYS + _REST}
                try:
                    own, grid = head(r["path"]), head(r["grid_path"])
                    array = _window(r, own, grid)
                    invalid = geotiff.invalid(array, own.nodata()) if masked else np.zeros(array.shape, bool)
                    reason = "fully_masked" if masked and invalid.all() else display.skip_reason(array, ~invalid if masked else None, min_content=min_content) if skip_empty else ""
                    row |= {"reason": reason, "srid": own.srid(), "transform": _shifted(grid.transform(), r["x"], r["y"]), "content": display.content(array, ~invalid, min_content)}
                    if not reason:
                        row |= {"layers": _layers(r, array, invalid, fill), "source": _source(r["path"], own)}
                except geotiff.UNREADABLE as failed:
                    row |= {"reason": f"error: {type(failed).__name__}: {failed}"}
                out.append(row)
            yield pa.RecordBatch.from_pylist(out, schema=_ARROW)

    near = rows.repartition("path").sortWithinPartitions("path", "row_i", "col_i")
    columns = ["owner", "tile_id", "row_i", "col_i", "x", "y", "w", "h", "nth", "mosaic_id", "variant_id", "path", "grid_path"]
    return near.select(*columns).mapInArrow(read, READ)


def _shifted(grid: list[float] | None, x: int, y: int) -> list[float]:
    if grid is None:
        raise ValueError("the raster has no georeference")
    x0, dx, rx, y0, ry, dy = grid
    return [x0 + x * dx + y * rx, dx, rx, y0 + x * ry + y * dy, ry, dy]


def _source(path: str, own: tiff.Tiff) -> dict:
    return {
        "source_uri": path, "source_name": path.rsplit("/", 1)[-1], "source_driver": geotiff.DRIVER, "source_width": own.width, "source_height": own.height, "source_count": own.count,
        "source_dtypes": [own.dtype().name] * own.count, "source_colorinterp": own.colors(), "source_nodata": own.nodata(),
    }


def _layers(r: dict, array: np.ndarray, invalid: np.ndarray, fill: float | None) -> list[dict]:
    out = []
    for n, (band, bad) in enumerate(zip(array, invalid, strict=True), 1):
        good, count = band[~bad].astype(float), int(bad.sum())
        if fill is not None and count:
            band = band.copy()
            band[bad] = fill
        payload = shards.encode_npy(band)
        numbers = (float(f(good)) for f in (np.min, np.max, np.mean, np.std)) if good.size else (None,) * 4
        out.append(
            {"suffix": f"{r['variant_id']}.b{n:02d}", "variant": r["variant_id"], "mosaic_id": r["mosaic_id"], "source_uri": r["path"], "source_band": n, "dtype": band.dtype.name, "shape": list(band.shape), "masked_pixel_count": count}
            | {"fill_value": fill if count else None, "npy_sha256": hashlib.sha256(payload).hexdigest(), "payload": payload} | dict(zip(("minimum", "maximum", "mean", "std"), numbers, strict=True))
        )
    return out


def _window(r: dict, own: tiff.Tiff, grid: tiff.Tiff) -> np.ndarray:
    """The window on the canonical grid; a raster on another grid is resampled from the part of it that is needed."""
    source, canonical = own.transform(), grid.transform()
    if source is None or canonical is None:
        raise ValueError("the raster has no georeference")
    with storage.reopen(r["path"]) as src:
        if same_grid(source, canonical, (own.height, own.width), (grid.height, grid.width)):
            return tiff.read_window(src, own, r["x"], r["y"], r["w"], r["h"])
        if own.srid() != grid.srid() or any(source[k] or canonical[k] for k in (2, 4)):
            raise ValueError("rasters of one bundle need one CRS and no rotation")
        x0, dx, _, y0, _, dy = canonical
        target = [x0 + r["x"] * dx, dx, 0.0, y0 + r["y"] * dy, 0.0, dy]
        sx, sdx, _, sy, _, sdy = source
        left, right = (int(np.floor((target[0] + k * r["w"] * dx - sx) / sdx)) for k in (0, 1))
        top, bottom = (int(np.floor((target[3] + k * r["h"] * dy - sy) / sdy)) for k in (0, 1))
        cx, cy = max(0, left - 1), max(0, top - 1)
        cw, ch = min(own.width, right + 2) - cx, min(own.height, bottom + 2) - cy
        if cw <= 0 or ch <= 0:
            return np.full((own.count, r["h"], r["w"]), np.nan)
        part = tiff.read_window(src, own, cx, cy, cw, ch)
    method = "nearest" if r["variant_id"].upper() in raster.CATEGORICAL else "bilinear"
    warped = warp(part, [sx + cx * sdx, sdx, 0.0, sy + cy * sdy, 0.0, sdy], target, r["h"], r["w"], method)
    kind = part.dtype
    if kind.kind == "f" or np.isnan(warped).any():  # what the raster does not cover has no number
        return warped.astype(np.float32 if kind.itemsize <= 4 else np.float64)
    return np.rint(warped).astype(kind)


def merge_members(tiles: DataFrame) -> DataFrame:
    """One row per tile: the layers of all kept members in order; of equal variants the first raster's."""
    kept = tiles.where("reason = ''")
    first = Window.partitionBy("tile_id", "variant_id").orderBy("nth")
    kept = kept.withColumn("turn", F.row_number().over(first)).where("turn = 1")
    member = F.struct("nth", "variant_id", "layers", "srid", "transform", "source", "content")
    keys = ["owner", "tile_id", "row_i", "col_i", "x", "y", "w", "h"]
    rows = kept.groupBy(*keys).agg(F.sort_array(F.collect_list(member)).alias("members"))
    rows = rows.withColumns({"layers": F.flatten("members.layers"), "head": F.get("members", F.lit(0))})
    dtypes, shapes = F.array_distinct(F.col("layers.dtype")), F.array_distinct(F.col("layers.shape"))
    return rows.select(
        *keys, "layers", "head.srid", "head.transform", "head.source", "head.content", F.when(F.size(dtypes) == 1, dtypes[0]).otherwise("mixed").alias("dtype"),
        F.when(F.size(shapes) == 1, F.concat(F.array(F.size("layers").cast("long")), shapes[0])).alias("array_shape"),
        F.array_distinct(F.col("layers.mosaic_id")).alias("mosaic_ids"), F.array_distinct(F.col("layers.variant")).alias("variants"),
    )


def tile_record(tile: int, stride: int, bucket: Column) -> Column:
    """The tile's JSON record but for its storage section, which the shard writer adds."""
    t = F.col("transform")
    left, top = t[0], t[3]
    right, bottom = geometry.to_geo([t[i] for i in range(6)], F.col("w"), F.col("h"))
    bounds = F.struct(left.alias("minx"), bottom.alias("miny"), right.alias("maxx"), top.alias("maxy"))
    crs, units = F.concat(F.lit("EPSG:"), F.col("srid").cast("string")), raster.crs_units(F.col("srid"))
    window = F.struct(
        F.col("x").alias("x_off"), F.col("y").alias("y_off"), "w", "h", F.lit(stride).alias("stride_x"), F.lit(stride).alias("stride_y"),
        ((F.col("w") < tile) | (F.col("h") < tile)).alias("is_partial"),
    )
    names = F.transform("layers", lambda x: F.concat(F.col("tile_id"), F.lit("."), x["suffix"], F.lit(".npy")))
    hashes = F.map_from_arrays(F.col("layers.suffix"), F.col("layers.npy_sha256"))
    layers = F.map_from_arrays(
        F.col("layers.suffix"),
        F.transform("layers", lambda x: F.struct(
            F.concat(F.col("tile_id"), F.lit("."), x["suffix"], F.lit(".npy")).alias("member"), x["suffix"].alias("suffix"), x["mosaic_id"].alias("mosaic_id"), x["variant"].alias("variant_token"), x["source_uri"].alias("source_uri"),
            x["source_band"].alias("source_band"), x["dtype"].alias("dtype"), x["shape"].alias("shape"), x["masked_pixel_count"].alias("masked_pixel_count"), x["fill_value"].alias("fill_value"), x["npy_sha256"].alias("npy_sha256"),
        )),
    )
    stats = F.map_from_arrays(F.col("layers.suffix"), F.transform("layers", lambda x: F.struct(x["minimum"].alias("min"), x["maximum"].alias("max"), x["mean"].alias("mean"), x["std"].alias("std"))))
    first, bands = F.get("mosaic_ids", F.lit(0)).alias("mosaic_id"), F.size("layers").alias("bands")
    key, pixel = F.col("tile_id").alias("key"), [t[1].alias("pixel_size_x"), F.abs(t[5]).alias("pixel_size_y"), units.alias("pixel_size_units")]
    record = F.struct(
        F.struct(F.lit(SCHEMA_NAME).alias("name"), F.lit(SCHEMA_VERSION).alias("version")).alias("schema"),
        F.struct("tile_id", key, first).alias("identity"), "tile_id", key, first, F.col("source.source_uri").alias("source_uri"), "row_i", "col_i", window.alias("window"),
        bands, "dtype", crs.alias("crs"), *pixel, bounds.alias("bounds"), "transform", "source",
        F.struct("array_shape", bands, "dtype", names.alias("members"), hashes.alias("member_sha256")).alias("raster"),
        F.struct(crs.alias("crs"), *pixel, "transform", bounds.alias("bounds"), F.struct(((left + right) / 2).alias("x"), ((top + bottom) / 2).alias("y")).alias("centroid"),
                 F.struct(F.lit("Polygon").alias("type"), F.array(F.array(*(F.array(x, y) for x, y in ((left, bottom), (right, bottom), (right, top), (left, top), (left, bottom))))).alias("coordinates")).alias("footprint")).alias("geo"),
        "content", stats.alias("image_stats"), F.struct(hashes.alias("npy_members")).alias("hashes"), layers.alias("layers"), "mosaic_ids", bucket.alias("bucket"),
    )
    return F.to_json(record, {"ignoreNullFields": "false"})


def tile_manifest(tiles: DataFrame, rasters: DataFrame) -> DataFrame:
    """The flat manifest: a row per tile with its shard, window, bounds and pixel size.

    ``tiles`` carry bucket and the path of their shard; ``rasters`` the owner's box, width, height and source_uri.
    """
    rows = tiles.join(rasters, "owner")
    geo = window_geo(tuple(F.col(c) for c in ("minx", "miny", "maxx", "maxy")))
    return rows.select(
        "tile_id", text.file_name(F.col("path")).alias("shard"), "tile_id", "source_uri", F.col("x").alias("x_off"), F.col("y").alias("y_off"), "w", "h",
        F.concat(F.lit("EPSG:"), F.col("srid").cast("string")).alias("crs"), geo["left"].alias("minx"), geo["bottom"].alias("miny"), geo["right"].alias("maxx"), geo["top"].alias("maxy"),
        F.size("layers").alias("bands"), "dtype", "row_i", "col_i", "bucket", F.col("owner").alias("bundle_id"), F.get("mosaic_ids", F.lit(0)).alias("mosaic_id"),
        ((F.col("maxx") - F.col("minx")) / F.col("width")).alias("pixel_size_x"), ((F.col("maxy") - F.col("miny")) / F.col("height")).alias("pixel_size_y"), raster.crs_units(F.col("srid")).alias("pixel_size_units"),
        F.col("path").alias("shard_uri"), F.concat(F.col("path"), F.lit("!/"), "tile_id").alias("tile_uri"), F.concat(F.col("path"), F.lit("!/"), "tile_id", F.lit(".json")).alias("tile_json_uri"),
    ).toDF(*MANIFEST)


@dataclass
class Tiling:
    """What the job leaves: the manifest, label and review rows, counters."""

    manifest: DataFrame
    labels: DataFrame
    review: DataFrame
    counters: DataFrame


def tessellate(
    plan: DataFrame, members: DataFrame, path: str, tile: int, skip_empty: bool = True, shard_size: int = SHARD_SAMPLES, *, stride: int | None = None, masked: bool = False, fill: float | None = None,
    min_content: float = 0.05, semantic: DataFrame | None = None, routed: bool = False, bucket: str = "tiles",
) -> Tiling:
    """Runs the whole job into ``path``. ``members`` also has source_uri, a box, width and height.

    ``semantic`` (tile_id and a struct ``semantic``, see ``labels.label_rows``)
    gives each tile its bucket, ``review`` if it names no target class; without
    it all are in ``bucket``. With ``routed`` shards go to a folder per bucket.
    """
    tiles = written(read_tiles(jobs(plan, members), skip_empty, min_content, masked, fill), "tiles")
    merged = merge_members(tiles)
    if semantic is None:
        merged = merged.withColumns({"semantic": F.lit(None).cast(labels.SEMANTIC), "bucket": F.lit(bucket)})
    else:
        merged = merged.join(semantic.select("tile_id", F.col("semantic").cast(labels.SEMANTIC).alias("semantic")), "tile_id", "left")
        named = F.col("semantic.bucket")
        merged = merged.withColumn("bucket", F.when(labels.is_review(named), labels.REVIEW).otherwise(named))
    merged = merged.withColumn("route", text.safe_bucket(F.col("bucket")) if routed else F.lit(""))
    merged = written(merged, "merged")
    placed = shard_positions(merged.withColumn("place", F.concat_ws("/", "route", "owner")), "place", ["row_i", "col_i"], shard_size)
    # A number per shard without numbering all owners in one place.
    number = F.xxhash64("place", "shard_index").bitwiseAND(F.lit((1 << 62) - 1))
    placed = placed.withColumn("shard", number).withColumn("record", tile_record(tile, stride or tile, F.col("bucket")))
    found = written(shards.write_tile_shards(placed, path, shard_size), "placed")
    owner = F.when(F.col("bundle_id") != "", F.col("bundle_id")).otherwise(F.col("mosaic_id")).alias("owner")
    grids = members.where("mosaic_id = canonical_mosaic_id").select(owner, "source_uri", "minx", "miny", "maxx", "maxy", "width", "height")
    slim = merged.withColumn("layers", F.transform("layers", lambda x: x["suffix"])).join(found, "tile_id")
    rows = labels.label_rows(slim.select("tile_id", text.file_name(F.col("path")).alias("shard"), "bucket", "semantic"))
    label_rows, review = labels.sidecars(rows) if semantic is not None else (rows.limit(0), rows.limit(0))
    failed = F.col("reason").startswith("error")
    counters = tiles.agg(F.count("*").alias("seen"), F.count_if(F.col("reason") == "").alias("written"), F.count_if((F.col("reason") != "") & ~failed).alias("skipped"), F.count_if(failed).alias("errors"))
    return Tiling(tile_manifest(slim, grids), label_rows, review, counters)

"""GeoTIFF files as tables: metadata at three depths, windows, band records, files from tiles."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.functions import geometry, raster
from rasterloom.sources import storage, tiff

#: What a file that cannot be read raises.
UNREADABLE = (OSError, ValueError, KeyError, TypeError, IndexError, OverflowError, struct.error, zlib.error)
# Names that tools give the sample types.
TYPE_NAMES = {"uint8": "Byte", "int8": "Int8", "uint16": "UInt16", "int16": "Int16", "uint32": "UInt32", "int32": "Int32", "uint64": "UInt64", "int64": "Int64", "float32": "Float32", "float64": "Float64"}
DRIVER, DRIVER_NAME = "GTiff", "GeoTIFF"
#: Mask flags: all valid, an alpha or mask band of the whole file, a no-data value.
ALL_VALID, PER_DATASET, BY_NODATA = 1, 2, 8


def write_tiff(array: np.ndarray, transform: list[float] | None, srid: int | None, nodata: float | None = None, layout: tiff.Layout = tiff.Layout(), **more) -> bytes:
    """Bytes of a file with the bands of ``array`` (bands, height, width) and the six affine numbers (x0, dx, rx, y0, ry, dy)."""
    return tiff.encode(array, transform, srid, nodata, layout, **more)


def header(src) -> dict:
    """Size, bands, type, transform, SRID and no-data value; transform and SRID are null where the file has none."""
    return header_of(tiff.parse(src))


def header_of(found: tiff.Tiff) -> dict:
    return {"width": found.width, "height": found.height, "count": found.count, "dtype": found.dtype().name, "transform": found.transform(), "srid": found.srid(), "nodata": found.nodata()}


def write_tiles(tiles: DataFrame, path: str, height: int, width: int, srid: int, dtype: str = "float64", layout: tiff.Layout = tiff.Layout()) -> DataFrame:
    """``tile_id, path`` of one file per tile (tile_id, bands, transform), as written to the shared folder."""
    spark = tiles.sparkSession

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, uris = [], []
            for row in batch.to_pylist():
                array = np.array(row["bands"], dtype=dtype).reshape(-1, height, width)
                uri = f"{path}/files/{row['tile_id']}-{uuid.uuid4().hex}.tif"
                with storage.create(uri) as out:
                    out.write(write_tiff(array, row["transform"], srid, layout=layout))
                ids.append(row["tile_id"])
                uris.append(uri)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(uris)], names=["tile_id", "path"])

    tiles.select("tile_id", "bands", "transform").mapInArrow(write, "tile_id string, path string").write.parquet(f"{path}/index")
    return spark.read.parquet(f"{path}/index")


def _per_file(files: DataFrame, schema: str, arrow: pa.Schema, rows_of: Callable[[object, tiff.Tiff], list[dict]]) -> DataFrame:
    """``rows_of`` (open file, directories) for each of ``files`` (tile_id, path); a file that cannot be read gives one row with its ``error``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                try:
                    with storage.reopen(row["path"]) as src:
                        found = [{**row, **r, "error": None} for r in rows_of(src, tiff.parse(src))]
                except UNREADABLE as failed:
                    found = [{**row, "error": f"{type(failed).__name__}: {failed}"}]
                out += found
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return files.select("tile_id", "path").mapInArrow(read, schema)


_HEADERS = pa.schema(
    [("tile_id", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("count", pa.int32()), ("dtype", pa.string()), ("transform", pa.list_(pa.float64())), ("srid", pa.int32()), ("nodata", pa.float64()), ("error", pa.string())]
)


def read_headers(files: DataFrame) -> DataFrame:
    """Header rows of ``files`` (tile_id, path); a file that cannot be read gives an ``error`` and nulls."""
    schema = "tile_id string, width int, height int, count int, dtype string, transform array<double>, srid int, nodata double, error string"
    return _per_file(files, schema, _HEADERS, lambda src, found: [header_of(found)])


_MAP = pa.map_(pa.string(), pa.string())
_GCP = pa.struct([("id", pa.string()), *((c, pa.float64()) for c in ("pixel", "line", "x", "y", "z"))])
_BAND = pa.struct(
    [("band", pa.int32()), ("dtype", pa.string()), ("block_size", pa.list_(pa.int32())), ("nodata", pa.float64()), ("description", pa.string()), ("unit", pa.string()), ("scale", pa.float64()), ("offset", pa.float64())]
    + [("color_interpretation", pa.string()), ("overview_count", pa.int32()), ("mask_flags", pa.int32()), ("minmax", pa.list_(pa.float64())), ("metadata_domains", pa.map_(pa.string(), _MAP))]
)
_CORE = pa.schema(
    [("tile_id", pa.string()), ("path", pa.string()), ("driver", pa.string()), ("driver_long_name", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("count", pa.int32()), ("srid", pa.int32())]
    + [("transform", pa.list_(pa.float64())), ("dtype", pa.string()), ("dtypes", pa.list_(pa.string())), ("nodata", pa.list_(pa.float64())), ("block_shapes", pa.list_(pa.list_(pa.int32()))), ("overview_counts", pa.list_(pa.int32()))]
    + [("dataset_tags", _MAP), ("image_structure", _MAP), ("subdatasets", _MAP), ("error", pa.string())]
)
_CORE_SQL = (
    "tile_id string, path string, driver string, driver_long_name string, width int, height int, count int, srid int, transform array<double>, dtype string, dtypes array<string>, nodata array<double>, "
    "block_shapes array<array<int>>, overview_counts array<int>, dataset_tags map<string,string>, image_structure map<string,string>, subdatasets map<string,string>, error string"
)
_EXTENDED = pa.schema([*_CORE, ("metadata_domains", pa.map_(pa.string(), _MAP)), ("bands", pa.list_(_BAND)), ("gcps", pa.list_(_GCP)), ("rpc", pa.list_(pa.float64())), ("geolocation", _MAP)])
_EXTENDED_SQL = _CORE_SQL + (
    ", metadata_domains map<string,map<string,string>>, bands array<struct<band:int,dtype:string,block_size:array<int>,nodata:double,description:string,unit:string,scale:double,offset:double,color_interpretation:string,"
    "overview_count:int,mask_flags:int,minmax:array<double>,metadata_domains:map<string,map<string,string>>>>, gcps array<struct<id:string,pixel:double,line:double,x:double,y:double,z:double>>, rpc array<double>, geolocation map<string,string>"
)


def _domains(found: tiff.Tiff, sample: int | None) -> dict[str, dict[str, str]]:
    """Metadata items without a role, by domain ('default' if they name none), of a band or of the file."""
    out: dict[str, dict[str, str]] = {"default": {}}
    for item in found.items():
        if "role" not in item and item.get("sample") == (None if sample is None else str(sample)):
            out.setdefault(item.get("domain") or "default", {})[item.get("name", "")] = item["value"]
    return out


def _core(src, found: tiff.Tiff) -> dict:
    kind, n = TYPE_NAMES[found.dtype().name], found.count
    tags = _domains(found, None)["default"]
    for tag, name in ((tiff.DESCRIPTION, "TIFFTAG_IMAGEDESCRIPTION"), (tiff.SOFTWARE, "TIFFTAG_SOFTWARE"), (tiff.DATETIME, "TIFFTAG_DATETIME")):
        if found.text(tag):
            tags[name] = found.text(tag)
    if found.transform():
        tags["AREA_OR_POINT"] = "Point" if found.geo_keys().get(tiff.RASTER_TYPE_KEY) == tiff.POINT else "Area"
    structure = {"INTERLEAVE": "BAND" if found.apart or n == 1 else "PIXEL"}
    if found.compression() != "NONE":
        structure["COMPRESSION"] = found.compression()
    return {
        "driver": DRIVER, "driver_long_name": DRIVER_NAME, "width": found.width, "height": found.height, "count": n, "srid": found.srid(), "transform": found.transform(), "dtype": kind, "dtypes": [kind] * n,
        "nodata": [found.nodata()] * n, "block_shapes": [list(found.block)] * n, "overview_counts": [found.overviews()] * n, "dataset_tags": list(tags.items()), "image_structure": list(structure.items()), "subdatasets": [],
    }


def _extended(src, found: tiff.Tiff) -> dict:
    roles = {(i.get("sample"), i.get("role")): i["value"] for i in found.items() if "role" in i}
    flags = BY_NODATA if found.nodata() is not None else PER_DATASET if found.masked() else ALL_VALID
    info, bands = header_of(found), []
    for n, color in enumerate(found.colors()):

        def role(name: str, n: int = n) -> str | None:
            return roles.get((str(n), name))

        bands.append(
            {
                "band": n + 1, "dtype": TYPE_NAMES[info["dtype"]], "block_size": list(found.block), "nodata": info["nodata"], "description": role("description") or "", "unit": role("unittype") or "",
                "scale": float(role("scale")) if role("scale") else None, "offset": float(role("offset")) if role("offset") else None, "color_interpretation": color, "overview_count": found.overviews(),
                "mask_flags": flags, "minmax": _extremes(src, found, n + 1), "metadata_domains": [(k, list(v.items())) for k, v in _domains(found, n).items()],
            }
        )
    domains = _domains(found, None)
    return {
        **_core(src, found), "metadata_domains": [(k, list(v.items())) for k, v in domains.items()], "bands": bands, "gcps": found.control_points(),
        "rpc": list(found.tags.get(tiff.RPC, ())), "geolocation": list(domains.get("GEOLOCATION", {}).items()),
    }


def read_metadata(files: DataFrame, mode: str = "core") -> DataFrame:
    """Metadata of ``files`` (tile_id, path), a row each; a file that cannot be read gives its ``error``.

    ``core``: format, size, CRS, transform, types, no-data values, blocks,
    overviews, tags and the footprint in WGS84. ``extended`` (or ``ext``) adds
    metadata domains, a record per band with its extremes, control points,
    rational coefficients and geolocation; pixels are read in strips of rows.
    ``full`` nests the same as ``dataset`` and ``bands``.
    """
    if mode not in ("core", "extended", "ext", "full"):
        raise ValueError(f"unsupported mode: {mode}")
    if mode == "core":
        rows = _per_file(files, _CORE_SQL, _CORE, lambda src, found: [_core(src, found)])
    else:
        rows = _per_file(files, _EXTENDED_SQL, _EXTENDED, lambda src, found: [_extended(src, found)])
    rows = with_footprint(rows.withColumn("crs_wkt", raster.crs_wkt(F.col("srid"))))
    if mode != "full":
        return rows
    dataset = F.struct(
        F.col("path").alias("description"), F.struct(F.col("driver").alias("short_name"), F.col("driver_long_name").alias("long_name")).alias("driver"), F.struct("width", "height", "count").alias("size"),
        F.col("crs_wkt").alias("projection_wkt"), "transform", "metadata_domains", "subdatasets", "image_structure", "rpc", "geolocation", "gcps",
    )
    return rows.select("tile_id", "path", dataset.alias("dataset"), "bands", "error")


def with_footprint(rows: DataFrame) -> DataFrame:
    """Adds ``footprint_status, footprint_wgs84, minx_wgs84, miny_wgs84, maxx_wgs84, maxy_wgs84`` from transform, size and SRID.

    The status is ``ok``, ``no georeference`` or ``unknown CRS``; without ``ok`` the footprint is ''.
    """
    known = geometry.has_wgs84(F.col("srid"))
    status = F.when(F.col("transform").isNull() | F.col("srid").isNull(), "no georeference").when(~known, "unknown CRS").otherwise("ok")
    at = [F.get("transform", F.lit(i)) for i in range(6)]
    ends = F.array(*(F.struct(F.lit(px).alias("px"), F.lit(py).alias("py")) for px, py in ((0, 0), (1, 0), (1, 1), (0, 1))))

    def corner(end: Column) -> Column:
        x, y = geometry.to_geo(at, F.col("width") * end["px"], F.col("height") * end["py"])
        lon, lat = geometry.to_wgs84(F.col("srid"), x, y)
        return F.struct(lon.alias("lon"), lat.alias("lat"))

    rows = rows.withColumn("footprint_status", F.when(F.col("error").isNull(), status))
    good = F.col("footprint_status") == "ok"
    # One array, so that the projection is computed once for each corner.
    found = F.when(good, F.transform(ends, corner))
    text = F.array_join(F.transform(F.concat("__corners", F.slice("__corners", 1, 1)), lambda c: F.format_string("%.8f %.8f", c["lon"], c["lat"])), ",")
    bounds = {f"{name}_wgs84": pick(F.col(f"__corners.{axis}")) for name, pick, axis in (("minx", F.array_min, "lon"), ("miny", F.array_min, "lat"), ("maxx", F.array_max, "lon"), ("maxy", F.array_max, "lat"))}
    footprint = F.when(good, F.concat(F.lit("SRID=4326;POLYGON(("), text, F.lit("))"))).otherwise("")
    return rows.withColumn("__corners", found).withColumns({"footprint_wgs84": footprint, **bounds}).drop("__corners")


def read_windows(windows: DataFrame, fill: float | None = None) -> DataFrame:
    """``tile_id, x, y, shape, dtype, values, masked, error`` of windows (tile_id, path, x, y, w, h, bands).

    ``masked`` counts the pixels that hold the no-data value or no number;
    ``fill`` takes their place if it is given. ``bands`` may be null for all. A
    window that cannot be read gives its ``error``.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                row = {"tile_id": r["tile_id"], "x": r["x"], "y": r["y"]}
                try:
                    with storage.reopen(r["path"]) as src:
                        found = tiff.parse(src)
                        array = tiff.read_window(src, found, r["x"], r["y"], r["w"], r["h"], r["bands"])
                    mask = invalid(array, found.nodata())
                    values = array.astype(float)
                    if fill is not None:
                        values[mask] = fill
                    row |= {"shape": list(array.shape), "dtype": array.dtype.name, "values": values.reshape(-1).tolist(), "masked": int(mask.sum())}
                except UNREADABLE as failed:
                    row |= {"error": f"{type(failed).__name__}: {failed}"}
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=_WINDOWS)

    return windows.select("tile_id", "path", "x", "y", "w", "h", "bands").mapInArrow(read, "tile_id string, x int, y int, shape array<int>, dtype string, values array<double>, masked long, error string")


_WINDOWS = pa.schema(
    [("tile_id", pa.string()), ("x", pa.int32()), ("y", pa.int32()), ("shape", pa.list_(pa.int32())), ("dtype", pa.string()), ("values", pa.list_(pa.float64())), ("masked", pa.int64()), ("error", pa.string())]
)


def invalid(array: np.ndarray, nodata: float | None) -> np.ndarray:
    """Where there is no number or the no-data value."""
    mask = ~np.isfinite(array) if array.dtype.kind == "f" else np.zeros(array.shape, bool)
    return mask | (array == nodata) if nodata is not None and not np.isnan(nodata) else mask


def _extremes(src, found: tiff.Tiff, band: int, rows_at_once: int = 256) -> list[float] | None:
    """Least and greatest valid value of a band, read in strips of rows; null if there is none."""
    low = high = None
    for y in range(0, found.height, rows_at_once):
        part = tiff.read_window(src, found, 0, y, found.width, min(rows_at_once, found.height - y), [band])
        values = part[~invalid(part, found.nodata())]
        if values.size:
            least, most = float(values.min()), float(values.max())
            low, high = (least, most) if low is None else (min(low, least), max(high, most))
    return None if low is None else [low, high]


def read_band_records(files: DataFrame) -> DataFrame:
    """A record per band of ``files`` (tile_id, path): type, block size, no-data value and extremes of the other
    pixels; a file that cannot be read gives one row with its ``error``."""

    def records(src, found: tiff.Tiff) -> list[dict]:
        info, out = header_of(found), []
        for band in range(1, info["count"] + 1):
            low, high = _extremes(src, found, band) or (None, None)
            out.append({"band": band, "dtype": info["dtype"], "block_width": found.block[0], "block_height": found.block[1], "nodata": info["nodata"], "minimum": low, "maximum": high})
        return out

    schema = "tile_id string, band int, dtype string, block_width int, block_height int, nodata double, minimum double, maximum double, error string"
    return _per_file(files, schema, _BAND_RECORDS, records)


_BAND_RECORDS = pa.schema(
    [("tile_id", pa.string()), ("band", pa.int32()), ("dtype", pa.string()), ("block_width", pa.int32()), ("block_height", pa.int32()), ("nodata", pa.float64()), ("minimum", pa.float64()), ("maximum", pa.float64()), ("error", pa.string())]
)

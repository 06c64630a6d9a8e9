"""Rasters on another raster's grid, and tiles put back together."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.sources import storage, tiff


def same_grid(a: list[float], b: list[float], a_shape: tuple[int, int], b_shape: tuple[int, int], eps: float = 1e-9) -> bool:
    return tuple(a_shape) == tuple(b_shape) and all(abs(x - y) <= eps for x, y in zip(a, b, strict=True))


def warp(array: np.ndarray, source: list[float], target: list[float], height: int, width: int, method: str = "bilinear", fill: float = np.nan) -> np.ndarray:
    """(bands, height, width) of ``array`` on the target grid; both grids are north-up (x0, dx, rx, y0, ry, dy) in one CRS.

    Pixel centres outside the source get ``fill``. Equal grids give the array itself.
    """
    if same_grid(source, target, array.shape[1:], (height, width)):
        return array
    x = target[0] + (np.arange(width) + 0.5) * target[1]
    y = target[3] + (np.arange(height) + 0.5) * target[5]
    col, row = (x - source[0]) / source[1] - 0.5, (y - source[3]) / source[5] - 0.5
    n_rows, n_cols = array.shape[1:]
    inside = ((row >= -0.5) & (row < n_rows - 0.5))[:, None] & ((col >= -0.5) & (col < n_cols - 0.5))[None, :]
    if method == "nearest":
        r, c = (np.clip(np.floor(v + 0.5).astype(int), 0, n - 1) for v, n in ((row, n_rows), (col, n_cols)))
        out = array[:, r][:, :, c].astype(float)
    elif method == "bilinear":
        r, c = np.clip(row, 0, n_rows - 1), np.clip(col, 0, n_cols - 1)
        r0, c0 = np.floor(r).astype(int), np.floor(c).astype(int)
        r1, c1 = np.minimum(r0 + 1, n_rows - 1), np.minimum(c0 + 1, n_cols - 1)
        fr, fc = (r - r0)[None, :, None], (c - c0)[None, None, :]
        rows0, rows1 = array[:, r0].astype(float), array[:, r1].astype(float)
        out = (rows0[:, :, c0] * (1 - fc) + rows0[:, :, c1] * fc) * (1 - fr) + (rows1[:, :, c0] * (1 - fc) + rows1[:, :, c1] * fc) * fr
    else:
        raise ValueError(f"unknown resampling {method!r}")
    out[:, ~inside] = fill
    return out


def stitch(tiles: DataFrame, strip_rows: int = 256) -> DataFrame:
    """``mosaic_id, width, height, bands, strip, tiles`` and ``pixels`` (little-endian doubles, band by band) of each strip of each raster.

    ``tiles`` has mosaic_id, x, y, w, h and ``bands`` (array<array<double>>) or, for one band, ``values`` (array<double>). A strip
    holds ``strip_rows`` rows of its raster and is the work of one task, so memory
    grows with a strip. A pixel under several tiles is the later one's in row-major
    order; pixels under no tile are NaN. ``tiles`` counts those that begin in the strip.
    """
    if "bands" not in tiles.columns:
        tiles = tiles.withColumn("bands", F.array("values"))
    size = tiles.groupBy("mosaic_id").agg(
        F.max(F.col("x") + F.col("w")).cast("int").alias("width"), F.max(F.col("y") + F.col("h")).cast("int").alias("height"), F.max(F.size("bands")).alias("n_bands")
    )
    first, last = F.expr(f"cast(y div {strip_rows} as int)"), F.expr(f"cast((y + h - 1) div {strip_rows} as int)")
    every = size.select("mosaic_id", "width", "height", "n_bands", F.explode(F.sequence(F.lit(0), F.expr(f"cast((height - 1) div {strip_rows} as int)"))).alias("strip"))
    parts = tiles.select("mosaic_id", "x", "y", "w", "h", "bands", F.explode(F.sequence(first, last)).alias("strip"))
    rows = every.join(parts, ["mosaic_id", "strip"], "left").select("mosaic_id", "strip", "width", "height", "n_bands", "x", "y", "w", "h", "bands")
    dealt = rows.repartition("mosaic_id", "strip").sortWithinPartitions("mosaic_id", "strip", "y", "x")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None
        canvas, count = None, 0

        def done() -> pa.RecordBatch:
            values = (held["mosaic_id"], held["width"], held["height"], held["n_bands"], held["strip"], count, canvas.astype("<f8").tobytes())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, (_, t) in zip(values, _STRIP, strict=True)], names=[n for n, _ in _STRIP])

        for batch in batches:
            for r in batch.to_pylist():
                if held is None or (r["mosaic_id"], r["strip"]) != (held["mosaic_id"], held["strip"]):
                    if held is not None:
                        yield done()
                    top = r["strip"] * strip_rows
                    held, canvas, count = r, np.full((r["n_bands"], min(strip_rows, r["height"] - top), r["width"]), np.nan), 0
                if r["bands"] is None:
                    continue
                tile, below = np.array(r["bands"], float).reshape(-1, r["h"], r["w"]), max(r["y"], top)
                end = min(r["y"] + r["h"], top + canvas.shape[1])
                canvas[: len(tile), below - top : end - top, r["x"] : r["x"] + r["w"]] = tile[:, below - r["y"] : end - r["y"]]
                count += r["y"] >= top
        if held is not None:
            yield done()

    return dealt.mapInArrow(build, "mosaic_id string, width int, height int, bands int, strip int, tiles long, pixels binary")


_STRIP = [("mosaic_id", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("bands", pa.int32()), ("strip", pa.int32()), ("tiles", pa.int64()), ("pixels", pa.binary())]


def write_stitched(strips: DataFrame, path: str, transform: list[float] | None, srid: int, dtype: str = "float64") -> DataFrame:
    """``mosaic_id, path, width, height, bands, tiles`` of a GeoTIFF file per raster, its strips written one after the other.

    ``transform`` is the same for all, or None if ``strips`` has a column of that
    name. Files beyond 4 GB are BigTIFF. A writer holds one strip at a time.
    """
    spark = strips.sparkSession
    grid = F.array(*(F.lit(v) for v in transform)) if transform else F.col("transform")
    rows = strips.select("mosaic_id", "width", "height", "bands", "strip", "tiles", "pixels", grid.alias("transform"))
    dealt = rows.repartition("mosaic_id").sortWithinPartitions("mosaic_id", "strip")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = (r for b in batches for n in range(b.num_rows) for r in b.slice(n, 1).to_pylist())
        row = next(flat, None)
        while row is not None:
            name, shape, count = row["mosaic_id"], (row["bands"], row["height"], row["width"]), 0
            uri = f"{path}/{name}-{uuid.uuid4().hex}.tif"
            strip_rows = len(row["pixels"]) // (8 * shape[0] * shape[2])
            with storage.create(uri) as out:
                out.write(tiff.strip_head(shape, np.dtype(dtype), strip_rows, row["transform"], srid))
                while row is not None and row["mosaic_id"] == name:
                    out.write(np.frombuffer(row["pixels"], "<f8").astype(np.dtype(dtype).newbyteorder("<")).tobytes())
                    count += row["tiles"]
                    row = next(flat, None)
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((name, uri, shape[2], shape[1], shape[0], count), (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], names=["mosaic_id", "path", "width", "height", "bands", "tiles"])

    dealt.mapInArrow(write, "mosaic_id string, path string, width int, height int, bands int, tiles long").write.parquet(f"{path}/index")
    return spark.read.parquet(f"{path}/index")

"""Tar shards to GeoTIFF files, one status row per member."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.operators import display
from rasterloom.sources import geotiff, shards, storage

SCHEMA = "shard string, tile_id string, member string, path string, status string, error string"


def export_shards(
    spark: SparkSession, paths: list[str], target: str, transform: list[float] | None = None, srid: int | None = None, overwrite: bool = False, stop_on_error: bool = False, form: str = "members"
) -> DataFrame:
    """GeoTIFF files of the tiles in shards, a status row each.

    ``members``: one file per npy member, tagged with its tile, layer, source and
    checksum. ``raw``: one file per tile with all its bands, described by their
    layers. ``display``: one file per tile with three byte bands, stretched. The
    grid is the tile record's own; ``transform`` and ``srid`` stand in where it has
    none. A shard that cannot be read gives an ``error`` row and the others go
    on, unless ``stop_on_error``. Files that exist are ``skipped`` unless
    ``overwrite``. The rows are written to ``target``/status first, so that
    reading them again writes no file again.
    """
    if form not in ("members", "raw", "display"):
        raise ValueError(f"unknown form: {form}")

    def profile(record: dict) -> tuple[list[float] | None, int | None]:
        code = str(record.get("crs") or "").rpartition(":")[2]
        return record.get("transform") or transform, int(code) if code.isdigit() else srid

    def files(record: dict, members: dict[str, bytes]) -> Iterator[tuple[str, str, np.ndarray, dict]]:
        """(member, file name, array, what is written beside it)"""
        layers = {layer["member"]: layer for layer in (record.get("layers") or {}).values()}
        if form == "members":
            for name, raw in members.items():
                layer = layers.get(name, {})
                tags = {"tile_id": record["tile_id"], "member": name, "npy_sha256": hashlib.sha256(raw).hexdigest()}
                tags |= {k: str(layer[k]) for k in ("suffix", "mosaic_id", "variant_token", "source_uri", "source_band") if k in layer}
                yield name, name.removesuffix(".npy"), shards.decode_npy(raw), {"items": tags, "nodata": layer.get("fill_value")}
            return
        bands = np.concatenate([shards.decode_npy(raw) for raw in members.values()])
        tags = {k: str(record[k]) for k in ("tile_id", "mosaic_id", "bucket") if record.get(k)}
        if form == "display":
            yield record["tile_id"], f"{record['tile_id']}_display", display.rgb(bands), {"items": tags}
        else:
            yield record["tile_id"], record["tile_id"], bands, {"items": tags, "descriptions": [layers.get(n, {}).get("suffix", n) for n in members]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                rows = []
                try:
                    with storage.reopen(shard) as src:
                        for record, members in shards.iter_records(src):
                            grid, code = profile(record)
                            for name, file, array, more in files(record, members):
                                uri = f"{target}/files/{file}.tif"
                                if not overwrite and storage.exists(uri):
                                    rows.append((shard, record["tile_id"], name, uri, "skipped", None))
                                    continue
                                with storage.create(uri) as out:
                                    out.write(geotiff.write_tiff(array, grid, code, **more))
                                rows.append((shard, record["tile_id"], name, uri, "written", None))
                except (OSError, KeyError, ValueError, EOFError, shards.tarfile.TarError) as failed:
                    if stop_on_error:
                        raise
                    rows.append((shard, None, None, None, "error", f"{type(failed).__name__}: {failed}"))
                names = [c.split()[0] for c in SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.string())] * 6, names=names)

    listing = spark.createDataFrame([(p,) for p in paths], "shard string").repartition(max(1, len(paths)), "shard")
    status = f"{target}/status-{uuid.uuid4().hex}"
    listing.mapInArrow(run, SCHEMA).write.parquet(status)
    return spark.read.parquet(status)


def identical_members(members: DataFrame) -> DataFrame:
    """Groups of more than one member with the same shape, type and contents."""
    keys = [F.array_join(F.col("shape").cast("array<string>"), "x").alias("shape"), "dtype", "sha256"]
    return members.groupBy(*keys).agg(F.count("*").alias("n"), F.min("member").alias("first_member")).where("n > 1")

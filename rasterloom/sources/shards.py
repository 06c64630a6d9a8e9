"""Tar shards of tiles: ``{tile_id}.{variant}.bNN.npy`` members and one ``{tile_id}.json`` each."""

from __future__ import annotations

import hashlib
import io
import json
import os
import shutil
import tarfile
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.operators.tiling import SHARD_SAMPLES
from rasterloom.sources import storage

#: Free space a shard writer leaves, and how much of what comes in it reserves.
DISK_RESERVE, DISK_FACTOR = 5 << 30, 1.25


def encode_npy(array: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, array, allow_pickle=False)
    return out.getvalue()


def decode_npy(raw: bytes) -> np.ndarray:
    """Two-dimensional arrays become one band."""
    array = np.load(io.BytesIO(raw), allow_pickle=False)
    return array[np.newaxis] if array.ndim == 2 else array


def has_room(path: str, incoming: int) -> bool:
    """Whether the disk that ``path`` is on keeps its reserve; other stores are not asked."""
    if "://" in path and not path.startswith("file:"):
        return True
    where = os.path.abspath(urlparse(path).path if "://" in path else path.removeprefix("file:"))
    while not os.path.exists(where):
        where = os.path.dirname(where)
    return shutil.disk_usage(where).free - int(incoming * DISK_FACTOR) >= DISK_RESERVE


def _add(tar: tarfile.TarFile, name: str, payload: bytes) -> None:
    info = tarfile.TarInfo(name)
    info.size = len(payload)
    tar.addfile(info, io.BytesIO(payload))


def write_shards(tiles: DataFrame, path: str, height: int, width: int, variant: str, shard_size: int = SHARD_SAMPLES) -> DataFrame:
    """``shard, path, samples`` per file. ``tiles`` has tile_id, shard and bands (array<array<double>>).

    Rows of a shard are dealt to one task and stream into its file; a file ends
    after ``shard_size`` samples and the next one begins.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in b.to_pylist())
        row = next(rows, None)
        while row is not None:
            shard, samples = row["shard"], 0
            uri = f"{path}/S{shard:06d}-{uuid.uuid4().hex}.tar"
            with storage.create(uri) as out, tarfile.open(fileobj=out, mode="w|") as tar:
                while row is not None and row["shard"] == shard and samples < shard_size:
                    members = {}
                    for n, values in enumerate(row["bands"], 1):
                        payload = encode_npy(np.array(values, dtype=np.float64).reshape(height, width))
                        if not has_room(path, len(payload)):
                            raise OSError(f"no room left for {uri}")
                        name = f"{row['tile_id']}.{variant}.b{n:02d}.npy"
                        members[name] = hashlib.sha256(payload).hexdigest()
                        _add(tar, name, payload)
                    record = {"tile_id": row["tile_id"], "tile_members": list(members), "hashes": {"npy_members": members}}
                    _add(tar, f"{row['tile_id']}.json", json.dumps(record, sort_keys=True).encode())
                    samples += 1
                    row = next(rows, None)
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([uri]), pa.array([samples], pa.int64())], names=["shard", "path", "samples"])

    dealt = tiles.select("tile_id", F.col("shard").cast("long").alias("shard"), "bands").repartition("shard").sortWithinPartitions("shard", "tile_id")
    return dealt.mapInArrow(write, "shard long, path string, samples long")


def write_tile_shards(tiles: DataFrame, path: str, shard_size: int = SHARD_SAMPLES) -> DataFrame:
    """``tile_id, path`` of the shard each tile is in.

    ``tiles`` has tile_id, shard, route ('' or the folder of a bucket), row_i,
    col_i, ``layers`` (array of structs with suffix and payload) and ``record``
    (JSON). The record gets its storage section here, where the shard's path is known.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in b.to_pylist())
        row = next(rows, None)
        while row is not None:
            place, ids = (row["route"], row["shard"]), []
            folder = f"{path}/{row['route']}" if row["route"] else path
            uri = f"{folder}/S{row['shard']:06d}-{uuid.uuid4().hex}.tar"
            with storage.create(uri) as out, tarfile.open(fileobj=out, mode="w|") as tar:
                while row is not None and (row["route"], row["shard"]) == place and len(ids) < shard_size:
                    if not has_room(path, sum(len(x["payload"]) for x in row["layers"])):
                        raise OSError(f"no room left for {uri}")
                    names = [f"{row['tile_id']}.{x['suffix']}.npy" for x in row["layers"]]
                    for name, layer in zip(names, row["layers"], strict=True):
                        _add(tar, name, layer["payload"])
                    record, json_name = json.loads(row["record"]), f"{row['tile_id']}.json"
                    at = {"shard_uri": uri, "tile_uri": f"{uri}!/{row['tile_id']}", "tile_json_uri": f"{uri}!/{json_name}"}
                    more = {"shard_path": uri.rsplit("/", 1)[-1], "tile_members": names, "tile_member_uris": [f"{uri}!/{n}" for n in names], "tile_json_member": json_name}
                    _add(tar, json_name, json.dumps(record | at | {"tile_members": names, "storage": {**at, **more}}, sort_keys=True).encode())
                    ids.append(row["tile_id"])
                    row = next(rows, None)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([uri] * len(ids))], names=["tile_id", "path"])

    slim = tiles.select("tile_id", "shard", "route", "row_i", "col_i", F.transform("layers", lambda x: F.struct(x["suffix"].alias("suffix"), x["payload"].alias("payload"))).alias("layers"), "record")
    dealt = slim.repartition("route", "shard").sortWithinPartitions("route", "shard", "row_i", "col_i")
    return dealt.mapInArrow(write, "tile_id string, path string")


def iter_records(src) -> Iterator[tuple[dict, dict[str, bytes]]]:
    """(record, members) of each tile of an open tar; a listed member that is missing is an error."""
    held: dict[str, bytes] = {}
    with tarfile.open(fileobj=src, mode="r|") as tar:
        for info in tar:
            raw = tar.extractfile(info).read()
            if not info.name.endswith(".json"):
                held[info.name] = raw
                continue
            record = json.loads(raw)
            names = record.get("tile_members") or [f"{record['tile_id']}.npy"]
            missing = [n for n in names if n not in held]
            if missing:
                raise KeyError(f"{info.name} lists missing members {missing}")
            yield record, {n: held.pop(n) for n in names}


def read_members(spark, paths: list[str]) -> DataFrame:
    """``tile_id, member, band, shape, dtype, sha256, values`` of every member."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["tile_id", "member", "band", "shape", "dtype", "sha256", "values"]
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                with storage.reopen(uri) as src:
                    for record, members in iter_records(src):
                        rows = []
                        for n, (name, raw) in enumerate(members.items(), 1):
                            array = decode_npy(raw)
                            rows.append((record["tile_id"], name, n, list(array.shape), str(array.dtype), hashlib.sha256(raw).hexdigest(), array.reshape(-1).astype(float).tolist()))
                        yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema=_MEMBERS)

    listing = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)), "path")
    return listing.mapInArrow(read, "tile_id string, member string, band int, shape array<int>, dtype string, sha256 string, values array<double>")


_MEMBERS = pa.schema(
    [("tile_id", pa.string()), ("member", pa.string()), ("band", pa.int32()), ("shape", pa.list_(pa.int32())), ("dtype", pa.string()), ("sha256", pa.string()), ("values", pa.list_(pa.float64()))]
)

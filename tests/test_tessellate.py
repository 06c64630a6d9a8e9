"""The tiling job end to end, on small GeoTIFF files."""

import numpy as np
import pytest

from pyspark.sql import functions as F

from rasterloom.operators import display, tessellate, tiling
from rasterloom.sources import geotiff, shards, tiff


def put(path, array, transform):
    path.write_bytes(geotiff.write_tiff(array, transform, 32614))
    return f"file://{path}"


@pytest.fixture()
def rasters(tmp_path):
    rng = np.random.default_rng(1)
    big = rng.integers(10, 200, (3, 8, 12)).astype(np.uint8)
    big[:, :4, :4] = 0  # an empty tile
    coarse = np.arange(24, dtype=np.uint8).reshape(1, 4, 6) * 7 + 20
    rows = [
        ("MA", "B1", "MA", "RGB", put(tmp_path / "a.tif", big, [0.0, 1.0, 0.0, 8.0, 0.0, -1.0]), 12, 8),
        ("MB", "B1", "MA", "MASK", put(tmp_path / "b.tif", coarse, [0.0, 2.0, 0.0, 8.0, 0.0, -2.0]), 6, 4),
        ("MC", "", "MC", "DSM", put(tmp_path / "c.tif", big[:1, :4, :4] + np.arange(16, dtype=np.uint8).reshape(4, 4) * 9, [0.0, 1.0, 0.0, 4.0, 0.0, -1.0]), 4, 4),
        ("MD", "", "MD", "DSM", f"file://{tmp_path}/missing.tif", 4, 4),
    ]
    return big, coarse, rows


def test_tiles_shards_and_manifest(spark, rasters, tmp_path):
    big, coarse, rows = rasters
    data = [(*r, f"uri:{r[0]}", 0.0, 0.0, float(r[5]), float(r[6])) for r in rows]
    members = spark.createDataFrame(data, "mosaic_id string, bundle_id string, canonical_mosaic_id string, variant_id string, path string, width int, height int, source_uri string, minx double, miny double, maxx double, maxy double")
    bundles = members.where("bundle_id <> ''").select("mosaic_id", "bundle_id", "canonical_mosaic_id")
    plan = tiling.canonical_plan(members.select("mosaic_id", "width", "height"), bundles, 4, 4)
    done = tessellate.tessellate(plan, members, f"file://{tmp_path}/out", 4, shard_size=4)
    manifest, c = done.manifest, done.counters.first()
    assert (c.seen, c.errors) == (14, 1) and c.written + c.skipped == 13 and c.skipped == 1
    found = {r.tile_id: r for r in manifest.collect()}
    assert set(found) == {f"T1r{i:04d}c{j:04d}" for i in range(2) for j in range(3)} | {"TCr0000c0000"}
    assert len(manifest.columns) == 26 and found["T1r0001c0002"].bands == 4 and found["T1r0000c0000"].bands == 1
    assert (found["T1r0001c0001"].minx, found["T1r0001c0001"].maxy, found["T1r0001c0001"].pixel_size_units) == (4.0, 4.0, "metre")
    read = {}
    for r in shards.read_members(spark, sorted({r.shard_uri for r in found.values()})).collect():
        read.setdefault(r.tile_id, []).append((r.band, np.array(r.values).reshape(4, 4)))
    tile = [a for _, a in sorted(read["T1r0001c0002"], key=lambda e: e[0])]
    assert (np.stack(tile[:3]) == big[:, 4:8, 8:12]).all()
    assert (tile[3] == np.repeat(np.repeat(coarse[0, 2:4, 4:6], 2, 0), 2, 1)).all()
    assert {r.shard for r in found.values() if r.bundle_id == "B1"} and max(r.row_i for r in found.values()) == 1


def put_members(spark, tmp_path, nodata=None):
    """One 7 by 5 raster of two bands and int16, with 0 as no-data value."""
    array = np.arange(70, dtype=np.int16).reshape(2, 5, 7) * 100
    array[:, :2, :2] = 0
    path = tmp_path / "p.tif"
    path.write_bytes(geotiff.write_tiff(array, [100.0, 2.0, 0.0, 50.0, 0.0, -2.0], 32614, nodata=nodata, layout=tiff.Layout(tile=16, together=True, compress="DEFLATE", predictor=2, big=True, at_end=True)))
    row = ("M1", "", "M1", "DSM", f"file://{path}", 7, 5, "uri:M1", 100.0, 40.0, 114.0, 50.0)
    members = spark.createDataFrame([row], "mosaic_id string, bundle_id string, canonical_mosaic_id string, variant_id string, path string, width int, height int, source_uri string, minx double, miny double, maxx double, maxy double")
    plan = tiling.tile_plan(members.select("mosaic_id", "bundle_id", "width", "height"), 2, 2, drop_partial=False)
    return array, members, plan


def test_partial_windows_native_types_masks_and_records(spark, tmp_path):
    array, members, plan = put_members(spark, tmp_path, nodata=0)
    done = tessellate.tessellate(plan, members, f"file://{tmp_path}/out", 2, skip_empty=False, masked=True, fill=-1.0)
    rows = {r.tile_id: r for r in done.manifest.collect()}
    assert len(rows) == 11 and done.counters.first().skipped == 1  # of 12 the first is fully masked
    last = rows["T1r0002c0003"]
    assert (last.w, last.h, last.dtype, last.bands, last.maxx, last.miny) == (1, 1, "int16", 2, 114.0, 40.0)
    found = {}
    for uri in {r.shard_uri for r in rows.values()}:
        with open(uri.removeprefix("file://"), "rb") as src:
            for record, arrays in shards.iter_records(src):
                found[record["tile_id"]] = (record, {n: shards.decode_npy(a)[0] for n, a in arrays.items()})
    record, arrays = found["T1r0001c0002"]
    assert [a.dtype for a in arrays.values()] == [np.int16, np.int16] and (arrays["T1r0001c0002.DSM.b02.npy"] == array[1, 2:4, 4:6]).all()
    sections = {"schema", "identity", "window", "bounds", "source", "raster", "geo", "content", "image_stats", "hashes", "layers", "storage"}
    assert sections <= set(record) and record["window"] == {"x_off": 4, "y_off": 2, "w": 2, "h": 2, "stride_x": 2, "stride_y": 2, "is_partial": False}
    assert record["raster"]["array_shape"] == [2, 2, 2] and record["geo"]["centroid"] == {"x": 110.0, "y": 44.0} and record["source"]["source_dtypes"] == ["int16", "int16"]
    layer = record["layers"]["DSM.b01"]
    assert (layer["masked_pixel_count"], layer["fill_value"], layer["source_band"]) == (0, None, 1) and record["hashes"]["npy_members"]["DSM.b01"] == layer["npy_sha256"]
    assert record["storage"]["tile_members"] == list(arrays) and found["T1r0002c0003"][0]["window"]["is_partial"]
    assert found["T1r0000c0001"][0]["transform"] == [104.0, 2.0, 0.0, 50.0, 0.0, -2.0]


def test_masked_pixels_are_filled(spark, tmp_path):
    array, members, plan = put_members(spark, tmp_path, nodata=200)
    rows = tessellate.read_tiles(tessellate.jobs(plan, members), skip_empty=False, masked=True, fill=-1.0).where("tile_id = 'T1r0000c0001'").first()
    layer = rows.layers[0]
    assert (layer.masked_pixel_count, layer.fill_value, layer.minimum) == (1, -1.0, 300.0)
    assert shards.decode_npy(bytes(layer.payload))[0].tolist() == [[-1, 300], [900, 1000]]


def test_tiles_are_routed_by_their_labels(spark, tmp_path):
    _, members, plan = put_members(spark, tmp_path)
    ids = [f"T1r{i:04d}c{j:04d}" for i in range(3) for j in range(4)]
    given = [(t, ("roads" if n % 2 else "review", 0.5)) for n, t in enumerate(ids[:8])]
    semantic = spark.createDataFrame(given, "tile_id string, s struct<bucket:string,top_score:double>")
    blank = {c: F.lit(None) for c in ("dominant", "confidence", "confidence_score", "top_class", "second_class", "second_score", "margin", "top_detailed_class", "detail_agrees", "reasons")}
    order = ["bucket", "dominant", "confidence", "confidence_score", "top_class", "top_score", "second_class", "second_score", "margin", "top_detailed_class", "detail_agrees", "reasons"]
    semantic = semantic.select("tile_id", F.struct(*(F.col(f"s.{c}").alias(c) if c in ("bucket", "top_score") else blank[c].alias(c) for c in order)).alias("semantic"))
    done = tessellate.tessellate(plan, members, f"file://{tmp_path}/out", 2, skip_empty=False, semantic=semantic, routed=True)
    rows = done.manifest.collect()
    assert {(r.bucket, r.shard_uri.split("/")[-2]) for r in rows} == {("roads", "roads"), ("review", "review")}
    assert {r.tile_id for r in rows if r.bucket == "roads"} == {t for t, s in given if s[0] == "roads"}
    assert done.labels.count() == 4 and done.review.count() == 8


def test_display_forms():
    bands = np.stack([np.arange(16.0).reshape(4, 4) * k for k in (1, 2, 3, 4)])
    assert display.rgb(bands).shape == (3, 4, 4) and display.rgb(bands[0]).shape == (3, 4, 4)
    with pytest.raises(ValueError):
        display.rgb(bands, (0, 1, 9))
    opaque = np.concatenate([bands[:3], np.full((1, 4, 4), 255.0)])
    assert (display.rgba(opaque)[3] == 255).all()
    assert (display.rgba(np.concatenate([bands[:3], np.ones((1, 4, 4))]))[3] == 255).all()
    with pytest.raises(ValueError):
        display.rgba(bands[:3])
    flat = display.stretch(np.stack([np.full((2, 2), 7.0), np.full((2, 2), -7.0), np.full((2, 2), np.nan)]))
    assert flat.reshape(3, -1).tolist() == [[255] * 4, [0] * 4, [0] * 4]


@pytest.mark.parametrize(
    "array,reason",
    [
        (np.zeros((3, 4, 4)), "low_content"),
        (np.full((3, 4, 4), np.nan), "mostly_invalid"),
        (np.full((3, 4, 4), 100.0), "too_flat_global"),
        (np.full((3, 4, 4), 255.0), "low_content"),
        (np.zeros((3, 0, 0)), "empty_array"),
        (np.random.default_rng(0).uniform(20, 230, (3, 16, 16)), ""),
        (np.random.default_rng(0).uniform(0.1, 0.9, (3, 16, 16)), ""),
        (np.random.default_rng(0).uniform(2000, 60000, (1, 16, 16)), ""),
    ],
)
def test_skip_reasons(array, reason):
    assert display.skip_reason(array) == reason

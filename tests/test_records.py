"""Label and damage rows, numbering, branches, group summaries, stitched and exported files, against plain Python."""

import io
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.operators import bundles, catalog, labels, location, masks, resample, semantic, tessellate, tiling
from rasterloom.operators import pixels as px
from rasterloom.sources import export, geotiff, shards, tiff
from tests.test_tessellate import put_members

DAMAGE = "damage_review/01_likely_damage"


@pytest.fixture(scope="module")
def tiles(spark):
    rows = [
        ("T1", "S1", "k1", "roads", ("roads", "roads", "high", 0.7, "roads", 0.8, "trees", 0.1, 0.7, "paved_road", True, ["real_class_assigned"]), None),
        ("T2", "S1", "k2", "review", None, {"bucket": DAMAGE, "damage_likelihood": 0.9, "damage_label": True, "score": (0.9, None, 0.1, 0.2, 0.3, 0.4, 0.5), "semantic_top_class": "debris", "distance_to_damage_line": 1.5}),
        ("T3", "S1", "k3", None, None, None),
    ]
    fields = [f.split(":")[0] for f in labels.DAMAGE.removeprefix("struct<").split(",score:")[0].split(",")] + ["score"]
    rows = [(*r[:5], None if r[5] is None else tuple(r[5].get(f) for f in fields)) for r in rows]
    return spark.createDataFrame(rows, f"tile_id string, shard string, key string, bucket string, semantic {labels.SEMANTIC}, damage {labels.DAMAGE}")


def by_tile(df):
    return {r.tile_id: r for r in df.collect()}


def test_label_and_review_rows(tiles):
    rows = labels.label_metadata(tiles)
    assert len(rows.columns) == 16
    got = by_tile(rows)
    assert (got["T1"].label, got["T1"].top_detailed_class, got["T1"].detail_agrees, got["T1"].margin) == ("roads", "paved_road", True, 0.7) and "real_class_assigned" in got["T1"].label_json
    assert (got["T3"].label, got["T3"].bucket, got["T3"].confidence, got["T3"].top_score, got["T3"].label_json) == ("", "", "", 0.0, "{}")
    review = labels.review_rows(tiles)
    assert len(review.columns) == 14
    assert (by_tile(review)["T1"].review_reasons, by_tile(review)["T1"].suggested_label, by_tile(review)["T3"].confidence) == ("real_class_assigned", "roads", "review")


def test_damage_rows(tiles):
    routes = labels.damage_routes(tiles)
    assert len(routes.columns) == 19
    got = by_tile(routes)
    assert (got["T2"].bucket, got["T2"].damage_label, got["T2"].damage_likelihood, got["T2"].distance_to_damage_line, got["T2"].review_required) == (DAMAGE, "True", 0.9, "1.5", True)
    assert (got["T3"].bucket, got["T3"].damage_label, got["T3"].semantic_margin) == ("", "", 0.0)
    rows = labels.label_json_rows(tiles)
    assert rows.columns[:4] == ["tile_id", "shard", "key", "bucket"] and rows.columns[-4:] == ["router_version", "geometry_context_distance", "sigma_centerline", "sigma_area"] and len(rows.columns) == 34
    got = by_tile(rows)
    assert (got["T2"].area_intersection_score, got["T2"].area_distance_score, got["T2"].tree_score, got["T1"].has_master_damage_geometry) == (0.9, 0.0, 0.5, False)
    review = by_tile(labels.review_rows_from_damage(tiles))
    assert (review["T2"].bucket, review["T2"].confidence_score, review["T2"].top_class, review["T3"].bucket, review["T3"].confidence) == (DAMAGE, 0.9, "debris", "review", "damage_review")


def test_numbering_of_a_group_of_any_size(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 10 == 0, "b").when(F.col("id") % 97 == 1, None).otherwise("a").alias("g"))
    got = labels.numbered(rows, "g", ["id"]).collect()
    for name in ("a", "b", None):
        assert [r.nth for r in sorted(got, key=lambda r: r.id) if r.g == name] == list(range(sum(r.g == name for r in got)))


def test_branches(spark):
    rows = [
        ("g", "big", 0.0, 0.0, 10.0, 10.0, 100, 100, "", "RGB"), ("g", "in", 1.0, 1.0, 2.0, 2.0, 10, 10, "240101", "RGB"), ("g", "in2", 2.0, 2.0, 3.0, 3.0, 10, 10, "240102", "RGB"),
        ("g", "far", 20.0, 0.0, 21.0, 1.0, 10, 10, "240103", "DSM"), ("h", "one", 0.0, 0.0, 1.0, 1.0, 5, 5, "", "RGB"),
    ]
    members = spark.createDataFrame([(*r, 3, "uint8") for r in rows], "group_id string, mosaic_id string, minx double, miny double, maxx double, maxy double, width int, height int, event_date string, variant_id string, bands int, dtype string")
    got = bundles.branches(members, bundles.greedy_bundles(members, 0.97))
    assert got.columns == bundles.BRANCHES
    found = {r.canonical_mosaic_id: r for r in got.collect()}
    assert set(found) == {"big", "far", "one"} and found["big"].members == "big;in;in2" and found["big"].date == "nodate" and found["far"].date == "240103"
    assert (found["big"].n_mosaics, found["big"].min_canonical_similarity, found["big"].maxx) == (3, 1.0, 10.0) and found["one"].bundle_id.startswith("B")
    assert [r.metamosaic_id for r in got.collect()] == ["g", "g", "h"]


def test_group_summary_with_locations(spark):
    rows = [("g", "b", "/d/2025_06_28_Gary_SD_S2/b.tif", 0.0, 0.0, 2.0, 4.0), ("g", "a", "/d/2025_06_28_Diaz_AR/a.tif", 1.0, 0.0, 4.0, 1.0), ("g", "c", "/d/2025_06_28_Gary_SD_S2/c.tif", 0.0, 0.0, 1.0, 1.0), ("h", "d", "/x/d.tif", 0.0, 0.0, 1.0, 1.0)]
    members = spark.createDataFrame(rows, "g string, mosaic_id string, path string, minx double, miny double, maxx double, maxy double")
    first, second = location.group_summary(members, "g").collect()
    assert (first.members, first.n_mosaics, first.hint_location_name, first.hint_state, first.hint_suffix, first.hint_event_date) == ("a;b;c", 3, "Gary", "SD", "S2", "2025-06-28")
    assert (first.location_source, first.location_kind, first.location_lon, first.location_lat, first.display_name) == ("bbox_center_unresolved", "unknown", 2.0, 2.0, "Gary, SD")
    assert (second.hint_location_name, second.display_name, second.location_lat) == ("", "unknown", 0.5)
    resolved = location.group_summary(members, "g", location.HintResolver()).first()
    assert (resolved.location_name, resolved.location_confidence, resolved.location_warning, resolved.location_kind) == ("Gary", 0.5, "", "folder_hint")


@pytest.mark.parametrize("strip", [1, 3, 64])
def test_stitching_by_strips(spark, tmp_path, strip):
    rng = np.random.default_rng(2)
    rows, want = [], {}
    for name in ("p", "q"):
        canvas = np.full((2, 9, 11), np.nan)
        for y in (0, 4, 6):
            for x in (0, 5):
                tile = rng.integers(0, 99, (2, 3, 6)).astype(float)
                rows.append((name, x, y, 6, 3, tile.reshape(2, -1).tolist()))
                canvas[:, y : y + 3, x : x + 6] = tile
        want[name] = canvas
    random.Random(1).shuffle(rows)
    tiles = spark.createDataFrame(rows, "mosaic_id string, x int, y int, w int, h int, bands array<array<double>>")
    made = resample.write_stitched(resample.stitch(tiles, strip), f"file://{tmp_path}/s", [5.0, 1.0, 0.0, 9.0, 0.0, -1.0], 32614, "float32").collect()
    assert {(r.mosaic_id, r.width, r.height, r.bands, r.tiles) for r in made} == {("p", 11, 9, 2, 6), ("q", 11, 9, 2, 6)}
    for r in made:
        with open(r.path.removeprefix("file://"), "rb") as src:
            found = tiff.parse(src)
            assert found.transform() == [5.0, 1.0, 0.0, 9.0, 0.0, -1.0] and found.block == (11, min(strip, 9)) and found.dtype() == np.float32
            np.testing.assert_array_equal(tiff.read_window(src, found, 0, 0, 11, 9), want[r.mosaic_id].astype(np.float32))


def test_exported_forms(spark, tmp_path):
    array, members, plan = put_members(spark, tmp_path)
    done = tessellate.tessellate(plan, members, f"file://{tmp_path}/out", 2, skip_empty=False)
    paths = sorted({r.shard_uri for r in done.manifest.collect()})

    def read(form, name):
        status = export.export_shards(spark, paths, f"file://{tmp_path}/{form}", form=form).collect()
        assert {r.status for r in status} == {"written"}
        with open(tmp_path / form / "files" / name, "rb") as src:
            found = tiff.parse(src)
            return found, tiff.read_window(src, found, 0, 0, found.width, found.height)

    found, pixels = read("members", "T1r0001c0002.DSM.b02.tif")
    items = {i["name"]: i["value"] for i in found.items()}
    assert (pixels[0] == array[1, 2:4, 4:6]).all() and found.transform() == [108.0, 2.0, 0.0, 46.0, 0.0, -2.0] and found.srid() == 32614
    assert (items["tile_id"], items["suffix"], items["source_band"], items["mosaic_id"]) == ("T1r0001c0002", "DSM.b02", "2", "M1") and len(items["npy_sha256"]) == 64
    found, pixels = read("raw", "T1r0001c0002.tif")
    assert (pixels == array[:, 2:4, 4:6]).all() and [i["value"] for i in found.items() if i.get("role") == "description"] == ["DSM.b01", "DSM.b02"]
    found, pixels = read("display", "T1r0001c0002_display.tif")
    assert pixels.shape == (3, 2, 2) and pixels.dtype == np.uint8
    with pytest.raises(ValueError):
        export.export_shards(spark, paths, f"file://{tmp_path}/x", form="jpeg")


def test_triage_without_a_real_class(spark):
    scores = spark.createDataFrame([(1, "water", 0.9), (2, "roads", 0.6), (2, "trees", 0.3), (2, "water", 0.7), (3, "roads", 0.2)], "image_id long, class string, p double")
    details = spark.createDataFrame([(2, "roads", 0.5), (2, "trees", 0.1), (3, "roads", 0.2)], "image_id long, class string, p double")
    got = {r.image_id: r for r in semantic.decide(scores, details, semantic.threshold_table(spark)).collect()}
    assert (got[1].bucket, got[1].reasons, got[1].top_class, got[1].confidence_score, got[1].accepted) == ("review", ["no_real_class: no evidence"], "review", 0.0, False)
    assert (got[2].bucket, got[2].top_score, got[2].confidence) == ("roads", 0.6, "high")  # what is no target class does not count
    assert got[3].reasons == ["true_edge_low_evidence:0.2000<0.2600"] and got[3].dominant == "roads"


def test_thresholds_of_a_config(spark):
    (row,) = semantic.threshold_table(spark, {"roads": {"min_score": 0.5}}).collect()
    assert tuple(row) == ("roads", 0.5, 0.0, 0.0)


def test_large_prompt_banks_go_in_blocks(spark, monkeypatch):
    images = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(5)], "image_id long, vector array<double>")
    prompts = spark.createDataFrame([(i, f"c{i}", [float(i), 1.0]) for i in range(40)], "prompt_id long, class string, vector array<double>")
    whole = sorted(map(tuple, semantic.prompt_logits(images, prompts).collect()))
    monkeypatch.setattr(semantic, "BROADCAST_ROWS", 7)
    assert sorted(map(tuple, semantic.prompt_logits(images, prompts).collect())) == whole and len(whole) == 200


def test_landcover_counts_every_score_of_an_object(spark):
    rows = [(1, 1, 0.5, "a", 0.8), (1, 1, 0.5, "b", 0.2), (1, 2, 0.25, "a", 0.4), (1, 2, 0.25, "b", 0.6), (1, 3, 0.0001, "b", 1.0)]
    got = {r["class"]: r for r in masks.weighted_landcover(spark.createDataFrame(rows, "tile int, object int, fraction double, class string, score double")).collect()}
    assert (got["a"].assigned_area_fraction, got["b"].assigned_area_fraction) == (0.5, 0.25) and abs(got["a"].weighted - 0.5) < 1e-12 and abs(got["a"].score - 0.5 / 0.75) < 1e-12


def test_crops_and_colors(spark):
    mask = spark.createDataFrame([(1, y, x, 2 if (y, x) in ((2, 2), (2, 3)) else 0) for y in range(5) for x in range(6)], "tile long, py long, px long, object long")
    pixels = mask.select("tile", F.explode(F.array(F.lit(1), F.lit(2))).alias("band"), "py", "px", (F.col("py") * 10 + F.col("px")).cast("double").alias("value"))
    context = masks.object_crops(pixels, mask, 6, 5, "context", 1).where("band = 2").collect()
    assert sorted(r.value for r in context) == [float(10 * y + x) for y in (1, 2, 3) for x in (1, 2, 3, 4)] and {(r.y, r.x) for r in context} == {(y, x) for y in range(3) for x in range(4)}
    cut = masks.object_crops(pixels, mask, 6, 5, "masked", 1).where("band = 1").collect()
    assert sorted(r.value for r in cut if r.value != 128.0) == [22.0, 23.0] and len(cut) == 12
    assert masks.object_crops(pixels, mask, 6, 5).count() == 60
    with pytest.raises(ValueError):
        masks.object_crops(pixels, mask, 6, 5, "round")
    colors = mask.select("object", masks.object_color(F.col("object")).alias("c")).distinct().collect()
    assert {tuple(r.c) for r in colors if r.object == 0} == {(0, 0, 0)} and all(40 <= v < 255 for r in colors if r.object for v in r.c)


@pytest.mark.parametrize("factor", [1, 2, 3])
def test_downsampling_of_any_factor(spark, factor):
    array = np.arange(35.0).reshape(5, 7)
    rows = spark.createDataFrame([(1, 1, y, x, float(array[y, x])) for y in range(5) for x in range(7)], "tile int, band int, py long, px long, value double")
    got = {(r.oy, r.ox): r.value for r in px.downsample(rows, factor, "average").collect()}
    want = {(y // factor, x // factor): array[y : y + factor, x : x + factor].mean() for y in range(0, 5, factor) for x in range(0, 7, factor)}
    assert got == pytest.approx(want)
    near = {(r.oy, r.ox): r.value for r in px.downsample(rows, factor, "nearest").collect()}
    half = factor // 2
    assert near == {(y // factor, x // factor): array[min(y + half, 4), min(x + half, 6)] for y in range(0, 5, factor) for x in range(0, 7, factor)}


def test_requested_columns(spark):
    rows = spark.createDataFrame([("u", "m", 1)], "uri string, mosaic_id string, extra int")
    assert catalog.requested(rows).columns == catalog.MOSAIC_COLUMNS and catalog.requested(rows, catalog.CATALOG_COLUMNS).first()[:3] == ("u", "m", None)
    assert len(catalog.stamped(rows).first().created_at) == 20


def test_the_disk_that_is_written_to_keeps_its_reserve(monkeypatch, tmp_path):
    asked = []
    monkeypatch.setattr(shards.shutil, "disk_usage", lambda where: asked.append(where) or type("U", (), {"free": (5 << 30) + 100})())
    assert shards.has_room(f"file://{tmp_path}/not/yet/there", 80) and not shards.has_room(f"{tmp_path}/not/yet/there", 81)
    assert asked == [str(tmp_path)] * 2 and shards.has_room("s3://bucket/x", 1 << 60)


def test_files_of_strips_match_their_tags(tmp_path):
    head = tiff.strip_head((2, 5, 3), np.dtype("uint16"), 2, None, None)
    pixels = np.arange(30, dtype="<u2").reshape(2, 5, 3)
    body = b"".join(pixels[:, top : top + 2].tobytes() for top in (0, 2, 4))
    src = io.BytesIO(head + body)
    assert (tiff.read_window(src, tiff.parse(src), 0, 0, 3, 5) == pixels).all() and geotiff.header(src)["dtype"] == "uint16"
    assert tiling.SHARD_SAMPLES == 2048

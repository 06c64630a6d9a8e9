"""Properties and hand-made cases of the operators."""

import hashlib
import io
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rasterloom.functions import geometry, scoring, text
from rasterloom.operators import bundles, catalog, components, pixels, semantic, spatial, tiling
from rasterloom.operators.components import connected_components
from rasterloom.session import written
from rasterloom.sources import geotiff, shards


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def brute_components(edges):
    parent = {n: n for e in edges for n in e}
    for a, b in edges:
        ra, rb = find(parent, a), find(parent, b)
        parent[max(ra, rb)] = min(ra, rb)
    return {n: find(parent, n) for n in parent}


@pytest.mark.parametrize("shape", ["path", "star", "random", "empty"])
def test_components(spark, shape):
    rng = random.Random(3)
    edges = {
        "path": [(i, i + 1) for i in range(60)],
        "star": [(500, i) for i in range(80)],
        "random": [(rng.randrange(90), rng.randrange(90)) for _ in range(60)],
        "empty": [],
    }[shape]
    df = spark.createDataFrame(edges, "a long, b long")
    want = {n: r for n, r in brute_components([e for e in edges if e[0] != e[1]]).items()}
    got = {r.node: r.root for r in connected_components(df, "a", "b").collect()}
    assert got == want


@pytest.mark.parametrize("about", [None, 117])
def test_component_rounds_write_few_files(spark, monkeypatch, about):
    conf = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before, counts = {k: spark.conf.get(k) for k in conf}, []

    def counted(df, name):
        table = written(df, name)
        counts.append((table.count(), len(table.inputFiles())))
        return table

    monkeypatch.setattr(components, "written", counted)
    edges = [(i, i + 1) for i in range(0, 120) if i % 40]
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b", about).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == brute_components(edges)
    assert len(counts) > 2 and all(files <= spark.sparkContext.defaultParallelism for _, files in counts[about is None :])
    assert max(n for n, _ in counts) == counts[0][0]


def test_overlap_pairs_equal_brute_force(spark):
    rng = random.Random(5)
    boxes = [(i, x := rng.uniform(-20, 20), y := rng.uniform(-20, 20), x + rng.uniform(0, 6), y + rng.uniform(0, 6)) for i in range(80)]
    boxes += [(100, 0.0, 0.0, 2.5, 2.5), (101, 2.5, 2.5, 5.0, 5.0), (102, None, 0.0, 1.0, 1.0)]
    got = {tuple(r) for r in spatial.overlap_pairs(spark.createDataFrame(boxes, "k long, minx double, miny double, maxx double, maxy double"), "k", 2.5).collect()}
    whole = [b for b in boxes if None not in b]
    want = {(a[0], b[0]) for a in whole for b in whole if a[0] < b[0] and a[1] <= b[3] and b[1] <= a[3] and a[2] <= b[4] and b[2] <= a[4]}
    assert got == want and (100, 101) in got


def test_nearest_without_shapes_gives_nulls(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0)], "point_id long, px double, py double")
    none = spark.createDataFrame([], "line_id long, x1 double, y1 double, x2 double, y2 double")
    assert [tuple(r) for r in spatial.nearest_segments(points, none).collect()] == [(1, None, None)]


@pytest.mark.parametrize("width,height,tile,stride", [(1024, 512, 512, 512), (1000, 700, 256, 256), (100, 100, 256, 128)])
def test_tile_plan_covers_without_overlap(spark, width, height, tile, stride):
    raster = spark.createDataFrame([(width, height)], "width long, height long")
    rows = tiling.tile_plan(raster, tile, stride, drop_partial=False).collect()
    if tile == stride:
        covered = np.zeros((height, width), int)
        for r in rows:
            covered[r.y : r.y + r.h, r.x : r.x + r.w] += 1
        assert (covered == 1).all()
    whole = tiling.tile_plan(raster, tile, stride).collect()
    assert all(r.w == tile and r.h == tile for r in whole)
    assert len(whole) == (max(0, (width - tile) // stride + 1) * max(0, (height - tile) // stride + 1) if width >= tile and height >= tile else 0)


def test_greedy_bundles_hold_their_invariants(spark):
    rng = random.Random(9)
    rows = []
    for i in range(60):
        x, y = rng.uniform(0, 2), rng.uniform(0, 2)
        rows.append((f"g{i % 3}", f"M{i:03d}", x, y, x + rng.uniform(0.5, 3), y + rng.uniform(0.5, 3), rng.choice(["", "240101", "240102"]), 100, 100, "uint8", "RGB", 3))
    # One large raster that holds two small ones apart from each other.
    rows += [("h", "L", 0.0, 0.0, 10.0, 10.0, "", 9, 9, "uint8", "RGB", 3), ("h", "A", 1.0, 1.0, 2.0, 2.0, "", 9, 9, "uint8", "RGB", 3), ("h", "B", 7.0, 7.0, 8.0, 8.0, "", 9, 9, "uint8", "RGB", 3)]
    schema = "group_id string, mosaic_id string, minx double, miny double, maxx double, maxy double, event_date string, width int, height int, dtype string, variant_id string, bands int"
    members = spark.createDataFrame(rows, schema)
    found = bundles.greedy_bundles(members, 0.9).collect()
    by_id = {r[1]: r for r in rows}
    assert sorted(r.mosaic_id for r in found) == sorted(by_id)
    for r in found:
        assert r.similarity >= 0.9
        a, b = by_id[r.mosaic_id][6], by_id[r.canonical_mosaic_id][6]
        assert not a or not b or a == b
    assert {r.canonical_mosaic_id for r in found if r.group_id == "h"} == {"L"}
    for rows in (0, 10):  # all groups over their links, or only the larger ones
        assert sorted(bundles.greedy_bundles(members, 0.9, group_rows=rows).collect()) == sorted(found)
    assert len(bundles.greedy_bundles(members, 0.0).collect()) == len(by_id)


CASES = {
    "site_20240119_DSM.tif": ("DSM", "240119"),
    "site-20240119-rgb.tif": ("RGB", "240119"),
    "SiteDSM2024.tif": ("DSM", "nulldate"),
    "unknown_file.tif": ("NLL", "nulldate"),
    "2024-01-19_denver_x.tif": ("NLL", "240119"),
    "240119_denver_NIR.tif": ("NIR", "240119"),
    "240230_denver.tif": ("NLL", "nulldate"),
    "AreaNDVI_1.tif": ("NDVI", "nulldate"),
}


def test_names(spark):
    df = spark.createDataFrame([(k,) for k in CASES], "path string")
    got = {r.path: (r.v.variant_id, r.d) for r in df.select("path", text.variant(F.col("path")).alias("v"), text.acquisition_date(F.col("path")).alias("d")).collect()}
    assert got == CASES


def test_location_hints(spark):
    want = {
        "/d/2025_06_28_Gary_SD_S2/a.tif": ("2025-06-28", "Gary", "SD", "S2"),
        "/d/2025_03_15_Diaz_AR_Track1/a.tif": ("2025-03-15", "Diaz", "AR", "Track1"),
        "/d/2025_06_28_Clear_Lake/a.tif": ("2025-06-28", "Clear_Lake", "", ""),
        "/d/none/a.tif": ("", "", "", ""),
    }
    df = spark.createDataFrame([(k,) for k in want], "path string").select("path", text.location_hint(F.col("path")).alias("h"))
    assert {r.path: (r.h.event_date, r.h.name, r.h.state, r.h.suffix) for r in df.collect()} == want


def test_short_hash(spark):
    names = ["a.tif", "", "ü.tif", None]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(text.short_hash(F.col("n"))).collect()]
    assert got == [None if n is None else hashlib.blake2b(n.encode(), digest_size=3).hexdigest() for n in names]


def test_safe_buckets(spark):
    want = {"damage_review/01_likely_damage": "damage_review/01_likely_damage", " A b/../C ": "a_b/c", "..": "unknown", "": "unknown", "x//._y_.": "x/y"}
    df = spark.createDataFrame([(k,) for k in want], "b string")
    assert {r[0]: r[1] for r in df.select("b", text.safe_bucket(F.col("b"))).collect()} == want


def test_percentages(spark):
    df = spark.createDataFrame([(50.0,), (12.5,), (100 / 3,)], "v double")
    assert [r[0] for r in df.select(text.percent_text(F.col("v"))).collect()] == ["50", "12.5", "33.3333"]


def test_scores(spark):
    row = spark.range(1).select(
        scoring.gaussian(F.lit(None).cast("double"), 1.0), scoring.gaussian(F.lit(1.0), 0.0), scoring.gaussian(F.lit(1.0), 1.0), scoring.noisy_or(F.lit(0.5), F.lit(0.5)), scoring.clamp01(F.lit(7.0))
    ).first()
    assert row[0] == 0 and row[1] == 0 and abs(row[2] - np.exp(-1)) < 1e-12 and row[3] == 0.75 and row[4] == 1


def test_selection(spark):
    rows = [("M1", "RGB", "a1", "g1"), ("M2", "DSM", "a2", "g1"), ("M3", "RGB", "a3", "g2")]
    df = spark.createDataFrame(rows, "mosaic_id string, variant_id string, alias string, metamosaic_alias string")

    def ids(**wanted):
        return sorted(r.mosaic_id for r in catalog.select_rasters(df, **wanted).collect())

    assert ids(variant_id=["RGB"]) == ["M1", "M3"]
    assert ids(alias=["g1"]) == ["M1", "M2"]
    assert ids(alias=["a3", "g1"], variant_id=["RGB"]) == ["M1", "M3"]
    assert ids(scope={"mosaic_id": ["M2"]}) == ["M2"]
    assert ids(scope={"mosaic_id": ["M2"]}, mosaic_id=["M1"]) == ["M1"]


def test_column_values_needs_the_column(spark):
    with pytest.raises(ValueError):
        catalog.column_values(spark.createDataFrame([("a",)], "x string"), "y")


def test_constant_and_masked_bands(spark):
    rows = [(1, 1, 0, i, 5.0) for i in range(4)] + [(1, 2, 0, i, None) for i in range(4)] + [(1, 3, 0, i, -1.0) for i in range(4)] + [(1, 4, 0, i, float(i)) for i in range(4)]
    df = spark.createDataFrame(rows, "tile long, band int, py int, px int, value double")
    got = {}
    for r in pixels.stretch_u8(df, 0, 100).collect():
        got.setdefault(r.band, []).append(r.u8)
    assert got[1] == [255] * 4 and got[2] == [0] * 4 and got[3] == [0] * 4 and sorted(got[4]) == [0, 85, 170, 255]
    stats = {r.band: r for r in pixels.band_stats(df).collect()}
    assert stats[2].n == 0 and stats[2].mean is None and stats[4].p50 == 1.5


def _one_band(spark, values):
    return spark.createDataFrame([(1, 1, i // 4, i % 4, v) for i, v in enumerate(values)], "tile long, band int, py int, px int, value double")


def _bytes(df, values):
    return {values[r.py * 4 + r.px]: r.u8 for r in df.collect()}


def test_stretch_of_pixels_on_the_edge_of_a_byte(spark):
    """46.878 * 255 / 102.17 is 117; percentiles that are off by their last bit made it 116."""
    values = [82.72, 83.96, 91.42, 95.91, 104.48, 106.1, 108.73, 115.02, 120.08, 123.47, 127.95, 129.97, 139.19, 143.45, 177.38, 188.64]
    assert _bytes(pixels.stretch_u8(_one_band(spark, values)), values)[129.97] == 117


def test_scale_of_pixels_on_the_edge_of_a_byte(spark):
    """Halfway between 76 and 77; the SQL's doubles lie above it."""
    values = [102.58, 108.49, 131.39, 136.29, 105.5, 122.72, 151.9, 101.02, 158.82, 168.22, 164.15, 90.73, 164.93, 81.43, 78.02, 155.27]
    assert _bytes(pixels.scale_u8(_one_band(spark, values)), values)[105.5] == 77


def test_scale_of_a_band_whose_two_lowest_pixels_are_equal(spark):
    """The SQL's lower percentile is then a bit below 6.04, and 83.9 no longer lies in the middle of 144 and 145 but above."""
    import duckdb

    values = [6.04, 6.04, 10.0, 20.0, 30.0, 40.0, 50.0, 60.0, 70.0, 80.0, 83.9, 100.0, 110.0, 120.0, 131.68, 148.48]
    df = _one_band(spark, values)
    want = duckdb.connect().execute("SELECT quantile_cont(v, 0.02), quantile_cont(v, 0.98) FROM (SELECT unnest(?::double[]) AS v)", [values]).fetchone()
    assert tuple(pixels._bounds(df, 2.0, 98.0).select("lo", "hi").first()) == want
    assert _bytes(pixels.scale_u8(df), values)[83.9] == 145


def test_bounds_equal_quantiles_to_the_last_bit(spark):
    import duckdb

    rng = random.Random(5)
    rows = [(tile, 1, 0, i, None if i and rng.random() < 0.1 else round(rng.uniform(-300, 300), 2)) for tile in range(300) for i in range(rng.randint(1, 60))]
    df = spark.createDataFrame(rows, "tile long, band int, py int, px int, value double")
    con = duckdb.connect()
    con.execute("CREATE TABLE p (tile bigint, value double)")
    con.executemany("INSERT INTO p VALUES (?, ?)", [(r[0], r[4]) for r in rows])
    want = con.execute("SELECT tile, quantile_cont(value, 0.02), quantile_cont(value, 0.98), min(value), max(value) FROM p GROUP BY 1 HAVING min(value) < max(value)").fetchall()
    got = {r.tile: (r.lo, r.hi, r.least, r.most) for r in pixels._bounds(df, 2.0, 98.0).collect()}
    assert len(got) == 300 and len(want) > 280
    assert all(got[tile] == tuple(rest) for tile, *rest in want)


def test_bounds_of_equal_values_are_that_value(spark):
    """A fused sum of shares of 110.42 is a bit below it, which would make a constant band look stretched."""
    rows = [(1, b, 0, i, v) for b, v in ((1, 110.42), (2, -110.42)) for i in range(16)] + [(1, 3, 0, i, None) for i in range(16)]
    df = spark.createDataFrame(rows, "tile long, band int, py int, px int, value double")
    got = {r.band: tuple(r)[2:] for r in pixels._bounds(df, 2.0, 98.0).collect()}
    assert got == {1: (110.42,) * 4, 2: (-110.42,) * 4, 3: (None,) * 4}
    for made in (pixels.stretch_u8(df), pixels.scale_u8(df)):
        assert {(r.band, r.u8) for r in made.collect()} == {(1, 255), (2, 0), (3, 0)}


def test_softmax_sums_to_one(spark):
    rows = [(i, f"c{j}", float((i * 7 + j * 3) % 11) * 50) for i in range(20) for j in range(5)]
    p = semantic.softmax(spark.createDataFrame(rows, "image_id long, class string, logit double"))
    assert all(abs(r[1] - 1) < 1e-9 for r in p.groupBy("image_id").agg(F.sum("p")).collect())


def test_coverage_of_degenerate_boxes(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 5.0)], "a double, b double, c double, d double")
    box = tuple(F.col(c) for c in "abcd")
    assert df.select(geometry.coverage(box, box)).first()[0] == 0


def test_unreadable_rasters_are_rows_with_an_error(spark, tmp_path):
    (tmp_path / "bad.tif").write_bytes(b"not a tiff")
    files = spark.createDataFrame([("a", str(tmp_path / "bad.tif")), ("b", str(tmp_path / "none.tif"))], "tile_id string, path string")
    rows = geotiff.read_headers(files).collect()
    assert len(rows) == 2 and all(r.error and r.width is None for r in rows)


def test_shards_rotate_and_miss_no_member(spark, tmp_path):
    tiles = spark.createDataFrame([(f"T{i}", i // 5, [[float(i)] * 4, [1.0] * 4]) for i in range(10)], "tile_id string, shard long, bands array<array<double>>")
    files = shards.write_shards(tiles, f"file://{tmp_path}/s", 2, 2, "RGB", shard_size=3).collect()
    assert sorted(r.samples for r in files) == [2, 2, 3, 3]
    rows = shards.read_members(spark, [r.path for r in files]).collect()
    assert len(rows) == 20 and {r.member for r in rows if r.tile_id == "T7"} == {"T7.RGB.b01.npy", "T7.RGB.b02.npy"}
    assert all(r.values == [float(r.tile_id[1:])] * 4 for r in rows if r.band == 1)

"""TIFF files of other layouts than our own: byte orders, compressions, directories, georeferencing; metadata as rows."""

import io
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rasterloom.functions import geometry, raster
from rasterloom.sources import geotiff, tiff

LAYOUTS = st.builds(tiff.Layout, tile=st.sampled_from([None, 16, 32]), together=st.booleans(), compress=st.sampled_from(["NONE", "DEFLATE"]), big=st.booleans(), at_end=st.booleans())


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 4), st.integers(1, 40), st.integers(1, 40), st.sampled_from(["uint8", "uint16", "float32", "float64", "int16"]), st.sampled_from([4326, 32614]), LAYOUTS, st.data())
def test_round_trip_of_every_layout(bands, height, width, dtype, srid, layout, data):
    array = (np.arange(bands * height * width) * 7 % 250).astype(dtype).reshape(bands, height, width)
    if dtype[0] != "f":
        layout = tiff.Layout(layout.tile, layout.together, layout.compress, data.draw(st.sampled_from([1, 2])), layout.big, layout.at_end)
    src = io.BytesIO(geotiff.write_tiff(array, [10.0, 0.5, 0.0, 20.0, 0.0, -0.5], srid, nodata=-1, layout=layout))
    head, found = geotiff.header(src), tiff.parse(src)
    assert (head["width"], head["height"], head["count"], head["dtype"], head["srid"], head["nodata"]) == (width, height, bands, dtype, srid, -1.0)
    assert head["transform"] == [10.0, 0.5, 0.0, 20.0, 0.0, -0.5]
    assert (tiff.read_window(src, found, 0, 0, width, height) == array).all()
    x, y = data.draw(st.integers(0, width - 1)), data.draw(st.integers(0, height - 1))
    w, h = data.draw(st.integers(1, width - x)), data.draw(st.integers(1, height - y))
    assert (tiff.read_window(src, found, x, y, w, h, [bands]) == array[bands - 1 :, y : y + h, x : x + w]).all()
    for bad in ((0, 0, width + 1, height), (-1, 0, 1, 1), (0, 0, 0, 1)):
        with pytest.raises(ValueError):
            tiff.read_window(src, found, *bad)


def by_hand(tags, blocks, order="<", next_tags=None):
    """A classic file with the directory last; ``tags`` are (tag, type, values), block places filled in for None."""
    codes = {1: "B", 2: "s", 3: "H", 4: "I", 5: "I", 12: "d"}
    mark = b"II" if order == "<" else b"MM"
    body, places = b"", []
    for b in blocks:
        places.append(8 + len(body))
        body += b

    def directory(tags, at, after):
        head, tail = struct.pack(order + "H", len(tags)), b""
        spare = at + 2 + 12 * len(tags) + 4
        for tag, kind, values in sorted(tags):
            values = places if values is None else values
            raw = values if kind == 2 else struct.pack(order + codes[kind] * len(values), *values)
            count = len(raw) if kind == 2 else len(values) // (2 if kind == 5 else 1)
            head += struct.pack(order + "HHI", tag, kind, count)
            if len(raw) <= 4:
                head += raw.ljust(4, b"\0")
            else:
                head += struct.pack(order + "I", spare + len(tail))
                tail += raw
        return head + struct.pack(order + "I", after) + tail

    at = 8 + len(body)
    first = directory(tags, at, 0)
    if next_tags is not None:
        first = directory(tags, at, at + len(first)) + directory(next_tags, at + len(first), 0)
    return mark + struct.pack(order + "HI", 42, at) + body + first


def lzw(raw):
    """A plain encoder, for the decoder's test."""
    out, bits, held = bytearray(), 0, 0

    def put(code, width):
        nonlocal bits, held
        held, bits = held << width | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits & 255)
            held &= (1 << bits) - 1

    table, width, word = {bytes([b]): b for b in range(256)}, 9, b""
    put(256, 9)
    after = 258
    for byte in raw:
        longer = word + bytes([byte])
        if longer in table:
            word = longer
            continue
        put(table[word], width)
        table[longer], after = after, after + 1
        if after == (1 << width) and width < 12:
            width += 1
        if after == 4094:
            put(256, width)
            table, width, after = {bytes([b]): b for b in range(256)}, 9, 258
        word = bytes([byte])
    if word:
        put(table[word], width)
        after += 1
        if after == (1 << width) and width < 12:
            width += 1
    put(257, width)
    if bits:
        out.append(held << (8 - bits) & 255)
    return bytes(out)


@settings(max_examples=60, deadline=None)
@given(st.one_of(st.binary(min_size=1, max_size=400), st.binary(min_size=1, max_size=3).map(lambda b: b * 4000), st.integers(0, 9).map(lambda s: np.random.default_rng(s).integers(0, 256, 9000, np.uint8).tobytes())))
def test_lzw(raw):
    assert tiff.unpack_lzw(lzw(raw)) == raw


def test_pack_bits():
    assert tiff.unpack_bits(bytes([254, 170, 2, 128, 0, 42, 253, 170, 128, 3, 1, 2, 3, 4])) == bytes([170] * 3 + [128, 0, 42] + [170] * 4 + [1, 2, 3, 4])


@pytest.mark.parametrize("order", ["<", ">"])
@pytest.mark.parametrize("code,pack", [(1, bytes), (5, lzw), (8, zlib.compress), (32946, zlib.compress), (32773, lambda raw: b"".join(bytes([0, b]) for b in raw))])
def test_strips_of_other_writers(order, code, pack):
    """Several rows a strip, a short last strip, bands together, both byte orders."""
    array = (np.arange(5 * 3 * 2) * 1001 % 60000).astype(np.uint16).reshape(5, 3, 2)
    strips = [pack(array[r : r + 2].astype(f"{order}u2").tobytes()) for r in (0, 2, 4)]
    tags = [(256, 3, [3]), (257, 3, [5]), (258, 3, [16, 16]), (259, 3, [code]), (262, 3, [1]), (273, 4, None), (277, 3, [2]), (278, 3, [2]), (279, 4, [len(s) for s in strips]), (282, 5, [72, 1]), (284, 3, [1])]
    src = io.BytesIO(by_hand(tags, strips, order))
    found = tiff.parse(src)
    assert (tiff.read_window(src, found, 0, 0, 3, 5) == array.transpose(2, 0, 1)).all()
    assert (tiff.read_window(src, found, 1, 1, 2, 3, [2, 1]) == array.transpose(2, 0, 1)[::-1, 1:4, 1:]).all()
    assert found.transform() is None and found.srid() is None and found.block == (3, 2)


def test_floating_point_predictor():
    array = np.linspace(-3, 9, 12, dtype=np.float32).reshape(3, 4)
    rows = array.astype(">f4").view(np.uint8).reshape(3, 4, 4).transpose(0, 2, 1).reshape(3, 16).astype(int)
    packed = (np.diff(rows, axis=1, prepend=0) % 256).astype(np.uint8).tobytes()
    strip = zlib.compress(packed)
    tags = [(256, 3, [4]), (257, 3, [3]), (258, 3, [32]), (259, 3, [8]), (273, 4, None), (278, 3, [3]), (279, 4, [len(strip)]), (317, 3, [3]), (339, 3, [3])]
    src = io.BytesIO(by_hand(tags, [strip]))
    assert (tiff.read_window(src, tiff.parse(src), 0, 0, 4, 3)[0] == array).all()


PLAIN = [(256, 3, [2]), (257, 3, [2]), (258, 3, [8]), (259, 3, [1]), (273, 4, None), (278, 3, [2]), (279, 4, [4])]
KEYS = (34735, 3, [1, 1, 0, 2, 1025, 0, 1, 2, 3072, 0, 1, 32614])


def test_georeferencing_by_scale_and_tie_point():
    tags = [*PLAIN, (33550, 12, [2.0, 3.0, 0.0]), (33922, 12, [1.0, 1.0, 0.0, 100.0, 200.0, 0.0])]
    assert tiff.parse(io.BytesIO(by_hand(tags, [b"1234"]))).transform() == [98.0, 2.0, 0.0, 203.0, 0.0, -3.0]
    point = tiff.parse(io.BytesIO(by_hand([*tags, KEYS], [b"1234"])))  # for the pixel's centre
    assert point.transform() == [97.0, 2.0, 0.0, 204.5, 0.0, -3.0] and point.srid() == 32614


def test_control_points_overviews_and_masks():
    ties = [v for k in range(3) for v in (k, 2 * k, 0, 10.0 + k, 20.0 + k, 0)]
    small = [(254, 4, [1]), (256, 3, [1]), (257, 3, [1]), (258, 3, [8]), (273, 4, [8]), (279, 4, [1])]
    found = tiff.parse(io.BytesIO(by_hand([*PLAIN, (33922, 12, [float(v) for v in ties])], [b"1234"], next_tags=small)))
    assert found.transform() is None and [(g["pixel"], g["line"], g["x"]) for g in found.control_points()] == [(0, 0, 10), (1, 2, 11), (2, 4, 12)]
    assert found.overviews() == 1 and not found.masked()


@pytest.mark.parametrize("raw", [b"", b"II", b"not a tiff at all", b"II\x2a\0\xff\xff\xff\x7f", by_hand(PLAIN, [b"1234"])[:-20], by_hand(PLAIN[2:], [b"1234"]), b"II\x2a\0\x08\0\0\0\x01\0" + b"\0" * 12 + b"\x08\0\0\0"])
def test_damaged_files_are_errors(raw):
    with pytest.raises(geotiff.UNREADABLE):
        tiff.parse(io.BytesIO(raw))


def test_unsupported_forms_are_errors():
    jpeg = [t if t[0] != 259 else (259, 3, [7]) for t in PLAIN]
    src = io.BytesIO(by_hand(jpeg, [b"1234"]))
    with pytest.raises(ValueError, match="JPEG"):
        tiff.read_window(src, tiff.parse(src), 0, 0, 2, 2)
    bits = [t if t[0] != 258 else (258, 3, [1]) for t in PLAIN]
    with pytest.raises(ValueError, match="not supported"):
        tiff.parse(io.BytesIO(by_hand(bits, [b"1234"]))).dtype()


def put(tmp_path, name, raw):
    (tmp_path / name).write_bytes(raw)
    return f"file://{tmp_path}/{name}"


@pytest.fixture()
def files(spark, tmp_path):
    array = np.arange(96, dtype=np.uint16).reshape(2, 6, 8)
    whole = geotiff.write_tiff(array, [500_000.0, 10.0, 0.0, 4_000_000.0, 0.0, -10.0], 32614, 0, tiff.Layout(tile=16, compress="DEFLATE"), items={"site": "A & B"}, descriptions=["red", "near"])
    paths = [("a", put(tmp_path, "a.tif", whole)), ("b", put(tmp_path, "b.tif", by_hand(PLAIN, [b"1234"]))), ("c", put(tmp_path, "c.tif", b"junk")), ("d", f"file://{tmp_path}/none.tif")]
    other = geotiff.write_tiff(array, [0.0, 1.0, 0.0, 0.0, 0.0, -1.0], 2264)
    return spark.createDataFrame([*paths, ("e", put(tmp_path, "e.tif", other))], "tile_id string, path string")


def test_core_metadata(files):
    rows = {r.tile_id: r for r in geotiff.read_metadata(files).collect()}
    a = rows["a"]
    assert (a.driver, a.width, a.height, a["count"], a.dtype, a.dtypes, a.srid, a.nodata, a.block_shapes) == ("GTiff", 8, 6, 2, "UInt16", ["UInt16"] * 2, 32614, [0.0, 0.0], [[16, 16]] * 2)
    assert a.image_structure == {"INTERLEAVE": "BAND", "COMPRESSION": "DEFLATE"} and a.dataset_tags == {"site": "A & B", "AREA_OR_POINT": "Area"} and a.overview_counts == [0, 0]
    assert "UTM zone 14N" in a.crs_wkt and a.footprint_status == "ok" and a.footprint_wgs84.startswith("SRID=4326;POLYGON((-99.00000000 36.14")
    assert abs(a.minx_wgs84 + 99) < 1e-9 and a.miny_wgs84 < a.maxy_wgs84
    assert rows["b"].footprint_status == "no georeference" and rows["b"].footprint_wgs84 == "" and rows["e"].footprint_status == "unknown CRS"
    assert rows["c"].error and rows["d"].error and rows["c"].width is None and rows["c"].footprint_status is None


def test_extended_and_full_metadata(files):
    a = geotiff.read_metadata(files, "extended").where("tile_id = 'a'").first()
    first, second = a.bands
    assert (first.description, second.description, first.minmax, second.minmax, first.color_interpretation, second.color_interpretation) == ("red", "near", [1.0, 47.0], [48.0, 95.0], "Gray", "Undefined")
    assert (first.mask_flags, first.block_size, first.scale) == (8, [16, 16], None) and a.metadata_domains["default"] == {"site": "A & B"} and a.gcps == []
    full = {r.tile_id: r for r in geotiff.read_metadata(files, "full").collect()}
    assert full["a"].dataset.size.width == 8 and full["a"].dataset.driver.short_name == "GTiff" and full["a"].bands[1].description == "near" and full["c"].error
    with pytest.raises(ValueError):
        geotiff.read_metadata(files, "all")


def test_windows_with_fill_and_errors(files):
    window = files.select("*", F.lit(0).alias("x"), F.lit(0).alias("y"), F.lit(2).alias("w"), F.lit(2).alias("h"), F.lit(None).cast("array<int>").alias("bands"))
    rows = {r.tile_id: r for r in geotiff.read_windows(window, fill=-1.0).collect()}
    assert (rows["a"].shape, rows["a"].dtype, rows["a"].masked, rows["a"].values) == ([2, 2, 2], "uint16", 1, [-1.0, 1.0, 8.0, 9.0, 48.0, 49.0, 56.0, 57.0])
    assert rows["c"].error and rows["d"].error and rows["c"]["values"] is None


def snyder(zone, south, lon, lat):
    """Transverse Mercator by the older series in powers of the longitude difference, with the meridian arc by integration."""
    a, f = 6_378_137.0, 1 / 298.257223563
    e2 = f * (2 - f)
    phi, lam = np.radians(lat), np.radians(lon - (6 * zone - 183))
    t = (np.arange(200_000) + 0.5) / 200_000 * phi
    arc = float((a * (1 - e2) / (1 - e2 * np.sin(t) ** 2) ** 1.5).mean() * phi)
    n, tt, c, k = a / np.sqrt(1 - e2 * np.sin(phi) ** 2), np.tan(phi) ** 2, e2 / (1 - e2) * np.cos(phi) ** 2, np.cos(phi) * lam
    x = n * (k + (1 - tt + c) * k**3 / 6 + (5 - 18 * tt + tt**2 + 72 * c - 58 * e2 / (1 - e2)) * k**5 / 120)
    y = arc + n * np.tan(phi) * (k**2 / 2 + (5 - tt + 9 * c + 4 * c**2) * k**4 / 24 + (61 - 58 * tt + tt**2 + 600 * c - 330 * e2 / (1 - e2)) * k**6 / 720)
    return 500_000 + 0.9996 * x, (10_000_000 if south else 0) + 0.9996 * y


def test_utm_there_and_back(spark):
    places = [(31, False, 2.294481, 48.858370), (14, False, -99.0, 0.0), (56, True, 151.2, -33.9), (33, False, 17.5, 71.0), (1, True, -179.0, -5.0)]
    df = spark.createDataFrame(places, "zone int, south boolean, lon double, lat double")
    east, north = geometry.utm(F.col("zone"), F.col("south"), F.col("lon"), F.col("lat"))
    lon, lat = geometry.from_utm(F.col("zone"), F.col("south"), east, north)
    for r in df.select("*", east.alias("e"), north.alias("n"), lon.alias("l"), lat.alias("p")).collect():
        x, y = snyder(r.zone, r.south, r.lon, r.lat)
        assert abs(r.e - x) < 0.01 and abs(r.n - y) < 0.01 and abs(r.l - r.lon) < 1e-8 and abs(r.p - r.lat) < 1e-8


def test_northing_of_a_parallel(spark):
    """Far out of the zone too; null where the grid has no place of that easting on the parallel."""
    places = [(500_000.0 + m, lat) for m in (0.0, -300_000.0, 293_380.0, 1_025_630.0, 4_000_000.0, 7_000_000.0) for lat in (0.0, 36.15, -36.15)]
    df = spark.createDataFrame([*places, (1_025_630.0, 71.0), (500_000.0, None)], "x double, lat double")
    south = F.col("lat") < 0
    df = df.withColumn("north", geometry.utm_northing(south, F.col("x"), F.col("lat")))
    for r in df.select("*", geometry.from_utm(F.lit(14), south, F.col("x"), F.col("north"))[1].alias("p")).collect():
        assert r.north is None if r.lat is None else abs(r.p - r.lat) < 1e-6
    out = spark.createDataFrame([(7_700_000.0, 36.15), (50_500_000.0, 36.15)], "x double, lat double")
    assert [r[0] for r in out.select(geometry.utm_northing(F.lit(False), F.col("x"), F.col("lat"))).collect()] == [None, None]


def test_core_metadata_of_files_far_from_the_meridian(spark, tmp_path):
    """A row of files at one northing leaves its parallel after 29,337 of them."""
    import duckdb

    from rasterloom.plans import raster_queries
    from tests.oracle import same

    rows = [(i, [i / 1e6] * 64) for i in (0, 29_337, 29_338, 51_281, 102_563, 710_000)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    same(raster_queries.q_metadata_core(spark, str(tmp_path)), con, raster_queries.REGISTRY.oracle_sql()["q_metadata_core"])


def test_wkt_of_unknown_crs_is_empty(spark):
    df = spark.createDataFrame([(4326,), (3857,), (32756,), (2264,), (None,)], "srid int")
    found = [r[0] for r in df.select(raster.crs_wkt(F.col("srid"))).collect()]
    assert found[0].startswith("GEOGCS") and "Pseudo" in found[1] and "56S" in found[2] and "10000000" in found[2] and found[3:] == ["", ""]

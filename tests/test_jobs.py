"""Files, sinks, streams and whole jobs."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom import cli
from rasterloom.operators import catalog, resample
from rasterloom.plans import pipelines
from rasterloom.sources import export, geotiff, inputs, shards, sinks
from rasterloom.streaming import ingest


@pytest.fixture()
def drive(tmp_path):
    names = ["a/20240119_site_RGB.tif", "a/b/240119_x_DSM.TIF", "a/readme.txt", "skip/20240119_site_NIR.tif", "c/20240119_site_RGB.tif"]
    for name in names:
        path = tmp_path / "drive" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(geotiff.write_tiff(np.zeros((1, 2, 3), np.uint8), [0.0, 1.0, 0.0, 0.0, 0.0, -1.0], 4326))
    return tmp_path / "drive"


def test_discovery(spark, drive):
    files = inputs.discover(spark, str(drive), exempt=("skip",))
    assert sorted(r.path.rpartition("/drive/")[2] for r in files.collect()) == ["a/20240119_site_RGB.tif", "a/b/240119_x_DSM.TIF", "c/20240119_site_RGB.tif"]
    assert not inputs.is_empty(files) and inputs.is_empty(inputs.discover(spark, str(drive), suffixes=("jp2",)))
    assert inputs.resolve(spark, f"{drive}/a/*.tif").count() == 1 and inputs.resolve(spark, str(drive)).count() == 4
    (drive / "list.csv").write_text("uri,x\nu1,1\n ,2\nu2,3\n")
    assert sorted(r.uri for r in inputs.resolve(spark, f"{drive}/list.csv").collect()) == ["u1", "u2"]
    (drive / "bad.csv").write_text("x\n1\n")
    with pytest.raises(ValueError):
        inputs.resolve(spark, f"{drive}/bad.csv")


def test_manifest_and_duplicates(spark, drive, tmp_path):
    manifest = pipelines.manifest_of(inputs.discover(spark, str(drive)))
    rows = {r.path.rpartition("/drive/")[2]: r for r in manifest.collect()}
    assert rows["a/b/240119_x_DSM.TIF"].date == "240119" and rows["a/b/240119_x_DSM.TIF"].variant_id == "DSM"
    assert [r.n for r in pipelines.duplicates(manifest).collect()] == [2]
    sinks.write_manifest(manifest, f"{tmp_path}/m")
    assert spark.read.parquet(f"{tmp_path}/m").count() == 4
    with pytest.raises(ValueError):
        sinks.write_manifest(manifest.limit(0), f"{tmp_path}/none")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a"], {"k": 1})], "id int, tags array<string>, m map<string,int>")
    for kind in ("csv", "parquet", "json"):
        sinks.write(df, kind, f"{tmp_path}/{kind}")
        sinks.write(df, kind, f"{tmp_path}/{kind}", append=True)
    assert spark.read.parquet(f"{tmp_path}/parquet").count() == 2 and spark.read.json(f"{tmp_path}/json").count() == 2
    row = inputs.first_row(spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/csv"))
    assert json.loads(row["tags"]) == ["a"]
    sinks.write(df, "noop")
    with pytest.raises(ValueError):
        sinks.write(df, "xml", str(tmp_path))
    sinks.append_jsonl(df, f"{tmp_path}/l")
    sinks.append_jsonl(df, f"{tmp_path}/l")
    assert spark.read.json(f"{tmp_path}/l").count() == 2
    assert inputs.first_row(df.limit(0)) is None


def test_plans_stay_unless_forced(spark, tmp_path):
    def plan(n):
        return spark.createDataFrame([(i, 0, 0, 0, 1, 1) for i in range(n)], "row_i int, col_i int, x int, y int, w int, h int")

    sinks.write_plan(plan(2), f"{tmp_path}/p")
    sinks.write_plan(plan(5), f"{tmp_path}/p")
    assert inputs.read_plan(spark, f"{tmp_path}/p").count() == 2
    sinks.write_plan(plan(5), f"{tmp_path}/p", force=True)
    assert inputs.read_plan(spark, f"{tmp_path}/p").count() == 5
    sinks.fan_out(plan(3), f"{tmp_path}/f", "row_i")
    assert spark.read.parquet(f"{tmp_path}/f").where("row_i = 1").count() == 1


def test_reference_and_layers(spark, tmp_path):
    (tmp_path / "ref.json").write_text('{\n "scope": "metamosaic",\n "line_layer": "x_line"\n}')
    assert inputs.read_reference(spark, f"{tmp_path}/ref.json").first().line_layer == "x_line"
    assert inputs.layer_or_empty(spark, f"{tmp_path}/none", "id int").count() == 0


def test_stream_of_rasters_adds_each_once(spark, drive, tmp_path):
    def run():
        ingest.append_new(ingest.watch_manifest(spark, str(drive)), f"{tmp_path}/table", f"{tmp_path}/check").awaitTermination()
        return spark.read.parquet(f"{tmp_path}/table")

    first = run().count()
    assert first >= 3
    new = drive / "a" / "20240120_new_NDVI.tif"
    new.write_bytes(b"x")
    after = run()
    assert after.count() == first + 1 and after.where("variant_id = 'NDVI'").first().date == "240120"
    assert run().count() == first + 1


def test_late_events_are_left_out(spark, tmp_path):
    def put(name, rows):
        spark.createDataFrame(rows, "t string, event_type string, value double").selectExpr("cast(t as timestamp) ts", "event_type", "value").write.parquet(f"{tmp_path}/in/{name}")

    put("a", [("2024-01-01 00:10:00", "x", 1.0), ("2024-01-01 09:00:00", "x", 1.0)])
    stream = spark.readStream.schema("ts timestamp, event_type string, value double").option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    for n in range(2):
        query = ingest.event_rates(stream).writeStream.outputMode("append").format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
        query.awaitTermination()
        if n == 0:
            put("b", [("2024-01-01 00:20:00", "x", 5.0), ("2024-01-01 14:00:00", "x", 1.0)])
    got = {(str(r.window.start), r.n, r.total) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {("2024-01-01 00:00:00", 1, 1.0), ("2024-01-01 09:00:00", 1, 1.0)}


def test_grouping_job(spark):
    files = spark.createDataFrame([(f"/d/2025_06_28_Gary_SD/240119_s{i}_RGB.tif",) for i in range(5)], "path string")
    manifest = pipelines.manifest_of(files)
    ids = [r.mosaic_id for r in manifest.orderBy("path").collect()]
    boxes = [(0.0, 0.0, 10.0, 10.0), (1.0, 1.0, 2.0, 2.0), (9.5, 9.5, 12.0, 12.0), (50.0, 50.0, 51.0, 51.0)]
    metadata = spark.createDataFrame([(i, *b, 1024, 1024, 3, "uint8") for i, b in zip(ids, boxes)], "mosaic_id string, minx double, miny double, maxx double, maxy double, width int, height int, bands int, dtype string")
    grouping = pipelines.group_rasters(manifest, metadata, threshold=0.9)
    rows = {r.mosaic_id: r for r in grouping.manifest.collect()}
    assert len(rows) == 5 and rows[ids[4]].metamosaic_id == "" and rows[ids[0]].metamosaic_id.startswith("MM_GARY_")
    assert rows[ids[0]].metamosaic_id == rows[ids[2]].metamosaic_id != rows[ids[3]].metamosaic_id
    assert rows[ids[0]].bundle_id == rows[ids[1]].bundle_id != rows[ids[2]].bundle_id
    assert {frozenset((r.mosaic_a, r.mosaic_b)) for r in grouping.intersections.collect()} == {frozenset((ids[0], ids[1])), frozenset((ids[0], ids[2]))}
    plan = pipelines.plan_tiles(grouping).groupBy("mosaic_id").count().collect()
    assert {r.mosaic_id: r["count"] for r in plan} == {ids[0]: 4, ids[2]: 4, ids[3]: 4}


def test_steps_stop_at_the_first_required_failure():
    ran = []

    def fail():
        raise RuntimeError("no")

    steps = [pipelines.Step("a", lambda: ran.append("a")), pipelines.Step("b", fail, required=False), pipelines.Step("c", fail), pipelines.Step("d", lambda: ran.append("d"))]
    code, done = pipelines.run_steps(steps)
    assert code == 1 and ran == ["a"] and [d[0] for d in done] == ["a", "b", "c"]
    assert pipelines.run_steps(steps[:1]) == (0, [("a", "ok")])


def test_command_line(spark, drive, tmp_path):
    assert cli.main([]) == 3 and cli.main(["nothing"]) == 3
    assert cli.main(["ids", str(drive), f"{tmp_path}/m", "--exempt", "skip"]) == 0
    assert spark.read.parquet(f"{tmp_path}/m").count() == 3
    (tmp_path / "empty").mkdir()
    assert cli.main(["ids", str(tmp_path / "empty"), f"{tmp_path}/n"]) == 1
    with pytest.raises(SystemExit):
        cli.main(["tp", "a", "b", "c", "--size", "100"])


def test_exports_skip_what_exists_and_stop_on_request(spark, tmp_path):
    tiles = spark.createDataFrame([("T1", 0, [[1.0] * 4])], "tile_id string, shard long, bands array<array<double>>")
    paths = [r.path for r in shards.write_shards(tiles, f"file://{tmp_path}/s", 2, 2, "RGB").collect()]
    target, grid = f"file://{tmp_path}/t", [0.0, 1.0, 0.0, 0.0, 0.0, -1.0]

    def counts(**how):
        status = export.export_shards(spark, paths + [f"{tmp_path}/none.tar"], target, grid, 4326, **how)
        return {r.status: r["count"] for r in status.groupBy("status").count().collect()}

    assert counts() == {"written": 1, "error": 1}
    assert counts() == {"skipped": 1, "error": 1}
    assert counts(overwrite=True) == {"written": 1, "error": 1}
    with pytest.raises(Exception):
        counts(stop_on_error=True)


def test_warp_onto_another_grid():
    array = np.arange(16, dtype=float).reshape(1, 4, 4)
    source = [0.0, 1.0, 0.0, 4.0, 0.0, -1.0]
    assert resample.warp(array, source, source, 4, 4) is array
    nearest = resample.warp(array, source, [0.0, 2.0, 0.0, 4.0, 0.0, -2.0], 2, 2, "nearest")
    assert nearest.tolist() == [[[5.0, 7.0], [13.0, 15.0]]]
    smooth = resample.warp(array, source, [0.0, 2.0, 0.0, 4.0, 0.0, -2.0], 2, 2)
    assert smooth.tolist() == [[[2.5, 4.5], [10.5, 12.5]]]
    outside = resample.warp(array, source, [10.0, 1.0, 0.0, 4.0, 0.0, -1.0], 2, 2, "nearest", fill=-9.0)
    assert (outside == -9).all()
    with pytest.raises(ValueError):
        resample.warp(array, source, [0.0, 2.0, 0.0, 4.0, 0.0, -2.0], 2, 2, "cubic")


def test_incremental_union(spark):
    old = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    new = spark.createDataFrame([(2, "new"), (3, "new")], "k int, v string")
    assert sorted(map(tuple, catalog.incremental(old, new, "k").collect())) == [(1, "old"), (2, "old"), (3, "new")]
    assert sorted(map(tuple, catalog.incremental(old, new, "k", force=True).collect())) == [(1, "old"), (2, "new"), (3, "new")]


def test_stitched_rasters(spark):
    rows = [("M", 0, 0, 2, 1, [1.0, 2.0]), ("M", 2, 1, 1, 1, [3.0])]
    df = spark.createDataFrame(rows, "mosaic_id string, x int, y int, w int, h int, values array<double>")
    r = resample.stitch(df).first()
    assert (r.height, r.width, r.tiles) == (2, 3, 2)
    got = np.frombuffer(bytes(r.pixels), "<f8").reshape(2, 3)
    assert np.nan_to_num(got, nan=-1).tolist() == [[1.0, 2.0, -1.0], [-1.0, -1.0, 3.0]]
    assert resample.stitch(df.where(F.lit(False))).count() == 0


def test_experiment_grid(spark):
    from rasterloom.plans import experiments

    seen = []

    def run(run_id, setting):
        seen.append((run_id, setting))
        return {"total_written": 4, "out_bytes": 100, "total_seconds": 2.0} if setting["per_band"] else {}

    rows = experiments.run_grid(spark, experiments.TILING_GRID, run).collect()
    assert len(rows) == 16 and [r.run_id for r in rows] == [n for n, _ in seen] and rows[0].run_id == "exp-001" and rows[-1].run_id == "exp-016"
    assert {(r.per_band, r.tiles_per_second, r.bytes_per_tile) for r in rows} == {(True, 2.0, 25.0), (False, 0.0, 0.0)}
    assert all(r.total_seconds >= 0 for r in rows)
    odd = {"tile_size": [0, 256], "stride": [256, 512], "scale": ["percentile", "minmax"], "p_low": [50.0], "p_high": [10.0]}
    kept = experiments.settings(spark, odd).where(experiments.is_valid(F.col("scale"))).collect()
    assert [(r.tile_size, r.stride, r.scale) for r in kept] == [(256, 256, "minmax")]
    assert experiments.run_grid(spark, {**odd, "scale": ["percentile"]}, run).count() == 0
    with experiments.Stopwatch(enabled=False) as watch:
        pass
    assert watch.seconds is None

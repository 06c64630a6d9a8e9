"""Experiments: a grid of settings, a run of each, and a table of results."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The options of the tiling experiment, 16 settings.
TILING_GRID = {
    "tile_size": [256, 512], "stride": [256], "drop_partial": [True], "shard_size": [512], "manifest": ["csv"],
    "dtype": ["uint16", "uint8"], "scale": ["percentile"], "p_low": [5.0], "p_high": [95.0], "per_band": [True, False],
    "stats": ["sample"], "num_samples": [1024, 2048],
}


def settings(spark: SparkSession, options: dict[str, list]) -> DataFrame:
    """Every combination of the options, a column each; the first option varies slowest."""
    rows = spark.range(1).select()
    for name, values in options.items():
        rows = rows.select("*", F.explode(F.array(*(F.lit(v) for v in values))).alias(name))
    return rows


def is_valid(scale: Column | None = None) -> Column:
    """Whether a setting can run: a positive tile, a stride from 1 to the tile, and, where ``scale`` is
    ``percentile`` or not given, 0 <= p_low < p_high <= 100. Nulls are invalid."""
    window = (F.col("tile_size") > 0) & (F.col("stride") > 0) & (F.col("stride") <= F.col("tile_size"))
    bounds = F.coalesce((F.col("p_low") >= 0) & (F.col("p_low") < F.col("p_high")) & (F.col("p_high") <= 100), F.lit(False))
    if scale is not None:
        bounds = bounds | F.coalesce(scale != "percentile", F.lit(True))
    return F.coalesce(window, F.lit(False)) & bounds


def rates(written: Column, seconds: Column, out_bytes: Column) -> list[Column]:
    """``tiles_per_second, bytes_per_tile``; 0 where nothing was written or no time passed, or where either is null."""
    per_second = F.when((written > 0) & (seconds > 0), written / seconds).otherwise(0.0)
    per_tile = F.when(written > 0, F.coalesce(out_bytes, F.lit(0)) / written).otherwise(0.0)
    return [per_second.alias("tiles_per_second"), per_tile.alias("bytes_per_tile")]


class Stopwatch:
    """``with Stopwatch() as watch``: ``watch.seconds`` after the block, also if it fails; None when disabled."""

    def __init__(self, enabled: bool = True) -> None:
        self.enabled = enabled
        self.seconds: float | None = None

    def __enter__(self) -> Stopwatch:
        self._begun = time.perf_counter()
        return self

    def __exit__(self, *failure) -> None:
        if self.enabled:
            self.seconds = time.perf_counter() - self._begun


def run_grid(spark: SparkSession, options: dict[str, list], run: Callable[[str, dict], dict]) -> DataFrame:
    """A row per valid setting: ``run_id`` (``exp-001``, ...), the setting, what its run reports, and ``rates``.

    ``run(run_id, setting)`` is a job of its own, so they go one after another; it
    reports numbers such as ``total_written`` and ``out_bytes``. Where it reports no
    ``total_seconds``, its time is taken. Without a valid setting there is no row.
    """
    usable = settings(spark, options)
    usable = usable.where(is_valid(F.col("scale") if "scale" in options else None))
    done = []
    for n, row in enumerate(usable.collect(), start=1):  # as many rows as the options combine to
        setting, run_id = row.asDict(), f"exp-{n:03d}"
        with Stopwatch() as watch:
            report = run(run_id, setting)
        done.append({"run_id": run_id, **setting, "total_written": 0, "out_bytes": 0, "total_seconds": watch.seconds, **report})
    if not done:
        return usable.limit(0).select(F.lit("").alias("run_id"), "*", F.lit(0.0).alias("tiles_per_second"), F.lit(0.0).alias("bytes_per_tile"))
    names = list(dict.fromkeys(k for d in done for k in d))
    rows = spark.createDataFrame([tuple(d.get(k) for k in names) for d in done], names)
    return rows.select("*", *rates(F.col("total_written"), F.col("total_seconds"), F.col("out_bytes"))).orderBy("run_id")

"""Rasters and label rows that arrive over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rasterloom.functions import text


def watch_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of manifest rows of raster files that appear under a folder; contents are not read."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.{tif,tiff}").option("recursiveFileLookup", True).load(folder)
    path = F.col("path")
    rows = files.select("path", "modificationTime", F.col("length").alias("byte_size"), text.acquisition_date(path).alias("date"), text.variant(path).alias("v"))
    return rows.select("path", "modificationTime", "byte_size", "date", "v.*")


def append_new(stream: DataFrame, table_path: str, checkpoint: str, key: str = "path") -> StreamingQuery:
    """Append rows whose key the table does not hold yet.

    A batch that is replayed after a failure finds its own rows and adds none.
    """

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        fresh = batch.dropDuplicates([key])
        try:
            held = spark.read.schema(batch.schema).parquet(table_path).select(key)
            fresh = fresh.join(held, key, "left_anti")
        except Exception as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
        fresh.write.mode("append").parquet(table_path)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_rates(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events per window and type; what comes later than ``late`` is left out."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))

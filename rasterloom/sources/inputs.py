"""Where rasters come from: folders, globs, tables and reference files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.operators.catalog import rasters

SUFFIXES = ("tif", "tiff")
PLAN_SCHEMA = "row_i int, col_i int, x int, y int, w int, h int"


def discover(spark: SparkSession, path: str, suffixes: tuple[str, ...] = SUFFIXES, exempt: tuple[str, ...] = ()) -> DataFrame:
    """``path, byte_size`` of the raster files under a folder; contents are not read.

    A directory called by an exempt name leaves out what is below it.
    """
    glob = "*.{" + ",".join([*suffixes, *(s.upper() for s in suffixes)]) + "}"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return rasters(files.select("path", F.col("length").alias("byte_size")), suffixes, exempt)


def is_empty(files: DataFrame) -> bool:
    return files.isEmpty()


def resolve(spark: SparkSession, source: str, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """``uri`` rows of a CSV with such a column, of a glob, or of a folder."""
    if source.lower().endswith(".csv"):
        table = spark.read.option("header", True).csv(source)
        if "uri" not in table.columns:
            raise ValueError(f"{source} has no column 'uri'")
        return table.select("uri").where(F.trim("uri") != "")
    if any(c in source for c in "*?["):
        files = spark.read.format("binaryFile").load(source).select("path", F.col("length").alias("byte_size"))
        return rasters(files, suffixes).select(F.col("path").alias("uri"))
    return discover(spark, source, suffixes).select(F.col("path").alias("uri"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, as catalogue tables are untyped on disk."""
    return spark.read.option("header", True).csv(path)


def read_plan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PLAN_SCHEMA).option("header", True).csv(path)


def first_row(table: DataFrame) -> dict | None:
    row = table.first()
    return None if row is None else row.asDict()


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    """A reference file of one JSON object over several lines."""
    return spark.read.option("multiLine", True).json(path)


def layer_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A layer's rows as Parquet, or an empty table where it cannot be read."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)

"""Where catalogue tables go."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("csv", "parquet", "json", "noop")


def write(table: DataFrame, kind: str, path: str | None = None, append: bool = False) -> None:
    """One table to one kind of sink; an unknown kind is an error. Nested values become JSON text in a CSV."""
    if kind not in KINDS:
        raise ValueError(f"unknown sink {kind!r}; one of {', '.join(KINDS)}")
    if kind == "csv":
        nested = {f.name for f in table.schema if f.dataType.typeName() in ("struct", "array", "map")}
        table = table.select(*((F.to_json(c) if c in nested else F.col(c)).alias(c) for c in table.columns))
    writer = table.write.format(kind).mode("append" if append or kind == "noop" else "overwrite")
    if kind == "csv":
        writer = writer.option("header", True).option("escape", "\"")  # quotes are doubled, as other readers expect
    writer.save(path) if path else writer.save()


def write_manifest(manifest: DataFrame, path: str) -> None:
    """An empty manifest is an error: there is nothing to catalogue."""
    if manifest.isEmpty():
        raise ValueError("no rasters found")
    manifest.write.mode("overwrite").parquet(path)


def write_plan(plan: DataFrame, path: str, kind: str = "csv", force: bool = False) -> None:
    """Kept as it is when present, unless forced."""
    columns = ["row_i", "col_i", "x", "y", "w", "h"]
    plan.select(*columns).write.format(kind).option("header", True).mode("overwrite" if force else "ignore").save(path)


def fan_out(table: DataFrame, path: str, *levels: str) -> None:
    """One folder per value of each level, such as metamosaic_id and mosaic_id."""
    table.write.partitionBy(*levels).mode("overwrite").parquet(path)


def append_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)

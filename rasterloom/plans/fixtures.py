"""Reference-shaped views over the driver tables.

Each view is one list of expressions that Spark and DuckDB both accept. Every
view covers its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rasterloom.session import table

_X = "cast((p_partkey * 7919) % 36000 as double) / 100 - 180"
_Y = "cast((p_partkey * 104729) % 18000 as double) / 100 - 90"
_SX = "cast((s_suppkey * 7919) % 36000 as double) / 100 - 180"
_SY = "cast((s_suppkey * 104729) % 18000 as double) / 100 - 90"
_SIDE = "cast(p_size as double) / 20"

#: name: (source table, expressions)
VIEWS: dict[str, tuple[str, list[str]]] = {
    "mosaics": (
        "part",
        [
            "p_partkey as mosaic_key",
            "concat('M', case when p_partkey % 5 = 4 then 'nulldate' else '240119' end, case p_partkey % 6 when 0 then 'DSM' when 1 then 'RGB' when 2 then 'NIR' when 3 then 'ERIK2' when 4 then 'NDVI' else 'NLL' end, cast(p_partkey as string)) as mosaic_id",
            f"{_X} as minx", f"{_Y} as miny", f"{_X} + {_SIDE} as maxx", f"{_Y} + {_SIDE} as maxy",
            "512 + (p_partkey * 37) % 2048 as width", "512 + (p_partkey * 53) % 2048 as height",
            "1 + p_partkey % 4 as bands",
            "case p_partkey % 3 when 0 then 'uint8' when 1 then 'uint16' else 'float32' end as dtype",
            "case p_partkey % 6 when 0 then 'DSM' when 1 then 'RGB' when 2 then 'NIR' when 3 then 'ERIK2' when 4 then 'NDVI' else 'NLL' end as variant_id",
            "case when p_partkey % 7 = 0 then '' else concat('2401', cast(10 + p_partkey % 3 as string)) end as event_date",
        ],
    ),
    "manifest": (
        "part",
        [
            "p_partkey as mosaic_key",
            "concat('/drive/2025_', lpad(cast(1 + p_partkey % 12 as string), 2, '0'), '_', lpad(cast(1 + p_partkey % 28 as string), 2, '0'), '_Site', cast(p_partkey % 50 as string), case p_partkey % 4 when 0 then '_SD_S1' when 1 then '_AR_Track2' when 2 then '_SD' else '' end, '/', case p_partkey % 5 when 0 then '20240119' when 1 then '2024-01-19' when 2 then '240230' when 3 then '240119' else 'x' end, '_site_', case p_partkey % 6 when 0 then 'DSM' when 1 then 'rgb' when 2 then 'NIR' when 3 then 'ERIK2' when 4 then 'AreaNDVI' else 'ortho' end, '_n', cast(p_partkey as string), case when p_partkey % 11 = 0 then '.xml' else '.tif' end) as path",
            "p_partkey * 1000 + p_size as byte_size",
            "p_name as label",
        ],
    ),
    "segments": ("supplier", ["s_suppkey as line_id", f"{_SX} as x1", f"{_SY} as y1", f"{_SX} + 3 as x2", f"{_SY} + cast(3 as double) / 2 as y2"]),
    "areas": ("supplier", ["s_suppkey as area_id", f"{_SX} as minx", f"{_SY} as miny", f"{_SX} + 2 as maxx", f"{_SY} + 1 as maxy"]),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, expressions = VIEWS[name]
    return table(spark, sf_dir, source).selectExpr(*expressions)


def with_views(*names: str) -> str:
    """``WITH`` clause that defines the views for the checking SQL."""
    parts = [f"{n} AS (SELECT {', '.join(VIEWS[n][1])} FROM {VIEWS[n][0]})" for n in names]
    return "WITH " + ",\n".join(parts)


PIXELS_SQL = """pixels AS (
  SELECT vec_id AS tile, pos // 16 + 1 AS band, (pos % 16) // 4 AS py, pos % 4 AS px, value::double AS value
  FROM (SELECT vec_id, unnest(range(0, len(embedding))) AS pos, unnest(embedding) AS value FROM embeddings)
)"""


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tile per embedding: four bands of 4 x 4."""
    flat = table(spark, sf_dir, "embeddings").selectExpr("vec_id AS tile", "posexplode(embedding) AS (pos, raw)")
    return flat.selectExpr("tile", "pos div 16 + 1 AS band", "(pos % 16) div 4 AS py", "cast(pos % 4 AS bigint) AS px", "cast(raw AS double) AS value")

"""Raster conventions: layouts, bands, resampling, units and tool arguments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: More planes than this are rows or columns, not bands.
MAX_BANDS = 16
# Products whose values are codes, not measurements.
CATEGORICAL = ("CLASS", "MASK", "LABEL")
# SRID ranges and the linear unit of their axes (low, high, unit).
UNITS = [(4000, 4999, "degrees"), (3857, 3857, "metre"), (32601, 32660, "metre"), (32701, 32760, "metre"), (26901, 26923, "metre"), (2225, 2289, "US survey foot")]


def layout(first: Column, last: Column) -> Column:
    """``chw`` or ``hwc`` of a three-dimensional shape by which end can be bands; '' if neither can."""
    return F.when(first <= MAX_BANDS, "chw").when(last <= MAX_BANDS, "hwc").otherwise("")


def resampling(variant: Column) -> Column:
    """Nearest for codes, bilinear for measurements."""
    return F.when(F.upper(variant).isin(*CATEGORICAL), "nearest").otherwise("bilinear")


def display_bands(count: Column, wanted: tuple[int, ...] = (0, 1, 2)) -> Column:
    """Zero-based bands to show, clamped to those there are."""
    return F.array(*(F.least(F.lit(b), count - 1).cast("int") for b in wanted))


def crs_units(srid: Column) -> Column:
    """Unit of the axes, ``map_units`` where it is not known."""
    unit = F.lit("map_units")
    for low, high, name in UNITS:
        unit = F.when(srid.between(low, high), name).otherwise(unit)
    return unit


# WKT of the CRS that footprints know.
_WGS84 = 'GEOGCS["WGS 84",DATUM["WGS_1984",SPHEROID["WGS 84",6378137,298.257223563]],PRIMEM["Greenwich",0],UNIT["degree",0.0174532925199433],AUTHORITY["EPSG","4326"]]'
_METRE = 'UNIT["metre",1],AXIS["Easting",EAST],AXIS["Northing",NORTH]'


def crs_wkt(srid: Column) -> Column:
    """WKT of WGS84, Web Mercator and the UTM zones; '' for any other."""
    mercator = f'PROJCS["WGS 84 / Pseudo-Mercator",{_WGS84},PROJECTION["Mercator_1SP"],PARAMETER["central_meridian",0],PARAMETER["scale_factor",1],{_METRE},AUTHORITY["EPSG","3857"]]'
    zone, south = srid % 100, srid >= 32700
    grid = F.concat(
        F.lit('PROJCS["WGS 84 / UTM zone '), zone.cast("string"), F.when(south, "S").otherwise("N"), F.lit(f'",{_WGS84},PROJECTION["Transverse_Mercator"],PARAMETER["latitude_of_origin",0],PARAMETER["central_meridian",'),
        (zone * 6 - 183).cast("string"), F.lit('],PARAMETER["scale_factor",0.9996],PARAMETER["false_easting",500000],PARAMETER["false_northing",'), F.when(south, "10000000").otherwise("0"),
        F.lit(f'],{_METRE},AUTHORITY["EPSG","'), srid.cast("string"), F.lit('"]]'),
    )
    in_zone = srid.between(32601, 32660) | srid.between(32701, 32760)
    return F.when(srid == 4326, _WGS84).when(srid == 3857, mercator).when(in_zone, grid).otherwise("")


def alpha(value: Column, least: Column, most: Column) -> Column:
    """Alpha is kept as it is; a constant one is opaque."""
    return F.when(least == most, 255).otherwise(value.cast("int"))


def mask_value(value: Column, largest: Column, instances: bool) -> Column:
    """Binary masks are 0 or 255; instance masks keep their numbers."""
    return value.cast("long") if instances else F.when(value > 0, 255).otherwise(0).cast("long")


def translate_command(source: Column, target: Column, size_args: Column, resample: str, compress: str | None = None, tiled: bool = True, low: Column | None = None, high: Column | None = None) -> Column:
    """Arguments that make a browse raster, blank-separated; with a display range also the scale to bytes."""
    parts = [F.lit("gdal_translate -of GTiff"), size_args, F.lit(f"-r {resample}")]
    if low is not None and high is not None:
        parts.append(F.concat(F.lit("-ot Byte -scale "), low.cast("string"), F.lit(" "), high.cast("string"), F.lit(" 0 255")))
    if compress:
        parts.append(F.lit(f"-co COMPRESS={compress}"))
    if tiled:
        parts.append(F.lit("-co TILED=YES"))
    return F.concat_ws(" ", *parts, source, target)


def browse_path(path: Column) -> Column:
    """Where a raster's browse copy goes, always with an extension."""
    return F.concat(F.regexp_replace(path, r"(\.[^./]*)?$", ""), F.lit("_browse.tif"))


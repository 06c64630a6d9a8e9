"""Planar and geographic expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0


def width(minx: Column, maxx: Column) -> Column:
    return F.greatest(maxx - minx, F.lit(0.0))


def area(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    return width(minx, maxx) * width(miny, maxy)


def intersects(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Closed boxes (minx, miny, maxx, maxy): touching counts."""
    return (a[0] <= b[2]) & (b[0] <= a[2]) & (a[1] <= b[3]) & (b[1] <= a[3])


def point_in_box(x: Column, y: Column, box: tuple[Column | float, ...]) -> Column:
    """Whether a point lies in a closed box (minx, miny, maxx, maxy): its sides count."""
    return x.between(box[0], box[2]) & y.between(box[1], box[3])


def intersection_area(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    return area(F.greatest(a[0], b[0]), F.greatest(a[1], b[1]), F.least(a[2], b[2]), F.least(a[3], b[3]))


def coverage(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Intersection over the smaller area, at most 1; 0 for a degenerate box."""
    smaller = F.least(area(*a), area(*b))
    return F.when(smaller > 0, F.least(intersection_area(a, b) / smaller, F.lit(1.0))).otherwise(0.0)


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    half_lat, half_lon = F.sin(F.radians(lat2 - lat1) / 2), F.sin(F.radians(lon2 - lon1) / 2)
    h = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return 2 * EARTH_RADIUS_M * F.atan2(F.sqrt(h), F.sqrt(1 - h))


def to_geo(transform: list[Column], px: Column, py: Column) -> tuple[Column, Column]:
    """Pixel to map coordinates by the six affine numbers (x0, dx, rx, y0, ry, dy)."""
    x0, dx, rx, y0, ry, dy = transform
    return x0 + px * dx + py * rx, y0 + px * ry + py * dy


def footprint_ewkt(minx: Column, miny: Column, maxx: Column, maxy: Column, srid: int = 4326) -> Column:
    """Closed ring from the lower left, eight decimals."""
    ring = [(minx, miny), (maxx, miny), (maxx, maxy), (minx, maxy), (minx, miny)]
    text = F.concat_ws(", ", *(F.format_string("%.8f %.8f", x, y) for x, y in ring))
    return F.concat(F.lit(f"SRID={srid};POLYGON(("), text, F.lit("))"))


def footprint_geojson(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    ring = [(minx, miny), (maxx, miny), (maxx, maxy), (minx, maxy), (minx, miny)]
    return F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(F.array(*(F.array(x, y) for x, y in ring))).alias("coordinates")))


def segment_distance(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance to the nearest point of a segment by clamped projection."""
    dx, dy = x2 - x1, y2 - y1
    length = dx * dx + dy * dy
    t = F.when(length > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - x1) * dx + (py - y1) * dy) / length))).otherwise(0.0)
    return F.sqrt(F.pow(px - (x1 + t * dx), F.lit(2.0)) + F.pow(py - (y1 + t * dy), F.lit(2.0)))


def box_distance(px: Column, py: Column, minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """0 inside."""
    dx = F.greatest(minx - px, px - maxx, F.lit(0.0))
    dy = F.greatest(miny - py, py - maxy, F.lit(0.0))
    return F.sqrt(dx * dx + dy * dy)


def web_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    radius = 6_378_137.0
    return F.radians(lon) * radius, F.log(F.tan(F.radians(lat) / 2 + F.lit(0.7853981633974483))) * radius


def from_web_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    radius = 6_378_137.0
    return F.degrees(x / radius), F.degrees(2 * F.atan(F.exp(y / radius)) - F.lit(1.5707963267948966))


# WGS84 ellipsoid, UTM scale and offsets.
_A, _FLATTENING, _SCALE, _FALSE_EAST, _FALSE_NORTH = 6_378_137.0, 1 / 298.257223563, 0.9996, 500_000.0, 10_000_000.0


def _krueger() -> tuple[float, list[float], list[float], list[float]]:
    """Rectifying radius and the series of the transverse Mercator projection: forward, inverse, conformal to geodetic latitude."""
    n = _FLATTENING / (2 - _FLATTENING)
    radius = _A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]
    beta = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480]
    delta = [2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15]
    return radius, alpha, beta, delta


def _meridian(zone: Column) -> Column:
    return F.radians(zone * 6 - 183)


def _with(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often it is used; keeps generated code small."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def utm(zone: Column, south: Column, lon: Column, lat: Column) -> tuple[Column, Column]:
    """Easting and northing in metres of a zone (1 to 60), by Krueger's series to the third order."""
    radius, alpha, _, _ = _krueger()
    n = _FLATTENING / (2 - _FLATTENING)
    c = 2 * n**0.5 / (1 + n)

    def sphere(v: Column) -> Column:
        t = F.sinh(F.atanh(F.sin(v["phi"])) - F.lit(c) * F.atanh(F.lit(c) * F.sin(v["phi"])))
        return _with(t, lambda t: F.struct(F.atan2(t, F.cos(v["lam"])).alias("xi"), F.atanh(F.sin(v["lam"]) / F.sqrt(1 + t * t)).alias("eta")))

    def plane(v: Column) -> Column:
        north, east = v["xi"], v["eta"]
        for k, a in enumerate(alpha, 1):
            north = north + F.lit(a) * F.sin(2 * k * v["xi"]) * F.cosh(2 * k * v["eta"])
            east = east + F.lit(a) * F.cos(2 * k * v["xi"]) * F.sinh(2 * k * v["eta"])
        return F.struct(east.alias("east"), north.alias("north"))

    place = F.struct(F.radians(lat).alias("phi"), (F.radians(lon) - _meridian(zone)).alias("lam"))
    found = _with(_with(place, sphere), plane)
    return F.lit(_FALSE_EAST) + found["east"] * (_SCALE * radius), F.when(south, _FALSE_NORTH).otherwise(0.0) + found["north"] * (_SCALE * radius)


def from_utm(zone: Column, south: Column, x: Column, y: Column) -> tuple[Column, Column]:
    """Longitude and latitude of a place in a zone."""
    radius, _, beta, delta = _krueger()

    def sphere(v: Column) -> Column:
        xi, eta = v["xi"], v["eta"]
        for k, b in enumerate(beta, 1):
            xi = xi - F.lit(b) * F.sin(2 * k * v["xi"]) * F.cosh(2 * k * v["eta"])
            eta = eta - F.lit(b) * F.cos(2 * k * v["xi"]) * F.sinh(2 * k * v["eta"])
        return F.struct(xi.alias("xi"), eta.alias("eta"))

    def conformal(v: Column) -> Column:
        return F.struct(F.atan2(F.sinh(v["eta"]), F.cos(v["xi"])).alias("lam"), F.asin(F.sin(v["xi"]) / F.cosh(v["eta"])).alias("chi"))

    def geodetic(v: Column) -> Column:
        phi = v["chi"]
        for k, d in enumerate(delta, 1):
            phi = phi + F.lit(d) * F.sin(2 * k * v["chi"])
        return F.struct(v["lam"].alias("lam"), phi.alias("phi"))

    north = y - F.when(south, _FALSE_NORTH).otherwise(0.0)
    place = F.struct((north / (_SCALE * radius)).alias("xi"), ((x - _FALSE_EAST) / (_SCALE * radius)).alias("eta"))
    found = _with(_with(_with(place, sphere), conformal), geodetic)
    return F.degrees(_meridian(zone) + found["lam"]), F.degrees(found["phi"])


def utm_northing(south: Column, x: Column, lat: Column) -> Column:
    """Northing in a zone of the place of easting ``x`` on a parallel; null where the zone's grid has none so far out."""
    radius, alpha, _, _ = _krueger()
    n = _FLATTENING / (2 - _FLATTENING)
    c = 2 * n**0.5 / (1 + n)

    def on_sphere(eta: Column, chi: Column) -> Column:
        return F.asin(F.sin(chi) * F.cosh(eta))

    def nearer(v: Column) -> Column:
        """Easting on the conformal sphere by the place that the last one gives."""
        eta, xi = v["east"], on_sphere(v["eta"], v["chi"])
        for k, a in enumerate(alpha, 1):
            eta = eta - F.lit(a) * F.cos(2 * k * xi) * F.sinh(2 * k * v["eta"])
        return F.struct(v["east"].alias("east"), eta.alias("eta"), v["chi"].alias("chi"))

    def north(v: Column) -> Column:
        xi = on_sphere(v["eta"], v["chi"])
        out = xi
        for k, a in enumerate(alpha, 1):
            out = out + F.lit(a) * F.sin(2 * k * xi) * F.cosh(2 * k * v["eta"])
        return out

    phi, east = F.radians(lat), (x - _FALSE_EAST) / (_SCALE * radius)
    chi = F.atan(F.sinh(F.atanh(F.sin(phi)) - F.lit(c) * F.atanh(F.lit(c) * F.sin(phi))))
    place = F.struct(east.alias("east"), east.alias("eta"), chi.alias("chi"))
    for _ in range(4):  # each turns the error to a few thousandths
        place = _with(place, nearer)
    found = F.nanvl(_with(place, north), F.lit(None).cast("double"))
    return F.when(south, _FALSE_NORTH).otherwise(0.0) + found * (_SCALE * radius)


def _is_utm(srid: Column) -> Column:
    return srid.between(32601, 32660) | srid.between(32701, 32760)


def has_wgs84(srid: Column) -> Column:
    """Whether ``to_wgs84`` knows the CRS: geographic, Web Mercator, UTM."""
    return (srid == 4326) | (srid == 3857) | _is_utm(srid)


def to_wgs84(srid: Column, x: Column, y: Column) -> tuple[Column, Column]:
    """Longitude and latitude; null for a CRS that is not known."""
    mercator, grid = from_web_mercator(x, y), from_utm(srid % 100, srid >= 32700, x, y)
    return tuple(F.when(srid == 4326, v).when(srid == 3857, m).when(_is_utm(srid), g) for v, m, g in zip((x, y), mercator, grid, strict=True))

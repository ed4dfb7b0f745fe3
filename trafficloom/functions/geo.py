"""Column expressions of geometry: distances on the sphere, polylines as arrays of points, a lattice of cells."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0
M_PER_DEG = math.pi * EARTH_RADIUS_M / 180.0
#: Cells of resolution 0 are so many degrees wide; each resolution halves that.
CELL_DEG = 20.0


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2.0), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2.0), F.lit(2.0))
    return 2.0 * EARTH_RADIUS_M * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a))


def bearing_deg(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial bearing from the first point to the second, 0 to 360."""
    dlon = F.radians(lon2 - lon1)
    y = F.sin(dlon) * F.cos(F.radians(lat2))
    x = F.cos(F.radians(lat1)) * F.sin(F.radians(lat2)) - F.sin(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.cos(dlon)
    return F.pmod(F.degrees(F.atan2(y, x)) + 360.0, F.lit(360.0))


def line_parts(coords: Column) -> Column:
    """array<struct<a, b>> of a polyline's straight parts, from array<struct<lon, lat>>."""
    return F.when(F.size(coords) > 1, F.transform(F.sequence(F.lit(1), F.size(coords) - 1), lambda i: F.struct(F.element_at(coords, i).alias("a"), F.element_at(coords, i + 1).alias("b")))).otherwise(F.array().cast("array<struct<a:struct<lon:double,lat:double>,b:struct<lon:double,lat:double>>>"))


def line_centroid(coords: Column) -> Column:
    """struct<lon, lat>: the parts' midpoints weighted by length; a line without length: its first point; no points: null."""
    zero = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def add(acc, p):
        w = F.hypot(p["b"]["lon"] - p["a"]["lon"], p["b"]["lat"] - p["a"]["lat"])
        return F.struct((acc["w"] + w).alias("w"), (acc["x"] + w * (p["a"]["lon"] + p["b"]["lon"]) / 2.0).alias("x"), (acc["y"] + w * (p["a"]["lat"] + p["b"]["lat"]) / 2.0).alias("y"))

    s = F.aggregate(line_parts(coords), zero, add)
    first = F.try_element_at(coords, F.lit(1))
    lon = F.when(s["w"] > 0, s["x"] / s["w"]).otherwise(first["lon"])
    lat = F.when(s["w"] > 0, s["y"] / s["w"]).otherwise(first["lat"])
    return F.when(F.size(coords) > 0, F.struct(lon.alias("lon"), lat.alias("lat")))


def point_part_distance_m(lon: Column, lat: Column, part: Column) -> Column:
    """Distance of a point to a straight part in local metres (degrees scaled at the point's latitude)."""
    kx = F.cos(F.radians(lat)) * M_PER_DEG
    ax, ay = (part["a"]["lon"] - lon) * kx, (part["a"]["lat"] - lat) * M_PER_DEG
    bx, by = (part["b"]["lon"] - lon) * kx, (part["b"]["lat"] - lat) * M_PER_DEG
    dx, dy = bx - ax, by - ay
    n = dx * dx + dy * dy
    t = F.when(n > 0, F.least(F.greatest(-(ax * dx + ay * dy) / F.nullif(n, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))).otherwise(F.lit(0.0))
    return F.hypot(ax + t * dx, ay + t * dy)


def line_distance_m(lon: Column, lat: Column, coords: Column) -> Column:
    return F.array_min(F.transform(line_parts(coords), lambda p: point_part_distance_m(lon, lat, p)))


def in_polygon(lon: Column, lat: Column, ring: Column) -> Column:
    """Whether a point is inside a ring of points (closed or not), by counting crossings. Points on the south and west borders of a box are inside."""
    n = F.size(ring)

    def crosses(i):
        a, b = F.element_at(ring, i), F.element_at(ring, F.when(i == n, F.lit(1)).otherwise(i + 1))
        straddles = (a["lat"] > lat) != (b["lat"] > lat)
        at = (b["lon"] - a["lon"]) * (lat - a["lat"]) / F.nullif(b["lat"] - a["lat"], F.lit(0.0)) + a["lon"]
        return F.when(straddles & (lon < at), F.lit(1)).otherwise(F.lit(0))

    hits = F.aggregate(F.transform(F.sequence(F.lit(1), n), crosses), F.lit(0), lambda x, y: x + y)
    return F.coalesce(F.when(n >= 3, hits % 2 == 1), F.lit(False))


def ring_meets_box(ring: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Whether a side of the ring comes into the box or touches it: their boxes meet and the side's line does not pass the box by on one side."""
    n = F.size(ring)

    def meets(i):
        a, b = F.element_at(ring, i), F.element_at(ring, F.when(i == n, F.lit(1)).otherwise(i + 1))
        near = (F.least(a["lon"], b["lon"]) <= x1) & (F.greatest(a["lon"], b["lon"]) >= x0) & (F.least(a["lat"], b["lat"]) <= y1) & (F.greatest(a["lat"], b["lat"]) >= y0)
        side = lambda x, y: (b["lon"] - a["lon"]) * (y - a["lat"]) - (b["lat"] - a["lat"]) * (x - a["lon"])
        at = [side(x, y) for x in (x0, x1) for y in (y0, y1)]
        return near & (F.least(*at) <= 0) & (F.greatest(*at) >= 0)

    return F.exists(F.sequence(F.lit(1), n), meets)


# --- cells: a square lattice of longitude and latitude, named "resolution/x/y" ---------------------------------------------


def cell_size(res: int) -> float:
    if res < 0:
        raise ValueError("resolution must be non-negative")
    return CELL_DEG / 2**res


def _cell(res, x: Column, y: Column) -> Column:
    return F.concat_ws("/", F.lit(res).cast("string") if isinstance(res, int) else res.cast("string"), x.cast("string"), y.cast("string"))


def grid_cell(lat: Column, lon: Column, res: int = 9) -> Column:
    size = cell_size(res)
    return F.when(lat.isNotNull() & lon.isNotNull(), _cell(res, F.floor((lon + 180.0) / size), F.floor((lat + 90.0) / size)))


def _parts(cell: Column) -> tuple[Column, Column, Column]:
    return tuple(F.regexp_extract(cell, r"^(\d+)/(\d+)/(\d+)$", k).cast("long") for k in (1, 2, 3))


def grid_bbox(cell: Column) -> Column:
    """struct<min_lat, min_lon, max_lat, max_lon>; an error for what is not a cell."""
    res, x, y = _parts(cell)
    size = F.lit(CELL_DEG) / F.pow(F.lit(2.0), res)
    box = F.struct((y * size - 90.0).alias("min_lat"), (x * size - 180.0).alias("min_lon"), ((y + 1) * size - 90.0).alias("max_lat"), ((x + 1) * size - 180.0).alias("max_lon"))
    bad = F.raise_error(F.concat(F.lit("invalid cell: "), cell)).cast("struct<min_lat:double,min_lon:double,max_lat:double,max_lon:double>")
    return F.when(cell.isNull(), F.lit(None)).when(cell.rlike(r"^\d+/\d+/\d+$"), box).otherwise(bad)


def grid_neighbours(cell: Column, k: int = 1) -> Column:
    """Sorted cells within k rings, the cell itself left out."""
    if k < 0:
        raise ValueError("k must be non-negative")
    res, x, y = _parts(cell)
    steps = F.sequence(F.lit(-k), F.lit(k))
    ring = F.flatten(F.transform(steps, lambda dx: F.transform(steps, lambda dy: _cell(res, x + dx, y + dy))))
    return F.sort_array(F.filter(ring, lambda c: (c != cell) & c.rlike(r"^\d+/\d+/\d+$")))


def to_geojson_feature(lon: Column, lat: Column, properties: Column) -> Column:
    geometry = F.when(lon.isNotNull() & lat.isNotNull(), F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), geometry.alias("geometry"), properties.alias("properties")), {"ignoreNullFields": "false"})

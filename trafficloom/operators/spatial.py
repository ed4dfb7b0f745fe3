"""Points against roads by a lattice of cells; preparation of road edges."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trafficloom.functions import geo as G
from trafficloom.functions import roads as R
from trafficloom.sources import scratch

from .cells import MOST, Cells, adaptive
from .serving import clip_range

BUFFER_M = 50.0
#: Ids of roads with one buffer that are in an array at most, or about so many.
IDS = 1_024
#: Columns of a leaf and of a share of it.
CELL = ("_l", "_x", "_y", "_share")


def _at_cells(points: DataFrame, roads: DataFrame, cells: Cells, also: Column | None = None) -> DataFrame:
    """Pairs of a point and a road in one leaf that meet `also`. A point has one leaf and a road has each once, so no pair comes twice."""
    p = cells.deal_points(points)
    r = cells.shared(roads).withColumnsRenamed({c: f"_r{c}" for c in CELL})
    same = [F.col(c) == F.col(f"_r{c}") for c in CELL]
    return p.join(r, reduce(and_, same if also is None else [*same, also])).drop(*CELL, *[f"_r{c}" for c in CELL])


def shared_buffers(roads: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """(shapes, members) of roads (road_segment_id, _rings: an array of buffers). A shape is what roads with equal buffers share.

    shapes: _shape (128 bits of the rings), _rings, _blocks; members: _shape, _block, _ids, an array of some IDS road ids. A
    road id of several rows is in as many arrays. What is read more than once goes through `keep`, which may write it.
    """
    rows = keep(roads.withColumn("_shape", F.md5(F.to_json("_rings"))))
    shapes = keep(rows.groupBy("_shape").agg(F.any_value("_rings").alias("_rings"), F.ceil(F.count("*") / F.lit(IDS)).cast("int").alias("_blocks")))
    rows = rows.select("_shape", "road_segment_id").join(shapes.select("_shape", "_blocks"), "_shape")
    ids = F.transform(F.collect_list(F.struct("road_segment_id")), lambda r: r["road_segment_id"])  # with those that are null
    members = rows.groupBy("_shape", F.pmod(F.xxhash64("road_segment_id"), "_blocks").cast("int").alias("_block")).agg(ids.alias("_ids"))
    return shapes, keep(members)


def has_area(column: str = "buffer_geom") -> Column:
    """Whether a buffer has corners enough to hold a point."""
    return F.size(column) >= 3


def within_shapes(points: DataFrame, shapes: DataFrame, cell_deg: float = 0.005, levels: int = 3, most: int = MOST) -> DataFrame:
    """`points` (lon, lat, …) with the other columns of `shapes` for each of their _rings that holds them.

    An equi-join on cells that adapt to the points, then the ring's box, in plain columns of the join, and last the exact
    test; never a nested loop. A cell that lies in the ring as a whole needs no test: no side of the ring comes into it
    and its middle is inside.
    """
    cells = adaptive(points, cell_deg, levels, most)
    ring = F.col("_ring")
    span = lambda f, c: f(F.transform(ring, lambda p: p[c]))
    box = {"_x0": span(F.array_min, "lon"), "_y0": span(F.array_min, "lat"), "_x1": span(F.array_max, "lon"), "_y1": span(F.array_max, "lat")}
    roads = shapes.withColumn("_ring", F.explode("_rings")).drop("_rings").withColumns(box)
    roads = cells.deal_boxes(roads, *[F.col(c) for c in box])
    wide = cells.width()
    left, low = F.col("_x") * wide, F.col("_y") * wide
    pad = wide * 1e-6  # cells are cut by division, corners are products
    holds = (F.col("_x1") - F.col("_x0") >= wide) & (F.col("_y1") - F.col("_y0") >= wide)
    whole = F.when(holds, G.in_polygon(left + wide / 2, low + wide / 2, ring) & ~G.ring_meets_box(ring, left - pad, low - pad, left + wide + pad, low + wide + pad))
    roads = roads.withColumn("_ring", F.when(~F.coalesce(whole, F.lit(False)), ring))  # null: all of the cell is inside
    inside = F.col("lon").between(F.col("_x0"), F.col("_x1")) & F.col("lat").between(F.col("_y0"), F.col("_y1"))
    exact = F.when(ring.isNull(), True).when(inside, G.in_polygon(F.col("lon"), F.col("lat"), ring)).otherwise(False)  # joins test conditions in any order
    return _at_cells(points, roads, cells, inside).where(exact).drop("_ring", *box)


def spatial_within(points: DataFrame, roads: DataFrame, cell_deg: float = 0.005, levels: int = 3, most: int = MOST) -> DataFrame:
    """`points` (lon, lat, …) with road_segment_id for every road buffer (road_segment_id, buffer_geom) that holds them.

    Points meet each different buffer once (`within_shapes`); roads that share it are then unfolded from arrays of ids, so
    a pair of a point and a road costs no comparison of its own. Points in no buffer go.
    """
    write = (lambda df: df) if points.isStreaming else scratch.Steps(points.sparkSession).write
    shapes, members = shared_buffers(roads.where(has_area()).select("road_segment_id", F.array("buffer_geom").alias("_rings")), write)
    placed = within_shapes(points, shapes.select("_shape", "_rings", "_blocks"), cell_deg, levels, most)
    placed = placed.withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    # merged: a row is unfolded before the next, where a broadcast of `placed` would hold all that an array makes
    return placed.join(members.hint("merge"), ["_shape", "_block"]).select(*points.columns, F.explode("_ids").alias("road_segment_id"))


def within_distance(points: DataFrame, edges: DataFrame, meters: float = BUFFER_M, cell_deg: float | None = None, levels: int = 2, most: int = MOST) -> DataFrame:
    """`points` with road_segment_id and distance_m for every edge (id, geom) no further than `meters`.

    Cells adapt to the points and are four times the distance wide at most (cell_deg: another width); an edge is only in
    those that its line comes near to, each with the parts that do. A cell's first part is in plain columns, so the common
    case is compiled; further parts of the same edge in the same cell are in an array.
    """
    cells = adaptive(points, cell_deg or 4 * meters / G.M_PER_DEG, levels, most)
    lat_pad = meters / G.M_PER_DEG
    reach = 1.01 * (meters + F.col("_w") * G.M_PER_DEG / 2**0.5) + 1.0  # from a cell's middle to a line that is near any of its points
    a, b = F.col("_p.a"), F.col("_p.b")
    top = F.least(F.greatest(F.abs(a["lat"]), F.abs(b["lat"])) + lat_pad, F.lit(90.0))
    lon_pad = F.lit(lat_pad) / F.greatest(F.cos(F.radians(top)), F.lit(1e-6))
    x0, x1 = F.least(a["lon"], b["lon"]) - lon_pad, F.greatest(a["lon"], b["lon"]) + lon_pad
    y0, y1 = F.least(a["lat"], b["lat"]) - lat_pad, F.greatest(a["lat"], b["lat"]) + lat_pad
    parts = edges.select(F.col("id").alias("road_segment_id"), F.explode(G.line_parts(F.col("geom"))).alias("_p"))
    # metres east at the latitude where they are fewest: distances come out no longer than they are, so no cell is missed
    east = F.cos(F.radians(top)) * G.M_PER_DEG
    parts = parts.select("road_segment_id", "_p", x0.alias("_x0"), y0.alias("_y0"), x1.alias("_x1"), y1.alias("_y1"), east.alias("_e"), a["lon"].alias("_lon"), a["lat"].alias("_lat"), ((b["lon"] - a["lon"]) * east).alias("_dx"), ((b["lat"] - a["lat"]) * G.M_PER_DEG).alias("_dy"))
    parts = cells.deal_boxes(parts, *[F.col(c) for c in ("_x0", "_y0", "_x1", "_y1")])
    parts = parts.withColumns({"_len2": F.col("_dx") * F.col("_dx") + F.col("_dy") * F.col("_dy"), "_w": cells.width()})
    px, py = ((F.col("_x") + 0.5) * F.col("_w") - F.col("_lon")) * F.col("_e"), ((F.col("_y") + 0.5) * F.col("_w") - F.col("_lat")) * G.M_PER_DEG
    t = F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), (px * F.col("_dx") + py * F.col("_dy")) / F.nullif(F.col("_len2"), F.lit(0.0)))), F.lit(0.0))
    off_x, off_y = px - t * F.col("_dx"), py - t * F.col("_dy")
    parts = parts.where(off_x * off_x + off_y * off_y <= reach * reach)
    roads = parts.groupBy("road_segment_id", "_l", "_x", "_y", "_shares").agg(F.collect_list("_p").alias("_parts"))
    first = F.element_at("_parts", 1)
    roads = roads.select("road_segment_id", "_l", "_x", "_y", "_shares", *[first[e][c].alias(f"_{e}{c}") for e in "ab" for c in ("lon", "lat")], F.when(F.size("_parts") > 1, F.slice("_parts", 2, F.size("_parts"))).alias("_more"))
    near = _at_cells(points, roads, cells)
    own = F.struct(*[F.struct(F.col(f"_{e}lon").alias("lon"), F.col(f"_{e}lat").alias("lat")).alias(e) for e in "ab"])
    lon, lat = F.col("lon"), F.col("lat")
    more = F.when(F.col("_more").isNotNull(), F.array_min(F.transform("_more", lambda q: G.point_part_distance_m(lon, lat, q))))
    near = near.withColumn("distance_m", F.least(G.point_part_distance_m(lon, lat, own), more))
    return near.where(F.col("distance_m") <= meters).select(*points.columns, "road_segment_id", "distance_m")


def filter_road_types(edges: DataFrame, col: str = "highway") -> DataFrame:
    """Edges with an allowed type, given as array<string>; it becomes the first allowed one."""
    return edges.withColumn(col, R.allowed_road_type(F.col(col))).where(F.col(col).isNotNull())


def clip_edges(edges: DataFrame, bbox: tuple[float, float, float, float], col: str = "geom") -> DataFrame:
    """Edges with `parts`, the stretches of their lines inside (south, west, north, east); edges without any go.

    A part that only touches the box in a point goes too.
    """
    south, west, north, east = bbox

    def cut(p):
        r = clip_range(p, west, south, east, north)
        at = lambda t: F.struct((p["a"]["lon"] + (p["b"]["lon"] - p["a"]["lon"]) * t).alias("lon"), (p["a"]["lat"] + (p["b"]["lat"] - p["a"]["lat"]) * t).alias("lat"))
        return F.when(r["inside"] & (r["t0"] < r["t1"]), F.struct(at(r["t0"]).alias("a"), at(r["t1"]).alias("b")))

    parts = F.filter(F.transform(G.line_parts(F.col(col)), cut), lambda p: p.isNotNull())
    return edges.where(F.size(col) > 0).withColumn("parts", parts).where(F.size("parts") > 0)


def prepare_edges(raw: DataFrame, block: int = 1 << 16) -> DataFrame:
    """Edge table from raw edges (u, v, osmid array<long>, name array<string>, highway, length, maxspeed, geom, others).

    ids are 1..n in the order of u, v and osm id. They are made of the rank in a block of nodes and the sizes of the
    blocks before it, so no single task ranks all edges; those sizes are summed up in groups of `block` blocks, so one task
    sees a row for each block ** 2 nodes. Other columns with a value become metadata.
    """
    known = {"u", "v", "osmid", "name", "highway", "length", "maxspeed", "geom"}
    others = [c for c in raw.columns if c not in known]
    first = lambda c: F.try_element_at(F.col(c), F.lit(1))
    rows = raw.select(
        first("osmid").alias("osm_id"), F.col("u").alias("from_node_id"), F.col("v").alias("to_node_id"), first("name").alias("name"),
        F.coalesce("highway", F.lit("residential")).alias("road_type"), F.coalesce("length", F.lit(0.0)).alias("length_m"), R.coerce_speed_limit(F.col("maxspeed")).alias("speed_limit_kmh"), "geom",
        (F.to_json(F.struct(*others)) if others else F.lit("{}")).alias("metadata"), F.floor(F.col("u") / block).alias("_block"),
    )
    sizes = rows.groupBy("_block").agg(F.count("*").alias("_n")).withColumn("_group", F.floor(F.col("_block") / block))
    earlier = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = sizes.groupBy("_group").agg(F.sum("_n").alias("_n")).select("_group", earlier(Window.orderBy("_group")).alias("_of_groups"))
    before = sizes.withColumn("_of_blocks", earlier(Window.partitionBy("_group").orderBy("_block"))).join(groups, "_group").select("_block", (F.col("_of_groups") + F.col("_of_blocks")).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_block").orderBy("from_node_id", "to_node_id", "osm_id", "metadata"))
    return rows.withColumn("_rank", within).join(before, "_block").select((F.col("_before") + F.col("_rank")).cast("long").alias("id"), *[c for c in rows.columns if c != "_block"])


def assign_cells(edges: DataFrame, res: int = 9) -> DataFrame:
    c = G.line_centroid(F.col("geom"))
    return edges.withColumn("cell", G.grid_cell(c["lat"], c["lon"], res))


def road_type_breakdown(edges: DataFrame) -> DataFrame:
    return edges.groupBy("road_type").agg(F.count("*").alias("n_edges"))


def locate_along(points: DataFrame, route_parts: DataFrame, route: str = "route_id", distance: str = "distance_m", bucket_m: float = 1000.0) -> DataFrame:
    """`points` (route_id, distance_m, …) with the lat, lon and bearing at that distance along their route.

    route_parts: route_id, seq, start_lat, start_lon, end_lat, end_lon, length_m. A distance is met in the first part that
    ends at or beyond it; before the start, in the first part, beyond the end, in the last. Parts without length are
    passed over. Points meet only the parts of their stretch of bucket_m metres, so a route with many points or parts is
    spread over many keys.
    """
    parts = route_parts.where("length_m > 0").select(F.col(route).alias("_route"), *["seq", "start_lat", "start_lon", "end_lat", "end_lon", "length_m"])
    w = Window.partitionBy("_route").orderBy("seq")
    parts = parts.withColumn("_to", F.sum("length_m").over(w)).withColumn("_first", F.lag("seq").over(w).isNull())
    parts = parts.withColumn("_from", F.col("_to") - F.col("length_m"))
    ends = parts.groupBy(F.col("_route").alias("_of")).agg(F.max("_to").alias("_end"))
    d, at = F.col(distance), F.col("_at")
    placed = points.join(ends, F.col(route) == F.col("_of")).withColumn("_at", F.least(F.greatest(d.cast("double"), F.lit(0.0)), F.col("_end")))
    placed = placed.where(d.isNotNull()).withColumn("_bucket", F.floor(at / bucket_m))
    parts = parts.withColumn("_stretch", F.explode(F.sequence(F.floor(F.greatest("_from", F.lit(0.0)) / bucket_m), F.floor(F.col("_to") / bucket_m))))
    # half-open at the low end, so that a distance on a border belongs to the part that ends there
    meets = (F.col(route) == F.col("_route")) & (F.col("_bucket") == F.col("_stretch")) & (F.col("_first") | (at > F.col("_from"))) & (at <= F.col("_to"))
    t = F.least(F.greatest((d - F.col("_from")) / F.col("length_m"), F.lit(0.0)), F.lit(1.0))
    return placed.join(parts, meets).select(
        *points.columns,
        (F.col("start_lat") + (F.col("end_lat") - F.col("start_lat")) * t).alias("lat"),
        (F.col("start_lon") + (F.col("end_lon") - F.col("start_lon")) * t).alias("lon"),
        G.bearing_deg(F.col("start_lat"), F.col("start_lon"), F.col("end_lat"), F.col("end_lon")).alias("bearing"),
    )

"""Queries over the road graph, space, trajectories and camera frames."""

from __future__ import annotations


from pyspark.sql import functions as F

from trafficloom.functions import geo as G
from trafficloom.operators import cv, graph, spatial, windows

from . import bindings as B
from .common import registry, rounded

QUERIES, ORACLES, query = registry()
_K = repr(G.M_PER_DEG) + "::DOUBLE"
_R = "6371000.0::DOUBLE"


@query(f"WITH {B.EDGES} SELECT 'up' AS side, a.id AS road_segment_id, coalesce(b.id, -1) AS neighbour_id FROM edges a LEFT JOIN edges b ON b.to_node_id = a.from_node_id UNION ALL SELECT 'down', a.id, coalesce(b.id, -1) FROM edges a LEFT JOIN edges b ON b.from_node_id = a.to_node_id")
def adjacency(spark, sf_dir):
    up, down = graph.adjacency(B.road_edges(spark, sf_dir))
    return up.select(F.lit("up").alias("side"), "road_segment_id", F.coalesce("upstream_id", F.lit(-1)).alias("neighbour_id")).unionByName(down.select(F.lit("down").alias("side"), "road_segment_id", F.coalesce("downstream_id", F.lit(-1)).alias("neighbour_id")))


_DAY = "time_bucket(INTERVAL '1 day', event_time)"
_DAILY = f"{B.events_cte()}, {B.EDGES}, d AS (SELECT road_segment_id, {_DAY} AS event_time, avg(avg_speed_kmh) AS v FROM ev GROUP BY 1, 2)"


def _daily(spark, sf_dir):
    return B.traffic_events(spark, sf_dir).groupBy("road_segment_id", F.window("event_time", "1 day").start.alias("event_time")).agg(F.avg("avg_speed_kmh").alias("avg_speed_kmh"))


@query(
    f"""WITH {_DAILY}, up AS (SELECT a.id, d.event_time, avg(d.v) AS v FROM edges a JOIN edges b ON b.to_node_id = a.from_node_id JOIN d ON d.road_segment_id = b.id GROUP BY 1, 2),
dn AS (SELECT a.id, d.event_time, avg(d.v) AS v FROM edges a JOIN edges b ON b.from_node_id = a.to_node_id JOIN d ON d.road_segment_id = b.id GROUP BY 1, 2)
SELECT d.road_segment_id, d.event_time, round(d.v, 6) AS avg_speed_kmh, round(up.v, 6) AS upstream_speed_kmh, round(dn.v, 6) AS downstream_speed_kmh FROM d LEFT JOIN up ON up.id = d.road_segment_id AND up.event_time = d.event_time LEFT JOIN dn ON dn.id = d.road_segment_id AND dn.event_time = d.event_time"""
)
def neighbour_speeds_aligned(spark, sf_dir):
    return rounded(graph.neighbour_speeds(_daily(spark, sf_dir), B.road_edges(spark, sf_dir)))


@query(
    f"""WITH {B.events_cte()}, {B.EDGES}, seen AS (SELECT road_segment_id, count(*) AS n, count(avg_speed_kmh) AS m, sum(avg_speed_kmh) AS s FROM ev GROUP BY 1),
up AS (SELECT a.id, sum(coalesce(n, 1)) AS n, sum(s) / nullif(sum(m), 0) AS v FROM edges a JOIN edges b ON b.to_node_id = a.from_node_id LEFT JOIN seen ON seen.road_segment_id = b.id GROUP BY 1),
dn AS (SELECT a.id, sum(coalesce(n, 1)) AS n, sum(s) / nullif(sum(m), 0) AS v FROM edges a JOIN edges b ON b.from_node_id = a.to_node_id LEFT JOIN seen ON seen.road_segment_id = b.id GROUP BY 1)
SELECT ev.event_id, ev.road_segment_id, (coalesce(up.n, 1) * coalesce(dn.n, 1))::BIGINT AS n_pairs, round(up.v, 6) AS upstream_speed_kmh, round(dn.v, 6) AS downstream_speed_kmh FROM ev LEFT JOIN up ON up.id = ev.road_segment_id LEFT JOIN dn ON dn.id = ev.road_segment_id"""
)
def neighbour_speeds_raw(spark, sf_dir):
    e = B.traffic_events(spark, sf_dir).select("event_id", "road_segment_id", "avg_speed_kmh")
    return rounded(graph.neighbour_summary(e, B.road_edges(spark, sf_dir)).select("event_id", "road_segment_id", "n_pairs", "upstream_speed_kmh", "downstream_speed_kmh"))


def boxes(spark, sf_dir):
    """Every road's buffer as a box around its line."""
    g = F.col("geom")
    lon, lat = F.transform(g, lambda p: p["lon"]), F.transform(g, lambda p: p["lat"])
    x0, x1, y0, y1 = F.array_min(lon) - 0.0007, F.array_max(lon) + 0.0007, F.array_min(lat) - 0.0007, F.array_max(lat) + 0.0007
    point = lambda x, y: F.struct(x.alias("lon"), y.alias("lat"))
    return B.road_edges(spark, sf_dir).select(F.col("id").alias("road_segment_id"), F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1)).alias("buffer_geom"))


def point_columns():
    """lon and lat of an event."""
    return (39.1 + (F.col("event_id") % 3001) * 0.0001).alias("lon"), (-7.0 + (F.col("user_id") * 100 + F.col("k")) % 4001 * 0.0001).alias("lat")


def _points(spark, sf_dir):
    return B._events(spark, sf_dir).select("event_id", *point_columns())


POINTS = f"{B.E}, {B.EDGES}, pts AS (SELECT event_id, 39.1::DOUBLE + (event_id % 3001) * 0.0001::DOUBLE AS lon, -7.0::DOUBLE + ((user_id * 100 + k) % 4001) * 0.0001::DOUBLE AS lat FROM e)"


IN_BOX = "lat >= least(ay, cy) - 0.0007::DOUBLE AND lat < greatest(ay, cy) + 0.0007::DOUBLE AND lon >= least(ax, cx) - 0.0007::DOUBLE AND lon < greatest(ax, cx) + 0.0007::DOUBLE"


@query(f"WITH {POINTS} SELECT event_id, id AS road_segment_id FROM pts JOIN edges ON {IN_BOX}")
def within_buffer(spark, sf_dir):
    return spatial.spatial_within(_points(spark, sf_dir), boxes(spark, sf_dir)).select("event_id", "road_segment_id")


@query(
    f"""WITH {POINTS}, p AS (SELECT event_id, id, (ax - lon) * cos(radians(lat)) * {_K} AS x1, (ay - lat) * {_K} AS y1, (cx - lon) * cos(radians(lat)) * {_K} AS x2, (cy - lat) * {_K} AS y2 FROM pts JOIN edges ON abs(lat - ay) < 0.01 AND abs(lon - ax) < 0.02),
t AS (SELECT *, greatest(0, least(1, -(x1 * (x2 - x1) + y1 * (y2 - y1)) / nullif((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1), 0))) AS t FROM p)
SELECT event_id, id AS road_segment_id, round(sqrt(pow(x1 + t * (x2 - x1), 2) + pow(y1 + t * (y2 - y1), 2)), 4) AS distance_m FROM t WHERE sqrt(pow(x1 + t * (x2 - x1), 2) + pow(y1 + t * (y2 - y1), 2)) <= 50"""
)
def within_distance(spark, sf_dir):
    return rounded(spatial.within_distance(_points(spark, sf_dir), B.road_edges(spark, sf_dir)).select("event_id", "road_segment_id", "distance_m"), 4)


_SIZE = repr(G.cell_size(9)) + "::DOUBLE"


@query(f"WITH {B.PINGS} SELECT event_id, '9/' || floor((lon + 180) / {_SIZE})::BIGINT || '/' || floor((lat + 90) / {_SIZE})::BIGINT AS cell, round(floor((lat + 90) / {_SIZE}) * {_SIZE} - 90, 6) AS min_lat, round((floor((lon + 180) / {_SIZE}) + 1) * {_SIZE} - 180, 6) AS max_lon, 8 AS n_near, '9/' || (floor((lon + 180) / {_SIZE})::BIGINT - 1) || '/' || (floor((lat + 90) / {_SIZE})::BIGINT - 1) AS first_near FROM pings")
def grid_cells(spark, sf_dir):
    rows = B.pings(spark, sf_dir).select("event_id", G.grid_cell(F.col("lat"), F.col("lon")).alias("cell"))
    near = G.grid_neighbours(F.col("cell"))
    return rounded(rows.select("event_id", "cell", G.grid_bbox(F.col("cell"))["min_lat"].alias("min_lat"), G.grid_bbox(F.col("cell"))["max_lon"].alias("max_lon"), F.size(near).alias("n_near"), F.element_at(near, 1).alias("first_near")))


_BOX = (-6.9, 39.15, -6.7, 39.35)  # south, west, north, east


def _t(which: str) -> str:
    s, w, n, e = _BOX
    low = f"greatest(0, CASE WHEN dx > 0 THEN ({w} - ax) / dx WHEN dx < 0 THEN ({e} - ax) / dx END, CASE WHEN dy > 0 THEN ({s} - ay) / dy END)"
    high = f"least(1, CASE WHEN dx > 0 THEN ({e} - ax) / dx WHEN dx < 0 THEN ({w} - ax) / dx END, CASE WHEN dy > 0 THEN ({n} - ay) / dy END)"
    return low if which == "low" else high


@query(f"WITH {B.EDGES}, d AS (SELECT *, cx - ax AS dx, cy - ay AS dy FROM edges), t AS (SELECT *, {_t('low')} AS t0, {_t('high')} AS t1 FROM d WHERE NOT (dx = 0 AND (ax < {_BOX[1]} OR ax > {_BOX[3]}))) SELECT id, round(ax + dx * t0, 6) AS lon0, round(ay + dy * t0, 6) AS lat0, round(ax + dx * t1, 6) AS lon1, round(ay + dy * t1, 6) AS lat1 FROM t WHERE t0 < t1")
def clip_edges(spark, sf_dir):
    p = F.element_at("parts", 1)
    return rounded(spatial.clip_edges(B.road_edges(spark, sf_dir), _BOX).select("id", p["a"]["lon"].alias("lon0"), p["a"]["lat"].alias("lat0"), p["b"]["lon"].alias("lon1"), p["b"]["lat"].alias("lat1")))


@query(f"WITH {B.EDGES} SELECT id, '9/' || floor(((ax + cx) / 2 + 180) / {_SIZE})::BIGINT || '/' || floor(((ay + cy) / 2 + 90) / {_SIZE})::BIGINT AS cell FROM edges")
def edge_cells(spark, sf_dir):
    return spatial.assign_cells(B.road_edges(spark, sf_dir)).select("id", "cell")


_RAW_TYPE = "CASE c_mktsegment WHEN 'MACHINERY' THEN 'primary' WHEN 'FURNITURE' THEN 'secondary' WHEN 'BUILDING' THEN NULL ELSE 'residential' END"


@query(f"""WITH r AS (SELECT c_custkey // 3 AS u, (c_custkey + 7) // 3 AS v, c_custkey, c_name, {_RAW_TYPE} AS t, CASE WHEN c_custkey % 10 = 0 THEN 50 WHEN c_custkey % 10 = 1 THEN 60 ELSE c_nationkey END AS lim FROM customer)
SELECT row_number() OVER (ORDER BY u, v, c_custkey) AS id, c_custkey AS osm_id, u AS from_node_id, v AS to_node_id, c_name AS name, t AS road_type, 12.5::DOUBLE AS length_m, lim::INTEGER AS speed_limit_kmh, '{{"lanes":"' || (c_custkey % 3) || '"}}' AS metadata FROM r WHERE t IS NOT NULL""")
def prepare_edges(spark, sf_dir):
    c = F.col("c_custkey")
    kinds = F.when(F.col("c_mktsegment") == "MACHINERY", F.array(F.lit("Motorway"), F.lit("PRIMARY"), F.lit("secondary"))).when(F.col("c_mktsegment") == "FURNITURE", F.array(F.lit("secondary"))).when(F.col("c_mktsegment") == "BUILDING", F.array(F.lit("footway"))).otherwise(F.array(F.lit("Residential")))
    limit = F.when(c % 10 == 0, F.lit(None).cast("string")).when(c % 10 == 1, F.lit("['60', '80']")).otherwise(F.concat(F.col("c_nationkey").cast("string"), F.lit(" mph")))
    raw = B.table(spark, sf_dir, "customer").select(F.floor(c / 3).alias("u"), F.floor((c + 7) / 3).alias("v"), F.array(c).alias("osmid"), F.array("c_name").alias("name"), kinds.alias("highway"), F.lit(12.5).alias("length"), limit.alias("maxspeed"), F.array(F.lit(1)).alias("geom"), (c % 3).cast("string").alias("lanes"))
    return spatial.prepare_edges(spatial.filter_road_types(raw), 64).drop("geom")


def _hav(a, b, c, d):
    h = f"(pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2))"
    return f"2 * {_R} * atan2(sqrt({h}), sqrt(1 - {h}))"


def _brg(a, b, c, d):
    y = f"sin(radians({d} - {b})) * cos(radians({c}))"
    x = f"(cos(radians({a})) * sin(radians({c})) - sin(radians({a})) * cos(radians({c})) * cos(radians({d} - {b})))"
    deg = f"(degrees(atan2({y}, {x})) + 360)"
    return f"({deg} - 360 * floor({deg} / 360))"


@query(f"WITH {B.PINGS}, l AS (SELECT event_id, vehicle_id, lat, lon, timestamp AS t, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon, lag(timestamp) OVER w AS pt FROM pings WINDOW w AS (PARTITION BY vehicle_id ORDER BY timestamp, event_id)) SELECT event_id, round({_hav('plat', 'plon', 'lat', 'lon')}, 4) AS leg_m, round({_brg('plat', 'plon', 'lat', 'lon')}, 4) AS leg_bearing, round(CASE WHEN epoch_us(t) > epoch_us(pt) THEN {_hav('plat', 'plon', 'lat', 'lon')} / ((epoch_us(t) - epoch_us(pt)) / 1e6) * 3.6 END, 4) AS leg_kmh FROM l")
def trajectory_legs(spark, sf_dir):
    return rounded(windows.trajectory_legs(B.pings(spark, sf_dir), "vehicle_id").select("event_id", "leg_m", "leg_bearing", "leg_kmh"), 4)


@query(
    f"""WITH {B.E}, {B.EDGES}, parts AS (SELECT id // 10 AS route_id, id AS seq, ay, ax, cy, cx, {_hav('ay', 'ax', 'cy', 'cx')} AS len FROM edges),
c AS (SELECT *, sum(len) OVER (PARTITION BY route_id ORDER BY seq) AS t1, lead(seq) OVER (PARTITION BY route_id ORDER BY seq) IS NULL AS last, lag(seq) OVER (PARTITION BY route_id ORDER BY seq) IS NULL AS first FROM parts),
p AS (SELECT event_id, user_id % 10 AS route_id, value * 20 AS d FROM e)
SELECT event_id, round(ay + (cy - ay) * greatest(0, least(1, (d - (t1 - len)) / len)), 5) AS lat, round(ax + (cx - ax) * greatest(0, least(1, (d - (t1 - len)) / len)), 5) AS lon, round({_brg('ay', 'ax', 'cy', 'cx')}, 4) AS bearing FROM p JOIN c USING (route_id) WHERE (first OR d > t1 - len) AND (last OR d <= t1)"""
)
def locate_along(spark, sf_dir):
    a, b = F.element_at("geom", 1), F.element_at("geom", 2)
    parts = B.road_edges(spark, sf_dir).select(F.floor(F.col("id") / 10).alias("route_id"), F.col("id").alias("seq"), a["lat"].alias("start_lat"), a["lon"].alias("start_lon"), b["lat"].alias("end_lat"), b["lon"].alias("end_lon"), G.haversine_m(a["lat"], a["lon"], b["lat"], b["lon"]).alias("length_m"))
    points = B._events(spark, sf_dir).select("event_id", (F.col("user_id") % 10).alias("route_id"), (F.col("value") * 20).alias("distance_m"))
    rows = spatial.locate_along(points, parts)
    return rows.select("event_id", F.round("lat", 5).alias("lat"), F.round("lon", 5).alias("lon"), F.round("bearing", 4).alias("bearing"))


# --- camera frames -----------------------------------------------------------------------------------------------------------

_BOXES = """b AS (SELECT vec_id, label, i, embedding[4*i+1]::DOUBLE * 100 AS x1, embedding[4*i+2]::DOUBLE * 100 AS y1, embedding[4*i+3]::DOUBLE * 100 + 30 AS x2, embedding[4*i+4]::DOUBLE * 100 + 20 AS y2,
  CASE (vec_id + i) % 4 WHEN 0 THEN 'car' WHEN 1 THEN 'truck' WHEN 2 THEN 'person' ELSE 'bus' END AS kind, abs(embedding[4*i+1]::DOUBLE * 4) AS conf FROM embeddings, range(16) r(i)),
kept AS (SELECT *, (x1 + x2) / 2 AS mx, (y1 + y2) / 2 AS my, row_number() OVER (PARTITION BY vec_id ORDER BY i) AS pos FROM b WHERE kind IN ('car', 'truck', 'bus', 'motorcycle') AND conf >= 0.25),
f AS (SELECT vec_id, label, lag(vec_id) OVER (PARTITION BY label ORDER BY vec_id) AS prev FROM embeddings)"""


@query(
    f"""WITH {_BOXES}, agg AS (SELECT vec_id, count(*) AS n, least(sum(greatest(0, x2 - x1) * greatest(0, y2 - y1)) / 8000, 1) AS occ, greatest(max(mx) - min(mx), max(my) - min(my)) / 2 AS q FROM kept GROUP BY 1),
sp AS (SELECT f.vec_id, avg(sqrt(pow(a.mx - p.mx, 2) + pow(a.my - p.my, 2))) / 2 / max(f.vec_id - f.prev) * 3.6 AS v FROM f JOIN kept a ON a.vec_id = f.vec_id JOIN kept p ON p.vec_id = f.prev AND p.pos = a.pos GROUP BY 1)
SELECT 'cam' || f.label AS camera_id, f.vec_id AS frame_index, coalesce(n, 0) AS vehicle_count, round(v, 6) AS avg_speed_kmh, round(coalesce(occ, 0), 6) AS lane_occupancy, round(q, 6) AS queue_length_m FROM f LEFT JOIN agg USING (vec_id) LEFT JOIN sp USING (vec_id)"""
)
def cv_metrics(spark, sf_dir):
    return rounded(cv.cv_metrics(cv.filter_detections(B.frames(spark, sf_dir))).drop("frame_timestamp"))


@query(f"WITH {_BOXES} SELECT vec_id AS frame_index, i AS place, kind AS class_name FROM kept WHERE vec_id % 15 = 0")
def sampled_detections(spark, sf_dir):
    raw = cv.sample_frames(B.frames(spark, sf_dir))
    numbered = raw.withColumn("detections", F.transform("detections", lambda d, i: d.withField("place", i)))
    return cv.filter_detections(numbered).select("frame_index", F.explode("detections").alias("d")).select("frame_index", F.col("d.place").cast("long").alias("place"), "d.class_name")


_CAMERAS = """SELECT '{"cam0": {"road_segment_id": 10, "location_name": "a", "pixel_per_meter": 2.0, "lat": -6.8, "lon": 39.2}, "cam1": {"road_segment_id": 11, "location_name": "b", "pixel_per_meter": 3.0, "lat": -6.9, "lon": 39.3}}' AS value"""


@query("SELECT 'cam' || label AS camera_id, vec_id AS frame_index, CASE label WHEN 0 THEN 10 WHEN 1 THEN 11 ELSE -1 END::BIGINT AS road_segment_id, label IN (0, 1) AS known FROM embeddings")
def enrich_camera(spark, sf_dir):
    cameras = cv.camera_dimension(spark.sql(_CAMERAS))
    known, unknown = cv.enrich_camera(B.frames(spark, sf_dir).select("camera_id", "frame_index"), cameras)
    return known.select("camera_id", "frame_index", "road_segment_id", F.lit(True).alias("known")).unionByName(unknown.select("camera_id", "frame_index", F.lit(-1).cast("long").alias("road_segment_id"), F.lit(False).alias("known")))


@query("WITH t AS (SELECT vec_id, i, sqrt(pow(embedding[4*i+1]::DOUBLE - embedding[4*i+3]::DOUBLE, 2) + pow(embedding[4*i+2]::DOUBLE - embedding[4*i+4]::DOUBLE, 2)) AS d FROM embeddings, range(16) r(i) WHERE (vec_id + i) % 3 = 0) SELECT e.vec_id AS frame_index, round((SELECT avg(d) FROM t WHERE t.vec_id = e.vec_id) / 2 * 3.6, 6) AS tracked_kmh FROM embeddings e")
def tracked_speed(spark, sf_dir):
    v = lambda i: F.element_at("embedding", i).cast("double")
    tracks = F.array(*[F.struct(v(4 * i + 1).alias("x0"), v(4 * i + 2).alias("y0"), v(4 * i + 3).alias("x1"), v(4 * i + 4).alias("y1"), F.when((F.col("vec_id") + i) % 3 == 0, 1).otherwise(0).alias("status")) for i in range(16)])
    rows = B.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("frame_index"), F.lit(2.0).alias("pixel_per_meter"), tracks.alias("tracks"))
    return rounded(cv.tracked_speed(rows).select("frame_index", "tracked_kmh"))

"""Cells that adapt to their points: leaves, shares and the joins by them, against plain loops."""

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from trafficloom.functions import geo as G
from trafficloom.operators import cells, spatial


def points(spark, rows):
    return spark.createDataFrame(rows, "id long, lon double, lat double")


def crowd(n=600):
    rng = random.Random(4)
    rows = [(k, 39.2 + rng.gauss(0, 0.0004), -6.8 + rng.gauss(0, 0.0004)) for k in range(n)]
    return rows + [(n + k, 39.1 + rng.random() * 0.3, -6.9 + rng.random() * 0.3) for k in range(n // 3)] + [(-1, None, 1.0), (-2, 1.0, None)]


def test_leaves_are_a_partition_with_bounded_shares(spark):
    rows = crowd()
    grid = cells.adaptive(points(spark, rows), 0.01, levels=3, most=40)
    got = grid.deal_points(points(spark, rows)).collect()
    assert sorted(r.id for r in got) == sorted(r[0] for r in rows)
    leaves = Counter((r._l, r._x, r._y) for r in got if None not in (r._x, r._y))
    for level, x, y in leaves:
        inside = [r for r in rows if r[1] is not None and r[2] is not None and math.floor(r[1] / (0.01 / 2**level)) == x and math.floor(r[2] / (0.01 / 2**level)) == y]
        assert len(inside) == leaves[level, x, y]  # a leaf holds all points of its cell
        assert level == 3 or len(inside) <= 40
    assert {k[0] for k in leaves} >= {0, 3}
    shares = Counter((r._l, r._x, r._y, r._share) for r in got if None not in (r._x, r._y))
    assert max(shares.values()) <= 80  # about `most`: shares go by a hash


def test_one_place_is_cut_into_shares(spark):
    rows = [(k, 39.2, -6.8) for k in range(1000)]
    grid = cells.adaptive(points(spark, rows), 0.01, levels=2, most=50)
    shares = Counter(r._share for r in grid.deal_points(points(spark, rows)).collect())
    assert len(shares) == 20 and max(shares.values()) < 100
    edge = spark.createDataFrame([(7, [(39.1999, -6.8), (39.2001, -6.8)])], "id long, geom array<struct<lon: double, lat: double>>")
    got = spatial.within_distance(points(spark, rows), edge, most=50).collect()
    assert sorted(r.id for r in got) == list(range(1000)) and all(r.distance_m < 1e-6 for r in got)


def test_no_points(spark):
    none = points(spark, [])
    grid = cells.adaptive(none, 0.01)
    assert grid.crowded.count() == 0 and grid.deal_points(none).count() == 0


def inside(lon, lat, ring):
    hit = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
        if (ay > lat) != (by > lat) and lon < (bx - ax) * (lat - ay) / (by - ay) + ax:
            hit = not hit
    return hit


def test_rings_of_any_shape_with_split_cells(spark):
    rng, rows = random.Random(9), crowd()
    rings = []
    for k in range(30):
        cx, cy, r = 39.2 + rng.gauss(0, 0.003), -6.8 + rng.gauss(0, 0.003), 0.0005 + rng.random() * 0.02
        rings.append((k, [(cx + r * (0.4 + 0.6 * rng.random()) * math.cos(a), cy + r * (0.4 + 0.6 * rng.random()) * math.sin(a)) for a in sorted(rng.random() * 6.283 for _ in range(3 + k % 6))]))
    rings += [(90, [(39.0, -7.0), (39.5, -7.0)]), (91, [])]  # no area
    want = sorted((i, k) for i, x, y in rows if x is not None and y is not None for k, ring in rings if len(ring) > 2 and inside(x, y, ring))
    roads = spark.createDataFrame(rings, "road_segment_id long, buffer_geom array<struct<lon: double, lat: double>>")
    for most in (5, 100, 10_000):
        got = spatial.spatial_within(points(spark, rows), roads, 0.01, 3, most)
        assert sorted((r.id, r.road_segment_id) for r in got.collect()) == want
        assert got.columns == ["id", "lon", "lat", "road_segment_id"]


def test_distances_do_not_depend_on_the_cells(spark):
    rng, rows = random.Random(2), crowd()
    lines = [(k, [(39.2 + rng.gauss(0, 0.002), -6.8 + rng.gauss(0, 0.002)) for _ in range(2 + k % 4)]) for k in range(25)]
    edges = spark.createDataFrame(lines, "id long, geom array<struct<lon: double, lat: double>>")
    p = points(spark, rows).withColumnRenamed("id", "event")
    brute = p.crossJoin(edges).withColumn("d", G.line_distance_m(F.col("lon"), F.col("lat"), F.col("geom"))).where("d <= 50")
    want = sorted((r.event, r.id, round(r.d, 6)) for r in brute.collect())
    for most in (5, 10_000):
        got = spatial.within_distance(p, edges, most=most).collect()
        assert sorted((r.event, r.road_segment_id, round(r.distance_m, 6)) for r in got) == want


def test_a_stream_of_points_meets_the_roads_that_a_table_does(spark, tmp_path):
    rows = crowd()
    points(spark, rows).write.parquet(str(tmp_path / "in"))
    ring = [(39.1995, -6.8005), (39.2065, -6.8005), (39.2065, -6.7935), (39.1995, -6.7935)]
    wide = [(39.0, -7.0), (39.5, -7.0), (39.5, -6.5), (39.0, -6.5)]
    roads = spark.createDataFrame([(1, ring), (2, wide)], "road_segment_id long, buffer_geom array<struct<lon: double, lat: double>>")
    edges = spark.createDataFrame([(7, ring), (8, wide)], "id long, geom array<struct<lon: double, lat: double>>")
    stream = spark.readStream.schema("id long, lon double, lat double").parquet(str(tmp_path / "in"))
    for k, (meet, other) in enumerate([(spatial.spatial_within, roads), (spatial.within_distance, edges)]):
        made = meet(stream, other) if k == 0 else meet(stream, other, 200.0)
        out = str(tmp_path / f"out{k}")
        made.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / f"ck{k}")).trigger(availableNow=True).start().awaitTermination()
        table = meet(points(spark, rows), other, *([200.0] if k else []), most=40)
        got, want = (sorted((r.id, r.road_segment_id) for r in t.collect()) for t in (spark.read.parquet(out), table))
        assert got == want and len(want) > 100

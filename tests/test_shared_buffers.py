"""Roads with equal buffers: points are looked at once for the buffer, and every road has its rows."""

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from trafficloom.operators import spatial
from trafficloom.streaming import silver

RING = "array<struct<lon: double, lat: double>>"
START = datetime(2024, 1, 1)


def box(x, y, w=0.01):
    return [(x, y), (x + w, y), (x + w, y + w), (x, y + w)]


def windows(df):
    return sorted(tuple(r) for r in df.select("road_segment_id", F.col("event_time").cast("string"), "vehicle_count", "avg_speed_kmh", "flow_rate").collect())


def test_the_stream_keeps_a_row_for_a_buffer_and_not_for_each_road(spark, tmp_path):
    kind = "source_type string, lon double, lat double, speed_kmh double, flow double, timestamp timestamp"
    rows = [("fleet_gps", 39.2001 + 0.0004 * (k % 60), -6.8 + 0.005, float(7 * k // 10 % 9), 1.0, START + timedelta(seconds=7 * k)) for k in range(300)]
    rows += [("fleet_gps", 39.205, -6.795, 5.0, 1.0, START + timedelta(days=1))]  # lets the watermark pass the others
    spark.createDataFrame(rows, kind).coalesce(1).write.parquet(str(tmp_path / "in"))
    roads = [(k, box(39.2, -6.8)) for k in range(40)] + [(40, box(39.21, -6.8)), (41, box(39.2, -6.8)), (41, box(39.21, -6.8)), (41, box(39.2, -6.8)), (42, [(39.0, -6.8)])]
    roads = spark.createDataFrame(roads, f"road_segment_id long, buffer_geom {RING}")
    out = silver.silver_stream(spark.readStream.schema(kind).parquet(str(tmp_path / "in")), "fleet_gps", roads, duration="10 minutes")
    query = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    query.awaitTermination()
    held = max(s["numRowsTotal"] for p in query.recentProgress for s in json.loads(p.json)["stateOperators"])
    assert held <= 3 * len(rows)  # three different sets of buffers
    got = windows(spark.read.parquet(str(tmp_path / "out")))
    want = []
    for road, lows in [*[(k, (39.2,)) for k in range(40)], (40, (39.21,)), (41, (39.2, 39.21))]:
        seen = {}
        for _, x, y, speed, flow, at in rows[:-1]:
            if any(low < x < low + 0.01 for low in lows):
                seen.setdefault(at.replace(microsecond=0, second=at.second // 10 * 10), (at, speed))
        sums = {}
        for at, speed in seen.values():
            sums.setdefault(at.replace(second=0, minute=at.minute // 10 * 10), []).append(speed)
        want += [(road, str(at), len(v), sum(v) / len(v), float(len(v))) for at, v in sums.items()]
    assert [(r[0], r[1], r[2], round(r[3], 9), r[4]) for r in got] == sorted((r[0], r[1], r[2], round(r[3], 9), r[4]) for r in want)


def test_points_meet_a_buffer_once_and_every_road_has_its_pairs(spark, monkeypatch):
    monkeypatch.setattr(spatial, "IDS", 16)
    points = spark.createDataFrame([(k, 39.2001 + 0.0004 * (k % 60), -6.795) for k in range(120)], "event long, lon double, lat double")
    rows = [(k, box(39.2, -6.8)) for k in range(200)] + [(None, box(39.2, -6.8)), (7, box(39.2, -6.8)), (7, box(39.21, -6.8)), (300, box(39.21, -6.8)), (301, [(39.2, -6.8)]), (302, None)]
    roads = spark.createDataFrame(rows, f"road_segment_id long, buffer_geom {RING}")
    low = {39.2: [r for r, b in rows if b == box(39.2, -6.8)], 39.21: [7, 300]}
    want = [(k, r) for k in range(120) for x in low for r in low[x] if x < 39.2001 + 0.0004 * (k % 60) < x + 0.01]
    got = spatial.spatial_within(points, roads)
    assert got.columns == ["event", "lon", "lat", "road_segment_id"]
    order = lambda pairs: sorted(pairs, key=lambda p: (p[0], -1 if p[1] is None else p[1]))
    assert order((r.event, r.road_segment_id) for r in got.collect()) == order(want)
    shapes, members = spatial.shared_buffers(roads.where(spatial.has_area()).select("road_segment_id", F.array("buffer_geom").alias("_rings")))
    assert shapes.count() == 2 and members.count() <= 14
    sizes = [len(r._ids) for r in members.collect()]
    assert sum(sizes) == 204 and max(sizes) < 60
    assert spatial.within_shapes(points, shapes).count() == len({(k, x) for k in range(120) for x in low if x < 39.2001 + 0.0004 * (k % 60) < x + 0.01})

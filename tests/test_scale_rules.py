"""Rules that must hold however the rows are dealt: hot keys, long lines, routes with many points; against plain Python."""

import math
import random
from collections import deque
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trafficloom.functions import geo as G
from trafficloom.operators import graph, spatial, stateful


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    yield spark
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def keyed_rows(n=4000):
    """Half of the rows have one key; times tie."""
    r = random.Random(8)
    start = datetime(2024, 1, 1)
    return [(i, "hot" if i % 2 else f"k{r.randrange(40)}", start + timedelta(seconds=r.randrange(20_000))) for i in range(n)]


def test_dedup_ttl_carries_a_hot_key_over_batches(small_batches):
    rows = keyed_rows()
    want, last = set(), {}
    for i, k, t in sorted(rows, key=lambda x: (x[1], x[2], x[0])):
        if k not in last or t - last[k] >= timedelta(seconds=300):
            last[k] = t
            want.add(i)
    df = small_batches.createDataFrame([*rows, (-1, None, rows[0][2]), (-2, "hot", None)], "event_id long, id string, reported_at timestamp_ntz")
    got = stateful.dedup_ttl(df, ttl_s=300)
    assert got.columns == df.columns and sorted(r.event_id for r in got.collect()) == sorted(want)
    assert "collect_list" not in got._jdf.queryExecution().toString()


def test_rate_limit_carries_a_hot_key_over_batches(small_batches):
    rows = keyed_rows()
    want, taken = {}, {}
    for i, k, t in sorted(rows, key=lambda x: (x[1], x[2], x[0])):
        own = taken.setdefault(k, deque())
        while own and t - own[0] >= timedelta(seconds=60):
            own.popleft()
        want[i] = len(own) < 3
        if want[i]:
            own.append(t)
    df = small_batches.createDataFrame(rows, "event_id long, id string, reported_at timestamp_ntz").withColumn("accepted", F.lit("clash"))
    got = {r.event_id: r.accepted for r in stateful.rate_limit(df, "id", "reported_at", 3, 60.0).collect()}
    assert got == want and 0 < sum(want.values()) < len(want)


def plain_distance(lon, lat, line):
    kx, ky, best = math.cos(math.radians(lat)) * G.M_PER_DEG, G.M_PER_DEG, math.inf
    for (ax, ay), (bx, by) in zip(line, line[1:]):
        x1, y1, x2, y2 = (ax - lon) * kx, (ay - lat) * ky, (bx - lon) * kx, (by - lat) * ky
        n = (x2 - x1) ** 2 + (y2 - y1) ** 2
        t = max(0.0, min(1.0, -(x1 * (x2 - x1) + y1 * (y2 - y1)) / n)) if n else 0.0
        best = min(best, math.hypot(x1 + t * (x2 - x1), y1 + t * (y2 - y1)))
    return best


def test_within_distance_of_lines_with_many_parts(spark):
    r = random.Random(6)
    lines = []
    for i in range(25):
        x, y, line = 39.2 + r.random() * 0.01, -6.8 + r.random() * 0.01, []
        for _ in range(r.choice((1, 2, 3, 12))):
            line.append((x, y))
            x, y = x + r.uniform(-0.001, 0.001), y + r.uniform(-0.001, 0.001)
        lines.append((i, line))
    lines += [(90, []), (91, [(39.2, -6.8), (39.2, -6.8)])]
    points = [(i, 39.2 + r.random() * 0.01, -6.8 + r.random() * 0.01) for i in range(300)] + [(1000, 39.2, -6.8), (1000, 39.2, -6.8), (1001, None, None)]
    edges = spark.createDataFrame([(i, [{"lon": x, "lat": y} for x, y in line]) for i, line in lines], "id long, geom array<struct<lon: double, lat: double>>")
    df = spark.createDataFrame(points, "event_id long, lon double, lat double")
    want = sorted((p, i) for p, x, y in points if x is not None for i, line in lines if len(line) > 1 and plain_distance(x, y, line) <= 50)
    assert want.count((1000, 91)) == 2
    for cell in (None, 0.01, 0.0003):
        got = spatial.within_distance(df, edges, cell_deg=cell).collect()
        assert sorted((g.event_id, g.road_segment_id) for g in got) == want
        for g in got:
            assert abs(g.distance_m - plain_distance(g.lon, g.lat, dict(lines)[g.road_segment_id])) < 1e-6


def test_locate_along_one_hot_route(spark):
    r = random.Random(2)
    parts = [(route, k, -6.8 + k * 0.01, 39.2, -6.8 + (k + 1) * 0.01, 39.2, r.choice((0.0, 5.0, 700.0, 4000.0))) for route in (1, 2) for k in range(30)]
    points = [(i, 1 if i % 3 else 2, r.uniform(-100, 60_000)) for i in range(400)] + [(500, 3, 1.0), (501, 1, None), (502, 1, 0.0), (503, 1, sum(p[6] for p in parts if p[0] == 1))]
    want = {}
    for i, route, d in points:
        own = [p for p in parts if p[0] == route and p[6] > 0]
        if d is None or not own:
            continue
        to = 0.0
        for k, p in enumerate(own):
            to += p[6]
            if d <= to or k == len(own) - 1:
                t = min(1.0, max(0.0, (d - (to - p[6])) / p[6]))
                want[i] = round(p[2] + (p[4] - p[2]) * t, 9)
                break
    got = spatial.locate_along(
        spark.createDataFrame(points, "event_id long, route_id long, distance_m double"),
        spark.createDataFrame(parts, "route_id long, seq long, start_lat double, start_lon double, end_lat double, end_lon double, length_m double"),
    )
    assert {g.event_id: round(g.lat, 9) for g in got.collect()} == want


def test_edge_ids_follow_the_order_over_groups_of_blocks(spark):
    r = random.Random(4)
    raw = [(r.randrange(300), r.randrange(300), [k], ["n"], "residential", 1.0, None, [1]) for k in range(500)]
    df = spark.createDataFrame(raw, "u long, v long, osmid array<long>, name array<string>, highway string, length double, maxspeed string, geom array<int>")
    want = {x[2][0]: n for n, x in enumerate(sorted(raw, key=lambda x: (x[0], x[1], x[2])), 1)}
    for block in (2, 7, 1 << 16):
        assert {e.osm_id: e.id for e in spatial.prepare_edges(df, block).collect()} == want


def test_neighbour_summary_is_the_raw_product_summed_up(spark):
    r = random.Random(1)
    edges = spark.createDataFrame([(i, i // 3, (i + 7) // 3) for i in range(1, 30)], "id long, from_node_id long, to_node_id long")
    rows = [(k, r.randint(1, 34), datetime(2024, 1, 1) + timedelta(minutes=k), None if k % 9 == 0 else float(r.randint(1, 80))) for k in range(90)]
    df = spark.createDataFrame(rows, "event_id long, road_segment_id long, event_time timestamp_ntz, avg_speed_kmh double")
    raw = graph.neighbour_speeds(df, edges, "raw").groupBy("event_id").agg(F.count("*").alias("n"), F.avg("upstream_speed_kmh").alias("u"), F.avg("downstream_speed_kmh").alias("d"))
    place = lambda x: None if x is None else round(x, 6)
    want = {x.event_id: (x.n, place(x.u), place(x.d)) for x in raw.collect()}
    got = {x.event_id: (x.n_pairs, place(x.upstream_speed_kmh), place(x.downstream_speed_kmh)) for x in graph.neighbour_summary(df, edges).collect()}
    assert got == want

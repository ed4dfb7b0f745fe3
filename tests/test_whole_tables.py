"""Registered queries read all rows of their tables."""

from datetime import datetime

from trafficloom.plans import space, tables


def test_within_buffer_reads_every_road(spark, tmp_path):
    roads = [1, 299, 301, 1234, 4999]
    spark.createDataFrame([(c, f"c{c}", 1, "BUILDING") for c in roads], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    line = lambda c: (39.1 + (c % 30) * 0.01, -7.0 + ((c * 7) % 40) * 0.01, 39.1 + (c % 30) * 0.01 + ((c % 3) - 1) * 0.004, -7.0 + ((c * 7) % 40) * 0.01 + 0.003)
    events = []
    for c in roads:  # a point at the middle of each road's line
        ax, ay, cx, cy = line(c)
        i, at = round(((ax + cx) / 2 - 39.1) / 0.0001), round(((ay + cy) / 2 + 7.0) / 0.0001)
        events.append((i, at // 100, '{"k": %d}' % (at % 100)))
    spark.createDataFrame(events, "event_id long, user_id long, props string").write.parquet(f"{tmp_path}/events.parquet")
    want = []
    for i, u, p in events:
        lon, lat = 39.1 + (i % 3001) * 0.0001, -7.0 + (u * 100 + int(p[6:-1])) % 4001 * 0.0001
        for c in roads:
            ax, ay, cx, cy = line(c)
            if min(ay, cy) - 0.0007 <= lat < max(ay, cy) + 0.0007 and min(ax, cx) - 0.0007 <= lon < max(ax, cx) + 0.0007:
                want.append((i, c))
    got = sorted((r.event_id, r.road_segment_id) for r in space.within_buffer(spark, str(tmp_path)).collect())
    assert got == sorted(want) and {c for _, c in want} == set(roads)


def test_predictions_of_odd_roads_count(spark, tmp_path):
    at = datetime(2024, 1, 30)
    customer = [(c, f"c{c}", 1, "BUILDING") for c in (3, 4, 5)]
    spark.createDataFrame(customer, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1, 3, at, 250000.0), (2, 4, at, 300000.0)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, 5, at, "view", 40.0, '{"k": 1}')], "event_id long, user_id long, ts timestamp_ntz, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    got = {r.road_segment_id: (r.predicted_speed_kmh, r.model) for r in tables.predictions_fallback(spark, str(tmp_path)).collect()}
    assert got == {3: (25.0, "m1"), 4: (30.0, "m1"), 5: (40.0, "historical_avg")}

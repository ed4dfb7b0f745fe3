"""Queries over the five-minute and daily tables and the read models."""

from __future__ import annotations

from pyspark.sql import functions as F

from trafficloom.functions import traffic as T
from trafficloom.operators import quality, serving, spatial, windows

from . import bindings as B
from .common import registry, rounded

QUERIES, ORACLES, query = registry()


def _silver(spark, sf_dir, step="5 minutes", dwell=5.0, segments=0):
    return windows.segment_traffic_5min(B.traffic_events(spark, sf_dir, segments), B.road_edges(spark, sf_dir), step, dwell)


_COLS = "road_segment_id, event_time, window_end, vehicle_count, round(avg_speed_kmh, 6) AS avg_speed_kmh, round(flow_rate, 6) AS flow_rate, round(upstream_speed_kmh, 6) AS upstream_speed_kmh, round(weather_factor, 6) AS weather_factor, dwell_flag, round(congestion_score, 6) AS congestion_score, congestion_level"


@query(f"WITH {B.silver_cte()} SELECT {_COLS} FROM silver")
def silver_5min(spark, sf_dir):
    return rounded(_silver(spark, sf_dir))


@query(f"WITH {B.silver_cte('6 hours', 40.0, 10)} SELECT {_COLS} FROM silver")
def silver_wide(spark, sf_dir):
    return rounded(_silver(spark, sf_dir, "6 hours", 40.0, 10))


_GOLD = """SELECT road_segment_id, date_trunc('day', event_time)::TIMESTAMP AS event_date, round(max(congestion_score), 6) AS max_congestion_score, round(avg(congestion_score), 6) AS avg_congestion_score,
 round(sum(CASE WHEN round(congestion_score, 9) >= 0.70 THEN {h}::DOUBLE ELSE 0.0 END), 6) AS total_congestion_hours, arg_max(extract(hour FROM event_time), (round(congestion_score, 9), -epoch(event_time)))::INTEGER AS peak_hour FROM silver GROUP BY 1, 2"""


@query(f"WITH {B.silver_cte()} {_GOLD.format(h='(5.0::DOUBLE / 60.0::DOUBLE)')}")
def gold_daily(spark, sf_dir):
    return rounded(windows.segment_congestion_daily(_silver(spark, sf_dir)))


@query(f"WITH {B.silver_cte('1 hour', 5.0, 10)} {_GOLD.format(h='1.0')}")
def gold_daily_busy(spark, sf_dir):
    return rounded(windows.segment_congestion_daily(_silver(spark, sf_dir, "1 hour", 5.0, 10), 60.0))


@query(f"WITH {B.events_cte(10)} SELECT event_id, road_segment_id, greatest(max(coalesce(vehicle_count, 0)) OVER (PARTITION BY road_segment_id ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING), 1)::INTEGER AS capacity, coalesce(avg_speed_kmh < 30 AND lag(avg_speed_kmh) OVER w < 30 AND lag(avg_speed_kmh, 2) OVER w < 30, false) AS dwell_flag FROM ev WINDOW w AS (PARTITION BY road_segment_id ORDER BY event_time, event_id)")
def running_capacity_dwell(spark, sf_dir):
    return windows.running_state(B.traffic_events(spark, sf_dir, 10), threshold=30.0).select("event_id", "road_segment_id", "capacity", "dwell_flag")


@query(f"WITH {B.events_cte(10)} SELECT road_segment_id, time_bucket(INTERVAL '30 seconds', event_time) AS event_time, count(*) AS vehicle_count, round(avg(avg_speed_kmh), 6) AS avg_speed_kmh, round(sum(flow_rate), 6) AS flow_rate FROM ev GROUP BY 1, 2")
def window_agg_30s(spark, sf_dir):
    return rounded(windows.segment_window_agg(B.traffic_events(spark, sf_dir, 10), speed="avg_speed_kmh", flow="flow_rate"))


_LATEST = "latest AS (SELECT * FROM silver QUALIFY row_number() OVER (PARTITION BY road_segment_id ORDER BY event_time DESC) = 1)"


@query(f"WITH {B.silver_cte()}, {_LATEST} SELECT e.id AS road_segment_id, e.name, e.road_type, round(l.avg_speed_kmh, 6) AS avg_speed_kmh, round(l.congestion_score, 6) AS congestion_score, l.congestion_level FROM edges e LEFT JOIN latest l ON l.road_segment_id = e.id")
def segments_latest(spark, sf_dir):
    return rounded(serving.segments_latest(B.road_edges(spark, sf_dir), _silver(spark, sf_dir)))


@query(f"WITH {B.silver_cte()}, {_LATEST} SELECT e.id AS road_segment_id, e.name, e.road_type, round(l.avg_speed_kmh, 6) AS avg_speed_kmh, round(l.congestion_score, 6) AS congestion_score, l.congestion_level FROM edges e LEFT JOIN latest l ON l.road_segment_id = e.id WHERE e.road_type = 'primary'")
def segments_latest_primary(spark, sf_dir):
    return rounded(serving.segments_latest(B.road_edges(spark, sf_dir), _silver(spark, sf_dir), "primary"))


@query(f"WITH {B.silver_cte(segments=10)} SELECT road_segment_id, event_time, vehicle_count, round(avg_speed_kmh, 6) AS avg_speed_kmh, round(flow_rate, 6) AS flow_rate, round(congestion_score, 6) AS congestion_score FROM silver WHERE road_segment_id = 3 AND event_time >= TIMESTAMP '{B.AS_OF}' - INTERVAL 24 HOUR ORDER BY event_time DESC LIMIT 500")
def segment_history(spark, sf_dir):
    return rounded(serving.segment_history(_silver(spark, sf_dir, segments=10), 3, B.as_of(), 24))


_HEAT = "CASE WHEN s IS NULL THEN 'unknown' WHEN round(s, 9) >= 0.75 THEN 'severe' WHEN round(s, 9) >= 0.5 THEN 'heavy' WHEN round(s, 9) >= 0.25 THEN 'moderate' ELSE 'free_flow' END"
_BOX = (39.13, -6.95, 39.27, -6.7)


@query(
    f"""WITH {B.silver_cte()}, {_LATEST}, clipped AS (SELECT *, cx - ax AS dx, cy - ay AS dy FROM edges),
inside AS (SELECT * FROM clipped WHERE NOT (dx = 0 AND (ax < {_BOX[0]} OR ax > {_BOX[2]})) AND NOT (dy = 0 AND (ay < {_BOX[1]} OR ay > {_BOX[3]}))
 AND greatest(0, CASE WHEN dx > 0 THEN ({_BOX[0]} - ax) / dx WHEN dx < 0 THEN ({_BOX[2]} - ax) / dx END, CASE WHEN dy > 0 THEN ({_BOX[1]} - ay) / dy WHEN dy < 0 THEN ({_BOX[3]} - ay) / dy END)
  <= least(1, CASE WHEN dx > 0 THEN ({_BOX[2]} - ax) / dx WHEN dx < 0 THEN ({_BOX[0]} - ax) / dx END, CASE WHEN dy > 0 THEN ({_BOX[3]} - ay) / dy WHEN dy < 0 THEN ({_BOX[1]} - ay) / dy END))
SELECT road_segment_id, centroid_lon, centroid_lat, avg_speed_kmh, round(s, 6) AS congestion_score, {_HEAT} AS congestion_level FROM (SELECT i.id AS road_segment_id, round((ax + cx) / 2, 6) AS centroid_lon, round((ay + cy) / 2, 6) AS centroid_lat, round(l.avg_speed_kmh, 6) AS avg_speed_kmh, l.congestion_score AS s FROM inside i LEFT JOIN latest l ON l.road_segment_id = i.id)"""
)
def congestion_heatmap(spark, sf_dir):
    return rounded(serving.congestion_heatmap(B.road_edges(spark, sf_dir), _silver(spark, sf_dir), ",".join(map(str, _BOX))).drop("feature"))


@query(f"""WITH {B.silver_cte()}, {_LATEST} SELECT e.id AS road_segment_id, '{{"type":"Feature","geometry":{{"type":"Point","coordinates":[0.5,1.5]}},"properties":{{"road_segment_id":' || e.id || ',"congestion_level":"' || coalesce(l.congestion_level, 'unknown') || '"}}}}' AS feature FROM edges e LEFT JOIN latest l ON l.road_segment_id = e.id""")
def geojson_features(spark, sf_dir):
    from trafficloom.functions.geo import to_geojson_feature

    rows = serving.segments_latest(B.road_edges(spark, sf_dir), _silver(spark, sf_dir))
    props = F.struct("road_segment_id", F.coalesce("congestion_level", F.lit("unknown")).alias("congestion_level"))
    return rows.select("road_segment_id", to_geojson_feature(F.lit(0.5), F.lit(1.5), props).alias("feature"))


@query(f"WITH {B.silver_cte()} SELECT road_segment_id, round(avg(avg_speed_kmh), 6) AS predicted_speed_kmh FROM silver WHERE event_time >= TIMESTAMP '{B.AS_OF}' - INTERVAL 7 DAY GROUP BY 1")
def historical_speed(spark, sf_dir):
    return rounded(serving.historical_speed(_silver(spark, sf_dir), B.as_of()))


@query(
    f"""WITH {B.silver_cte()}, hist AS (SELECT road_segment_id, avg(avg_speed_kmh) AS m FROM silver WHERE event_time >= TIMESTAMP '{B.AS_OF}' - INTERVAL 7 DAY GROUP BY 1),
pred AS (SELECT o_custkey, o_orderdate, o_totalprice / 10000.0::DOUBLE AS v FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT e.id AS road_segment_id, p.o_orderdate AS predicted_at, round(CASE WHEN p.o_custkey IS NOT NULL THEN p.v ELSE h.m END, 6) AS predicted_speed_kmh, CASE WHEN p.o_custkey IS NOT NULL THEN 0.5::DOUBLE END AS confidence, CASE WHEN p.o_custkey IS NOT NULL THEN 'm1' ELSE 'historical_avg' END AS model
FROM edges e LEFT JOIN pred p ON p.o_custkey = e.id LEFT JOIN hist h ON h.road_segment_id = e.id"""
)
def predictions_fallback(spark, sf_dir):
    segments = B.road_edges(spark, sf_dir).select(F.col("id").alias("road_segment_id"))
    return rounded(serving.predictions_or_fallback(segments, B.predictions(spark, sf_dir), _silver(spark, sf_dir), B.as_of()))


@query(f"WITH {B.events_cte()} SELECT road_segment_id, event_time, event_id, source_type, vehicle_count FROM ev WHERE event_time <= TIMESTAMP '2024-01-20' AND event_time > TIMESTAMP '2024-01-20' - INTERVAL 10 DAY QUALIFY row_number() OVER (PARTITION BY road_segment_id ORDER BY event_time DESC, event_id DESC) = 1")
def latest_within(spark, sf_dir):
    rows = B.traffic_events(spark, sf_dir).select("road_segment_id", "event_time", "event_id", "source_type", "vehicle_count")
    return windows.latest_within(rows, ["road_segment_id"], "event_time", F.lit("2024-01-20").cast("timestamp_ntz"), "10 days")


@query(f"WITH {B.EDGES} SELECT road_type, count(*) AS n_edges FROM edges GROUP BY 1")
def road_type_breakdown(spark, sf_dir):
    return spatial.road_type_breakdown(B.road_edges(spark, sf_dir))


_W = "CASE k % 5 WHEN 0 THEN 'rain' WHEN 1 THEN 'heavy_rain' WHEN 2 THEN 'fog' WHEN 3 THEN 'clear' END"
_S = "CASE WHEN (k % 7) * 10 > 0 AND k % 9 > 0 THEN (1 - greatest(0, least(1, value / ((k % 7) * 10)))) * 0.6::DOUBLE + least(1, k::DOUBLE / ((k % 9) * 20)) * 0.4::DOUBLE END"


@query(f"""WITH {B.E}, s AS (SELECT event_id, {_S} AS s, {_W} AS w FROM e) SELECT event_id, round(s, 9) AS score, CASE WHEN s IS NULL THEN NULL WHEN round(s, 9) < 0.30 THEN 'free_flow' WHEN round(s, 9) < 0.50 THEN 'light' WHEN round(s, 9) < 0.70 THEN 'moderate' WHEN round(s, 9) < 0.90 THEN 'heavy' ELSE 'severe' END AS level, {_HEAT} AS heat,
 round(greatest(0, least(1, s * CASE w WHEN 'rain' THEN 1.10::DOUBLE WHEN 'heavy_rain' THEN 1.20::DOUBLE WHEN 'fog' THEN 1.15::DOUBLE ELSE 1.0::DOUBLE END)), 9) AS adjusted FROM s WHERE s IS NOT NULL
 UNION ALL SELECT event_id, NULL, NULL, 'unknown', NULL FROM s WHERE s IS NULL""")
def congestion_scores(spark, sf_dir):
    e = B._events(spark, sf_dir)
    k = F.col("k")
    s = T.congestion_score(F.col("value"), ((k % 7) * 10).cast("double"), k, (k % 9) * 20)
    w = F.when(k % 5 == 0, "rain").when(k % 5 == 1, "heavy_rain").when(k % 5 == 2, "fog").when(k % 5 == 3, "clear")
    return rounded(e.select("event_id", s.alias("score"), w.alias("w")).select("event_id", "score", T.congestion_level(F.col("score")).alias("level"), T.heatmap_level(F.col("score")).alias("heat"), T.weather_adjust(F.col("score"), F.col("w")).alias("adjusted")), 9)


@query(
    f"""WITH {B.silver_cte()} SELECT 'not_null_' || c AS check_name, 0::BIGINT AS n_failed FROM (VALUES ('road_segment_id'), ('event_time'), ('congestion_score'), ('congestion_level')) t(c)
UNION ALL SELECT 'score_in_range', count(*) FROM silver WHERE NOT (congestion_score BETWEEN 0 AND 1)
UNION ALL SELECT 'accepted_congestion_level', count(*) FROM silver WHERE congestion_level NOT IN ('free_flow', 'light', 'moderate', 'heavy', 'severe')
UNION ALL SELECT 'relationship_road_segment_id', count(*) FROM silver s WHERE NOT EXISTS (SELECT 1 FROM edges e WHERE e.id = s.road_segment_id)
UNION ALL SELECT 'min_edges', CASE WHEN count(*) < 1000 THEN 1 ELSE 0 END::BIGINT FROM edges"""
)
def quality_report(spark, sf_dir):
    return quality.refresh(B.traffic_events(spark, sf_dir), B.road_edges(spark, sf_dir))[2]


@query(f"WITH {B.silver_cte()} SELECT road_segment_id, vehicle_count, congestion_level, count(*) AS n_rows FROM silver GROUP BY 1, 2, 3")
def event_json(spark, sf_dir):
    """Events to outgoing JSON and back."""
    from trafficloom.operators.ingest import to_event_json

    out = to_event_json(_silver(spark, sf_dir).drop("congestion_level"))
    back = out.select(F.from_json("value", "road_segment_id long, vehicle_count long, congestion_level string").alias("e")).select("e.*")
    return back.groupBy("road_segment_id", "vehicle_count", "congestion_level").agg(F.count("*").alias("n_rows"))

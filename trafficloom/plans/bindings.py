"""Domain tables derived from the given tables by plain arithmetic, in Spark and (CTES) in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-31 00:00:00"
SALT_DATE = "2024-01-15"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def traffic_events(spark: SparkSession, sf_dir: str, segments: int = 0) -> DataFrame:
    """segments > 0 folds the segments to so many, for busier windows."""
    e = _events(spark, sf_dir)
    seg = F.col("user_id") % segments if segments else F.col("user_id")
    source = F.when(F.col("event_type") == "click", "telecom").when(F.col("event_type") == "view", "cctv").when(F.col("event_type") == "purchase", "fleet_gps").when(F.col("event_type") == "error", "incident").otherwise("weather")
    return e.select(
        "event_id", seg.alias("road_segment_id"), F.col("ts").alias("event_time"), F.when(F.col("k") % 13 != 0, F.col("value")).alias("avg_speed_kmh"),
        F.col("k").alias("vehicle_count"), (F.col("k") * 12.0).alias("flow_rate"), source.alias("source_type"), F.element_at(F.array(*[F.lit(x) for x in (1.0, 1.1, 1.2, 1.15)]), F.col("k") % 4 + 1).alias("weather_factor"),
    )


def road_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    lon, lat = 39.1 + (c % 30) * 0.01, -7.0 + ((c * 7) % 40) * 0.01
    point = lambda x, y: F.struct(x.alias("lon"), y.alias("lat"))
    kind = F.when(F.col("c_mktsegment") == "MACHINERY", "primary").when(F.col("c_mktsegment") == "FURNITURE", "secondary").when(F.col("c_mktsegment") == "BUILDING", "tertiary").otherwise("residential")
    return table(spark, sf_dir, "customer").select(
        c.alias("id"), F.col("c_name").alias("name"), F.floor(c / 3).alias("from_node_id"), F.floor((c + 7) / 3).alias("to_node_id"), kind.alias("road_type"),
        F.when(c % 11 != 0, 30 + 10 * (F.col("c_nationkey") % 6)).alias("speed_limit_kmh"), F.array(point(lon, lat), point(lon + ((c % 3) - 1) * 0.004, lat + 0.003)).alias("geom"),
    )


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telecom and fleet points of the same rows; some lie outside the area, some headings are invalid."""
    e, k, i = _events(spark, sf_dir), F.col("k"), F.col("event_id")
    return e.select(
        "event_id", F.col("user_id").cast("string").alias("device_id"), F.col("user_id").cast("string").alias("vehicle_id"), F.concat(F.lit("t"), F.floor(k / 50)).alias("tower_id"), F.lit("bus").alias("provider"),
        (-7.05 + (k % 50) * 0.01).alias("lat"), (39.05 + (i % 40) * 0.01).alias("lon"), F.col("value").alias("speed_kmh"), (i % 400).cast("double").alias("heading"), F.col("ts").alias("timestamp"),
    )


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    return e.select("event_id", F.col("user_id").cast("string").alias("id"), F.when(F.col("event_type") == "error", "accident").otherwise(F.col("event_type")).alias("incident_type"), F.lit(-6.8).alias("lat"), F.lit(39.2).alias("lon"), F.col("ts").alias("reported_at"), (F.col("k") % 8).alias("severity"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen boxes a vector; camera by label, frame by number."""
    e = table(spark, sf_dir, "embeddings")
    v = lambda i: F.element_at("embedding", i).cast("double") * 100.0
    kinds = F.array(*[F.lit(x) for x in ("car", "truck", "person", "bus")])
    box = lambda i: F.struct(F.struct(v(4 * i + 1).alias("x1"), v(4 * i + 2).alias("y1"), (v(4 * i + 3) + 30.0).alias("x2"), (v(4 * i + 4) + 20.0).alias("y2")).alias("bbox"), F.element_at(kinds, (F.col("vec_id") + i).cast("int") % 4 + 1).alias("class_name"), F.abs(F.element_at("embedding", 4 * i + 1).cast("double") * 4.0).alias("confidence"))
    return e.select(
        F.concat(F.lit("cam"), F.col("label")).alias("camera_id"), F.col("vec_id").alias("frame_index"), (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("vec_id").cast("decimal(18,6)"))).alias("frame_timestamp"),
        F.lit(100).alias("frame_width"), F.lit(80).alias("frame_height"), F.lit(2.0).alias("pixel_per_meter"), F.array(*[box(i) for i in range(16)]).alias("detections"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("road_segment_id"), F.col("o_orderdate").alias("predicted_at"), F.col("o_orderkey").alias("prediction_id"), (F.col("o_totalprice") / 10000.0).alias("predicted_speed_kmh"), F.lit("m1").alias("model_version"), F.lit(0.5).alias("confidence"))


E = "e AS (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events)"


def events_cte(segments: int = 0) -> str:
    seg = f"user_id % {segments}" if segments else "user_id"
    return f"""{E}, ev AS (SELECT event_id, {seg} AS road_segment_id, ts AS event_time, CASE WHEN k % 13 <> 0 THEN value END AS avg_speed_kmh, k AS vehicle_count, CAST(k * 12 AS DOUBLE) AS flow_rate,
  CASE event_type WHEN 'click' THEN 'telecom' WHEN 'view' THEN 'cctv' WHEN 'purchase' THEN 'fleet_gps' WHEN 'error' THEN 'incident' ELSE 'weather' END AS source_type,
  CAST(CASE k % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 1.1 WHEN 2 THEN 1.2 ELSE 1.15 END AS DOUBLE) AS weather_factor FROM e)"""


EDGES = """edges AS (SELECT c_custkey AS id, c_name AS name, c_custkey // 3 AS from_node_id, (c_custkey + 7) // 3 AS to_node_id,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'primary' WHEN 'FURNITURE' THEN 'secondary' WHEN 'BUILDING' THEN 'tertiary' ELSE 'residential' END AS road_type,
  CASE WHEN c_custkey % 11 <> 0 THEN 30 + 10 * (c_nationkey % 6) END AS speed_limit_kmh,
  39.1::DOUBLE + (c_custkey % 30) * 0.01::DOUBLE AS ax, -7.0::DOUBLE + ((c_custkey * 7) % 40) * 0.01::DOUBLE AS ay,
  39.1::DOUBLE + (c_custkey % 30) * 0.01::DOUBLE + ((c_custkey % 3) - 1) * 0.004::DOUBLE AS cx, -7.0::DOUBLE + ((c_custkey * 7) % 40) * 0.01::DOUBLE + 0.003::DOUBLE AS cy FROM customer)"""

PINGS = f"""{E}, pings AS (SELECT event_id, user_id::VARCHAR AS device_id, user_id::VARCHAR AS vehicle_id, 't' || (k // 50) AS tower_id, 'bus' AS provider,
  -7.05::DOUBLE + (k % 50) * 0.01::DOUBLE AS lat, 39.05::DOUBLE + (event_id % 40) * 0.01::DOUBLE AS lon, value AS speed_kmh, (event_id % 400)::DOUBLE AS heading, ts AS timestamp FROM e)"""

REPORTS = f"{E}, reports AS (SELECT event_id, user_id::VARCHAR AS id, CASE event_type WHEN 'error' THEN 'accident' ELSE event_type END AS incident_type, ts AS reported_at, k % 8 AS severity FROM e)"


def silver_cte(step: str = "5 minutes", dwell: float = 5.0, segments: int = 0) -> str:
    return f"""{events_cte(segments)}, {EDGES},
src AS (SELECT ev.*, coalesce(speed_limit_kmh, 50)::DOUBLE AS free_flow, time_bucket(INTERVAL '{step}', event_time) AS ws FROM ev LEFT JOIN edges ON edges.id = ev.road_segment_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY road_segment_id, ws ORDER BY event_time DESC, event_id DESC) AS rk FROM src),
win AS (SELECT road_segment_id, ws, ws + INTERVAL '{step}' AS we, sum(coalesce(vehicle_count, 0))::BIGINT AS vehicle_count, avg(avg_speed_kmh) AS avg_speed_kmh, sum(coalesce(flow_rate, 0.0)) AS flow_rate, max(free_flow) AS free_flow, max(CASE WHEN rk = 1 THEN weather_factor END) AS weather_factor FROM ranked GROUP BY 1, 2),
feat AS (SELECT *, greatest(max(vehicle_count) OVER w, 1) AS capacity, lag(avg_speed_kmh) OVER w AS upstream_speed_kmh,
  coalesce(avg_speed_kmh < {dwell} AND lag(avg_speed_kmh) OVER w < {dwell} AND lag(avg_speed_kmh, 2) OVER w < {dwell}, false) AS dwell_flag FROM win WINDOW w AS (PARTITION BY road_segment_id ORDER BY ws)),
scored AS (SELECT *, greatest(0.0::DOUBLE, least(1.0::DOUBLE, (1.0::DOUBLE - least(coalesce(avg_speed_kmh, 0.0) / nullif(free_flow, 0.0), 1.0::DOUBLE)) * 0.6::DOUBLE + least(vehicle_count::DOUBLE / nullif(capacity::DOUBLE, 0.0), 1.0::DOUBLE) * 0.4::DOUBLE)) AS score FROM feat),
silver AS (SELECT road_segment_id, ws AS event_time, we AS window_end, vehicle_count, avg_speed_kmh, flow_rate, upstream_speed_kmh, weather_factor, dwell_flag, score AS congestion_score,
  CASE WHEN round(score, 9) < 0.30 THEN 'free_flow' WHEN round(score, 9) < 0.50 THEN 'light' WHEN round(score, 9) < 0.70 THEN 'moderate' WHEN round(score, 9) < 0.90 THEN 'heavy' ELSE 'severe' END AS congestion_level, capacity FROM scored)"""

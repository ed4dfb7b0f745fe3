"""Fixed values of the data model: source schemas, enumerations, rules, topics."""

from __future__ import annotations

#: Flat payload of each source.
SOURCE_SCHEMAS = {
    "telecom": "device_id_hash string, tower_id string, lat double, lon double, timestamp timestamp, signal_strength int",
    "cctv": "camera_id string, frame_timestamp timestamp, vehicle_count int, avg_speed_kmh double, lane_occupancy double, queue_length_m double",
    "fleet_gps": "vehicle_id_hash string, provider string, lat double, lon double, speed_kmh double, heading double, timestamp timestamp",
    "incident": "id string, incident_type string, lat double, lon double, reported_at timestamp, source string, description string, severity int",
    "weather": "station_id string, timestamp timestamp, condition string, rainfall_mm double, visibility_m double, temperature_c double",
}
EVENT_TIME = {"telecom": "timestamp", "cctv": "frame_timestamp", "fleet_gps": "timestamp", "incident": "reported_at", "weather": "timestamp"}
#: Payload names that differ in the envelope's attributes.
ATTRIBUTE_NAMES = {"incident": {"id": "incident_id"}}
#: Topic of each source below a prefix, which is a parameter.
TOPICS = {"telecom": "raw.telecom", "cctv": "raw.cctv", "fleet_gps": "raw.fleet", "incident": "raw.incidents", "weather": "raw.weather", "fused": "processed.events"}
DLQ_TOPIC = "dlq"
TOPIC_PREFIX = "traffic"
CONGESTION_LEVELS = ("free_flow", "light", "moderate", "heavy", "severe")
INCIDENT_TYPES = ("accident", "roadblock", "construction", "flooding", "other")
WEATHER_CONDITIONS = ("clear", "rain", "heavy_rain", "fog")
#: South, west, north, east of the area served.
BBOX = (-7.0, 39.1, -6.6, 39.4)
MPH_TO_KMH = 1.60934
SCHEMA_VERSION = "1.0"
#: (name, condition that a good row meets) by contract; a condition that is null counts as met only where it says so.
CONTRACTS = {
    "telecom": (("device_id_hash", "device_id_hash is not null"), ("tower_id", "tower_id is not null"), ("lat", "lat is not null"), ("lon", "lon is not null"), ("timestamp", "timestamp is not null")),
    "cctv": (
        ("camera_id", "camera_id is not null"),
        ("frame_timestamp", "frame_timestamp is not null"),
        ("vehicle_count", "vehicle_count >= 0"),
        ("avg_speed_kmh", "avg_speed_kmh is null or avg_speed_kmh >= 0"),
        ("lane_occupancy", "lane_occupancy between 0 and 1"),
        ("queue_length_m", "queue_length_m is null or queue_length_m >= 0"),
    ),
    "fleet_gps": (("vehicle_id_hash", "vehicle_id_hash is not null"), ("lat", "lat is not null"), ("lon", "lon is not null"), ("timestamp", "timestamp is not null"), ("speed_kmh", "speed_kmh >= 0"), ("heading", "heading is null or heading between 0 and 360")),
    "incident": (("id", "id is not null"), ("incident_type", f"incident_type in {INCIDENT_TYPES}"), ("lat", "lat is not null"), ("lon", "lon is not null"), ("reported_at", "reported_at is not null"), ("severity", "severity between 1 and 5")),
    "weather": (("station_id", "station_id is not null"), ("timestamp", "timestamp is not null"), ("condition", f"condition in {WEATHER_CONDITIONS}"), ("rainfall_mm", "rainfall_mm >= 0"), ("visibility_m", "visibility_m >= 0")),
    "prediction": (("congestion_prob", "congestion_prob between 0 and 1"), ("confidence", "confidence is null or confidence between 0 and 1"), ("horizon_minutes", "horizon_minutes in (10, 20, 30)")),
    "event": (("road_segment_id", "road_segment_id is not null"), ("event_time", "event_time is not null"), ("congestion_score", "congestion_score between 0 and 1")),
}

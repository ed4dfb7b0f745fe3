"""Queries over ingestion, contracts and the stateful rules' batch twins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from trafficloom.functions import text as X
from trafficloom.functions import weather as W
from trafficloom.operators import ingest, normalize, stateful
from trafficloom.sources import sinks

from . import bindings as B
from .common import registry, rounded

QUERIES, ORACLES, query = registry()
_MPH = "1.60934::DOUBLE"


def _salt():
    return F.lit(B.SALT_DATE).cast("date")


@query(f"WITH {B.PINGS} SELECT event_id, round(lat, 6) AS lat, round(lon, 6) AS lon, round(speed_kmh * {_MPH}, 6) AS speed_kmh, round(speed_kmh, 6) AS speed_mph, timestamp AS event_time FROM pings")
def normalize_fleet(spark, sf_dir):
    raw = B.pings(spark, sf_dir).select("event_id", F.col("lat").alias("latitude"), F.col("lon").alias("lng"), F.col("speed_kmh").alias("speed_mph"), "timestamp")
    return rounded(normalize.normalize(raw, "fleet_gps"))


@query(f"WITH {B.events_cte()}, m AS (SELECT road_segment_id, median(avg_speed_kmh) AS md FROM ev GROUP BY 1) SELECT event_id, ev.road_segment_id, round(coalesce(avg_speed_kmh, md), 6) AS avg_speed_kmh FROM ev LEFT JOIN m USING (road_segment_id)")
def fill_speed(spark, sf_dir):
    e = B.traffic_events(spark, sf_dir)
    return rounded(normalize.fill_speed(e.select("event_id", "road_segment_id", "avg_speed_kmh"), normalize.speed_lookup(e)))


_HASH = f"sha256(device_id || '{B.SALT_DATE}')"


@query(f"WITH {B.PINGS} SELECT event_id, {_HASH} AS device_id_hash FROM pings")
def pseudonymize(spark, sf_dir):
    return ingest.pseudonymize(B.pings(spark, sf_dir).select("event_id", "device_id"), "device_id", _salt())


@query(f"WITH {B.PINGS} SELECT event_id, CASE WHEN heading > 360 THEN '[heading]' ELSE '[]' END AS errors FROM pings")
def validate_fleet(spark, sf_dir):
    rows = normalize.validate(ingest.pseudonymize(B.pings(spark, sf_dir), "vehicle_id", _salt()), "fleet_gps")
    return rows.select("event_id", F.concat(F.lit("["), F.array_join("errors", ", "), F.lit("]")).alias("errors"))


def _miss(c: str, j: int) -> str:
    """The column, or null in every twelfth event."""
    return f"CASE WHEN event_id % 12 <> {j} THEN {c} END"


def _pick(*values: str) -> str:
    """One of some texts, by k."""
    return "CASE k % {} {} END".format(len(values), " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)))


#: A row of each contract per event: its columns, as expressions that both engines read alike, and for the twin what breaks each rule.
_CONTRACT_ROWS = {
    "telecom": {"device_id_hash": _miss("'d'", 0), "tower_id": _miss("'t'", 1), "lat": _miss("1.0", 2), "lon": _miss("1.0", 3), "timestamp": _miss("ts", 4)},
    "cctv": {"camera_id": _miss("'c'", 0), "frame_timestamp": _miss("ts", 1), "vehicle_count": _miss("k % 50 - 5", 2), "avg_speed_kmh": _miss("k % 50 - 10", 3), "lane_occupancy": _miss("(k % 50 - 4) / 40.0", 4), "queue_length_m": _miss("k % 50 - 3", 5)},
    "fleet_gps": {"vehicle_id_hash": _miss("'v'", 0), "lat": _miss("1.0", 1), "lon": _miss("1.0", 2), "timestamp": _miss("ts", 3), "speed_kmh": _miss("k % 50 - 4", 4), "heading": _miss("(k % 50 - 2) * 8", 5)},
    "incident": {"id": _miss("'i'", 0), "incident_type": _miss(_pick("accident", "roadblock", "construction", "flooding", "other", "riot"), 1), "lat": _miss("1.0", 2), "lon": _miss("1.0", 3), "reported_at": _miss("ts", 4), "severity": _miss("k % 7", 5)},
    "weather": {"station_id": _miss("'s'", 0), "timestamp": _miss("ts", 1), "condition": _miss(_pick("clear", "rain", "heavy_rain", "fog", "snow"), 2), "rainfall_mm": _miss("k % 50 - 2", 3), "visibility_m": _miss("k % 50 - 6", 4)},
    "prediction": {"congestion_prob": _miss("(k % 50 - 4) / 40.0", 0), "confidence": _miss("(k % 50 - 3) / 42.0", 1), "horizon_minutes": _miss("10 * (k % 5)", 2)},
    "event": {"road_segment_id": _miss("user_id", 0), "event_time": _miss("ts", 1), "congestion_score": _miss("(k % 50 - 2) / 44.0", 2)},
}
_BROKEN = {
    "vehicle_count": "vehicle_count IS NULL OR vehicle_count < 0", "avg_speed_kmh": "avg_speed_kmh < 0", "lane_occupancy": "lane_occupancy IS NULL OR lane_occupancy < 0 OR lane_occupancy > 1", "queue_length_m": "queue_length_m < 0",
    "speed_kmh": "speed_kmh IS NULL OR speed_kmh < 0", "heading": "heading < 0 OR heading > 360", "incident_type": "incident_type IS NULL OR incident_type = 'riot'", "severity": "severity IS NULL OR severity < 1 OR severity > 5",
    "condition": "condition IS NULL OR condition = 'snow'", "rainfall_mm": "rainfall_mm IS NULL OR rainfall_mm < 0", "visibility_m": "visibility_m IS NULL OR visibility_m < 0", "congestion_prob": "congestion_prob IS NULL OR congestion_prob < 0 OR congestion_prob > 1",
    "confidence": "confidence < 0 OR confidence > 1", "horizon_minutes": "horizon_minutes IS NULL OR horizon_minutes < 10 OR horizon_minutes > 30", "congestion_score": "congestion_score IS NULL OR congestion_score < 0 OR congestion_score > 1",
}


def _contract_sql(contract: str, columns: dict[str, str]) -> str:
    rows = ", ".join(f"{sql} AS {c}" for c, sql in columns.items())
    errors = ", ".join(f"CASE WHEN {_BROKEN.get(c, f'{c} IS NULL')} THEN '{c}' END" for c in columns)
    return f"SELECT event_id, '{contract}' AS contract, array_to_string(list_filter([{errors}], lambda x: x IS NOT NULL), ', ') AS errors FROM (SELECT event_id, {rows} FROM e)"


@query(f"WITH {B.E} " + " UNION ALL ".join(_contract_sql(c, columns) for c, columns in _CONTRACT_ROWS.items()))
def contract_rules(spark, sf_dir):
    """Which rules of each contract a row of every event breaks; each rule is met by some rows and broken by others."""
    e = B._events(spark, sf_dir)
    checked = [normalize.validate(e.select("event_id", *[F.expr(sql).alias(c) for c, sql in columns.items()]), contract).select("event_id", F.lit(contract).alias("contract"), F.array_join("errors", ", ").alias("errors")) for contract, columns in _CONTRACT_ROWS.items()]
    return reduce(lambda a, b: a.unionByName(b), checked)


_BAD = "severity NOT BETWEEN 1 AND 5 OR incident_type NOT IN ('accident', 'roadblock', 'construction', 'flooding', 'other')"
_MSG = "'invalid: ' || array_to_string(list_filter([CASE WHEN incident_type NOT IN ('accident', 'roadblock', 'construction', 'flooding', 'other') THEN 'incident_type' END, CASE WHEN severity NOT BETWEEN 1 AND 5 THEN 'severity' END], lambda x: x IS NOT NULL), ', ')"


@query(f"WITH {B.REPORTS} SELECT event_id, 'valid' AS outcome, NULL AS error_type, NULL AS error_message, NULL AS source_topic FROM reports WHERE NOT ({_BAD}) UNION ALL SELECT event_id, 'dlq', 'validation_error', {_MSG}, 'traffic.raw.incidents' FROM reports WHERE {_BAD}")
def dlq_split(spark, sf_dir):
    good, dead = normalize.split_valid_dlq(B.reports(spark, sf_dir), "incident", "traffic.raw.incidents", F.lit(B.AS_OF).cast("timestamp"))
    text = lambda: F.lit(None).cast("string")
    a = good.select("event_id", F.lit("valid").alias("outcome"), text().alias("error_type"), text().alias("error_message"), text().alias("source_topic"))
    b = dead.select(F.get_json_object("original_payload", "$.event_id").cast("long").alias("event_id"), F.lit("dlq").alias("outcome"), "error_type", "error_message", "source_topic")
    return a.unionByName(b)


_TELECOM = f"""{B.PINGS}, h AS (SELECT *, {_HASH} AS device_id_hash, lat BETWEEN -7.0 AND -6.6 AND lon BETWEEN 39.1 AND 39.4 AS inside FROM pings),
n AS (SELECT *, CASE WHEN lag(tower_id) OVER w IS DISTINCT FROM tower_id THEN 1 ELSE 0 END AS new FROM h WHERE inside WINDOW w AS (PARTITION BY device_id ORDER BY timestamp, event_id)),
st AS (SELECT *, sum(new) OVER (PARTITION BY device_id ORDER BY timestamp, event_id ROWS UNBOUNDED PRECEDING) AS stay FROM n),
r AS (SELECT *, timestamp >= min(timestamp) OVER (PARTITION BY device_id, stay) + INTERVAL 15 MINUTE AS residential FROM st),
tel AS (SELECT event_id, device_id_hash, 'bbox' AS outcome FROM h WHERE NOT inside UNION ALL SELECT event_id, device_id_hash, CASE WHEN residential THEN 'residential' ELSE 'published' END FROM r)"""


@query(f"WITH {_TELECOM} SELECT * FROM tel")
def telecom_bronze(spark, sf_dir):
    return ingest.telecom_bronze(B.pings(spark, sf_dir), _salt()).select("event_id", "device_id_hash", "outcome")


@query(f"WITH {_TELECOM} SELECT 'telecom' AS source, outcome, count(*) AS n_rows FROM tel GROUP BY 2")
def ingest_counts(spark, sf_dir):
    return ingest.ingest_counts(ingest.telecom_bronze(B.pings(spark, sf_dir), _salt()), "telecom")


@query(f"WITH {B.PINGS} SELECT event_id, sha256(vehicle_id || '{B.SALT_DATE}') AS vehicle_id_hash, CASE WHEN heading > 360 THEN 'invalid' ELSE 'published' END AS outcome FROM pings")
def fleet_bronze(spark, sf_dir):
    return ingest.fleet_bronze(B.pings(spark, sf_dir), _salt()).select("event_id", "vehicle_id_hash", "outcome")


@query(f"WITH {B.PINGS} SELECT event_id, CASE WHEN lat BETWEEN -7.0 AND -6.6 AND lon BETWEEN 39.1 AND 39.4 THEN true ELSE false END AS inside, round(greatest(-7.0, least(-6.6, lat)), 6) AS lat, round(greatest(39.1, least(39.4, lon)), 6) AS lon FROM pings")
def clamp_points(spark, sf_dir):
    from trafficloom import schemas as S
    from trafficloom.functions import traffic as T

    south, west, north, east = S.BBOX
    return rounded(B.pings(spark, sf_dir).select("event_id", T.in_bbox(F.col("lat"), F.col("lon"), S.BBOX).alias("inside"), T.clamp(F.col("lat"), south, north).alias("lat"), T.clamp(F.col("lon"), west, east).alias("lon")))


@query(f"WITH {B.PINGS} SELECT event_id, 'telecom' AS source_type, {_HASH} AS device_id_hash, tower_id, round(lat, 6) AS lat, round(lon, 6) AS lon, timestamp, true AS parsed FROM pings")
def envelope_round_trip(spark, sf_dir):
    p = ingest.pseudonymize(B.pings(spark, sf_dir).select("event_id", "device_id", "tower_id", "lat", "lon", F.col("timestamp").cast("timestamp").alias("timestamp")), "device_id", _salt())
    # the flat payload of even rows, the envelope of odd ones: both are read
    wrapped = ingest.wrap_envelope(p, "telecom", "timestamp", attrs=["event_id", "device_id_hash", "tower_id"], id_cols=["event_id"])
    flat = p.where("event_id % 2 = 0").select(F.to_json(F.struct("event_id", "device_id_hash", "tower_id", "lat", "lon", "timestamp"), sinks.JSON).alias("value"))
    both = flat.unionByName(wrapped.where(F.get_json_object("attributes", "$.event_id").cast("long") % 2 == 1).select(F.to_json(F.struct("*"), sinks.JSON).alias("value")))
    # attributes travel as JSON text: as an object in the message
    both = both.withColumn("value", F.regexp_replace(F.regexp_replace(F.regexp_replace("value", r'"attributes":"\{', '"attributes":{'), r'\}","message_id"', '},"message_id"'), r'\\"', '"'))
    rows = normalize.deserialize(both, "telecom")
    event = F.coalesce(F.get_json_object("value", "$.event_id"), F.get_json_object("value", "$.attributes.event_id")).cast("long")
    return rounded(rows.select(event.alias("event_id"), "source_type", "device_id_hash", "tower_id", "lat", "lon", W.utc_ntz(F.col("timestamp")).alias("timestamp"), "parsed"))


_WJSON = """'{"name": "st' || user_id || '", "dt": ' || (1704067200 + event_id) || ', "weather": [{"main": "' || CASE k % 4 WHEN 0 THEN 'Rain' WHEN 1 THEN 'Fog' WHEN 2 THEN 'Clear' ELSE 'Clouds' END || '", "description": "' || CASE k % 5 WHEN 0 THEN 'heavy rain' WHEN 1 THEN 'mist' ELSE 'few clouds' END || '"}], "rain": {"3h": ' || (k % 10) || '}, "visibility": ' || (k * 100) || ', "main": {"temp": ' || k || '}}'"""


@query(f"""WITH {B.E} SELECT event_id, 'st' || user_id AS station_id, make_timestamp((1704067200 + event_id) * 1000000) AS timestamp,
 CASE WHEN k % 10 >= 7.5 OR k % 5 = 0 THEN 'heavy_rain' WHEN k % 4 = 1 OR k % 5 = 1 THEN 'fog' WHEN k % 4 = 0 THEN 'rain' ELSE 'clear' END AS condition, (k % 10)::DOUBLE AS rainfall_mm, (k * 100)::DOUBLE AS visibility_m, k::DOUBLE AS temperature_c FROM e""")
def weather_readings(spark, sf_dir):
    e = B._events(spark, sf_dir)
    return ingest.weather_readings(e.select("event_id", F.expr(_WJSON).alias("value")))


_ISO = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")"
_TEXT = "'type x; severity = ' || (k % 8) || ', incident_type=accident; lat: -6.8' || '\\n' || 'lon=39.2; description = a=b; reported_at=' || " + _ISO
_HOOK = f"""CASE k % 5
 WHEN 0 THEN '{{"incident": {{"id": "' || event_id || '", "incident_type": "accident", "severity": ' || (k % 8) || ', "lat": -6.8, "lon": 39.2, "description": "a=b", "reported_at": "' || {_ISO} || 'Z"}}}}'
 WHEN 1 THEN to_json(named_struct('body', 'id=' || event_id || ';' || {_TEXT}))
 WHEN 2 THEN to_json(named_struct('entry', array(named_struct('changes', array(named_struct('value', named_struct('messages', array(named_struct('id', 'm', 'text', named_struct('body', '{{"id": "' || event_id || '", "incident_type": "accident", "severity": ' || (k % 8) || ', "lat": -6.8, "lon": 39.2, "description": "a=b", "reported_at": "' || {_ISO} || '"}}'))))))))))
 WHEN 3 THEN '{{"incident_type": "accident", "id": "' || event_id || '", "severity": ' || (k % 8) || ', "lat": -6.8, "lon": 39.2, "description": "a=b", "reported_at": "' || {_ISO} || '+00:00"}}'
 ELSE '{{"text": "nothing to read"}}' END"""


@query(f"WITH {B.E} SELECT event_id, 'report' AS outcome, event_id::VARCHAR AS id, 'accident' AS incident_type, -6.8::DOUBLE AS lat, 39.2::DOUBLE AS lon, date_trunc('second', ts)::TIMESTAMP AS reported_at, 'whatsapp' AS source, 'a=b' AS description, (k % 8)::INTEGER AS severity FROM e WHERE k % 5 < 4 UNION ALL SELECT event_id, 'message cannot be read', NULL, NULL, NULL, NULL, NULL, NULL, NULL, -1 FROM e WHERE k % 5 = 4")
def incident_extract(spark, sf_dir):
    e = B._events(spark, sf_dir)
    rows = ingest.read_incidents(e.select("event_id", F.expr(_HOOK).alias("value")))
    found = F.col("report").isNotNull()
    fields = F.when(found, F.struct(*ingest.report_columns(id_cols=["event_id"])))
    out = rows.select("event_id", F.when(found, "report").otherwise(F.col("error")).alias("outcome"), fields.alias("r")).select("event_id", "outcome", "r.*")
    return out.withColumn("severity", F.coalesce("severity", F.lit(-1)))


@query(f"WITH {B.E} SELECT event_id, (k % 8)::VARCHAR AS severity, '-6.8' AS lat, 'a=b' AS description, 6 AS n_keys FROM e")
def kv_text(spark, sf_dir):
    e = B._events(spark, sf_dir).select("event_id", X.parse_kv_text(F.expr(_TEXT)).alias("m"))
    return e.select("event_id", *[F.col("m")[c].alias(c) for c in ("severity", "lat", "description")], F.size("m").alias("n_keys"))


@query(f"WITH {B.events_cte(10)} SELECT event_id, road_segment_id, source_type, event_time FROM ev QUALIFY row_number() OVER (PARTITION BY road_segment_id, source_type, time_bucket(INTERVAL '1 hour', event_time) ORDER BY event_time, event_id) = 1")
def dedup_bucket(spark, sf_dir):
    rows = B.traffic_events(spark, sf_dir, 10).select("event_id", "road_segment_id", "source_type", "event_time")
    return stateful.dedup_bucketed(rows, ["road_segment_id", "source_type"], bucket="1 hour")


@query(f"""WITH {B.events_cte(3)}, w AS (SELECT road_segment_id, time_bucket(INTERVAL '1 hour', event_time) AS event_time, avg(avg_speed_kmh) AS v FROM ev GROUP BY 1, 2),
f AS (SELECT *, coalesce(v, 0) < 60 AS slow, event_time = lag(event_time) OVER o + INTERVAL 1 HOUR AS nxt FROM w WINDOW o AS (PARTITION BY road_segment_id ORDER BY event_time)),
r AS (SELECT *, coalesce(slow AND lag(slow) OVER o AND lag(slow, 2) OVER o AND nxt AND lag(nxt) OVER o, false) AS ends FROM f WINDOW o AS (PARTITION BY road_segment_id ORDER BY event_time))
SELECT road_segment_id, event_time, round(v, 6) AS avg_speed_kmh, bool_or(ends) OVER (PARTITION BY road_segment_id ORDER BY event_time ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS incident_flag FROM r""")
def dwell_anchor(spark, sf_dir):
    e = B.traffic_events(spark, sf_dir, 3)
    hours = e.groupBy("road_segment_id", F.window("event_time", "1 hour").start.alias("event_time")).agg(F.avg("avg_speed_kmh").alias("avg_speed_kmh"))
    return rounded(stateful.dwell_anchor(hours, "1 hour", threshold=60.0))


@query(f"""WITH RECURSIVE {B.REPORTS}, o AS (SELECT id, event_id, reported_at, row_number() OVER (PARTITION BY id ORDER BY reported_at, event_id) AS rn FROM reports),
f AS (SELECT id, event_id, rn, reported_at AS last, true AS kept FROM o WHERE rn = 1 UNION ALL SELECT o.id, o.event_id, o.rn, CASE WHEN o.reported_at >= f.last + INTERVAL 12 HOUR THEN o.reported_at ELSE f.last END, o.reported_at >= f.last + INTERVAL 12 HOUR FROM f JOIN o ON o.id = f.id AND o.rn = f.rn + 1)
SELECT event_id, id FROM f WHERE kept""")
def incident_ttl(spark, sf_dir):
    return stateful.dedup_ttl(B.reports(spark, sf_dir), ttl_s=12 * 3600).select("event_id", "id")


@query(f"""WITH RECURSIVE {B.REPORTS}, o AS (SELECT id, event_id, reported_at, row_number() OVER (PARTITION BY id ORDER BY reported_at, event_id) AS rn FROM reports),
f AS (SELECT id, event_id, rn, [reported_at] AS taken, true AS accepted FROM o WHERE rn = 1 UNION ALL
 SELECT id, event_id, rn, CASE WHEN len(alive) < 2 THEN list_append(alive, reported_at) ELSE alive END, len(alive) < 2 FROM (SELECT o.id, o.event_id, o.rn, o.reported_at, list_filter(f.taken, lambda x: o.reported_at < x + INTERVAL 1 DAY) AS alive FROM f JOIN o ON o.id = f.id AND o.rn = f.rn + 1))
SELECT event_id, id, accepted FROM f""")
def rate_limit(spark, sf_dir):
    return stateful.rate_limit(B.reports(spark, sf_dir).select("event_id", "id", "reported_at"), "id", "reported_at", 2, 86_400.0).select("event_id", "id", "accepted")


@query(f"WITH {B.events_cte()} SELECT source_type, CASE source_type WHEN 'fleet_gps' THEN 'traffic.raw.fleet' WHEN 'incident' THEN 'traffic.raw.incidents' ELSE 'traffic.raw.' || source_type END AS topic, count(*) AS n_rows FROM ev GROUP BY 1, 2")
def kafka_topics(spark, sf_dir):
    rows = sinks.to_kafka_rows(B.traffic_events(spark, sf_dir), "source_type")
    return rows.groupBy(F.get_json_object("value", "$.source_type").alias("source_type"), "topic").agg(F.count("*").alias("n_rows"))


@query(f"WITH {B.events_cte(10)}, r AS (SELECT road_segment_id, time_bucket(INTERVAL '1 hour', event_time) AS event_time, event_id, vehicle_count FROM ev) SELECT road_segment_id, event_time, arg_max(vehicle_count, event_id)::INTEGER AS vehicle_count FROM r GROUP BY 1, 2")
def upsert_merge(spark, sf_dir):
    rows = B.traffic_events(spark, sf_dir, 10).select("road_segment_id", F.window("event_time", "1 hour").start.alias("event_time"), "event_id", "vehicle_count")
    keys = ["road_segment_id", "event_time"]
    from trafficloom.operators.windows import latest_per_key

    batch = lambda c: latest_per_key(rows.where(c), keys, ["event_id"])
    return sinks.merge_latest(batch("event_id % 3 <> 0"), batch("true"), keys).select(*keys, "vehicle_count")

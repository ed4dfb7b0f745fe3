"""Golden values of contracts, ingestion chains, stateful rules, sinks and streams."""

import json
from datetime import date, datetime, timedelta
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from trafficloom.functions.text import parse_kv_text
from trafficloom.functions.weather import parse_any_timestamp
from trafficloom.operators import cv, ingest, normalize, spatial, stateful, windows
from trafficloom.sources import readers, sinks
from trafficloom.streaming import silver

AT = datetime(2026, 4, 29, 8, 0)


def test_contracts(spark):
    fleet = spark.createDataFrame([("v", "p", -6.8, 39.2, -1.0, 10.0, AT), ("v", "p", -6.8, 39.2, 5.0, None, AT)], "vehicle_id_hash string, provider string, lat double, lon double, speed_kmh double, heading double, timestamp timestamp_ntz")
    assert [r.errors for r in normalize.validate(fleet, "fleet_gps").collect()] == [["speed_kmh"], []]
    inc = spark.createDataFrame([(str(k), "accident", -6.8, 39.2, AT, k) for k in (0, 1, 5, 6)], "id string, incident_type string, lat double, lon double, reported_at timestamp_ntz, severity int")
    assert [len(r.errors) for r in normalize.validate(inc, "incident").collect()] == [1, 0, 0, 1]


def test_dead_letter(spark):
    raw = spark.createDataFrame([(None, json.dumps({"value": 42})), (None, "not json"), (None, None)], "key string, value string")
    good, dead = normalize.split_valid_dlq(normalize.deserialize(raw, "telecom"), "telecom", "traffic.raw.telecom")
    assert good.count() == 0 and [r.error_type for r in dead.collect()][0] == "validation_error"
    first = dead.first()
    assert json.loads(first.original_payload) == {"value": 42} and first.source_topic == "traffic.raw.telecom"
    with pytest.raises(ValueError, match="unknown source"):
        normalize.deserialize(raw, "nope")


def test_telecom_chain(spark):
    rows = [(1, "device-a", "t1", -8.0, 39.2, AT), (2, "device-b", "t1", -6.8, 39.2, AT), (3, "device-b", "t1", -6.8, 39.2, AT + timedelta(minutes=16)), (4, "device-c", "t2", -6.8, 39.2, AT + timedelta(minutes=20))]
    df = spark.createDataFrame(rows, "event_id long, device_id string, tower_id string, lat double, lon double, timestamp timestamp_ntz")
    got = {r.event_id: r for r in ingest.telecom_bronze(df, F.lit(date(2026, 4, 29))).collect()}
    assert [got[k].outcome for k in (1, 2, 3, 4)] == ["bbox", "published", "residential", "published"]
    one = ingest.pseudonymize(spark.createDataFrame([("device-123",)], "device_id string"), "device_id", F.lit(date(2026, 4, 29))).first()
    assert one.device_id_hash == sha256(b"device-1232026-04-29").hexdigest()


def test_rate_limit_and_ttl(spark):
    rows = [(k, "k", AT) for k in range(101)]
    df = spark.createDataFrame(rows, "event_id long, key string, ts timestamp_ntz")
    got = stateful.rate_limit(df, "key", "ts")
    assert got.where("accepted").count() == 100 and not [r.accepted for r in got.orderBy("event_id").collect()][-1]
    inc = spark.createDataFrame([(1, "a", AT), (2, "a", AT + timedelta(minutes=29)), (3, "a", AT + timedelta(minutes=30)), (4, "b", AT)], "event_id long, id string, reported_at timestamp_ntz")
    assert sorted(r.event_id for r in stateful.dedup_ttl(inc).collect()) == [1, 3, 4]


def test_weather(spark):
    body = json.dumps({"name": "Dar", "dt": 1714468200, "weather": [{"main": "Rain", "description": "heavy rain"}], "rain": {"1h": 8.1}, "visibility": 7000, "main": {"temp": 27.4}})
    r = ingest.weather_readings(spark.createDataFrame([(body,), ("[]",)], "value string")).collect()
    assert len(r) == 1 and (r[0].condition, r[0].rainfall_mm, r[0].visibility_m, r[0].temperature_c, r[0].station_id) == ("heavy_rain", 8.1, 7000.0, 27.4, "Dar")
    assert r[0].timestamp == datetime(2024, 4, 30, 9, 10)
    stamps = ["2024-04-30T09:10:00Z", "2024-04-30T12:10:00+03:00", "2024-04-30T09:10:00", "1714468200", "nonsense", None]
    got = spark.createDataFrame([(s,) for s in stamps], "s string").select(parse_any_timestamp(F.col("s"), F.lit(AT)).alias("t")).collect()
    assert [x.t for x in got] == [datetime(2024, 4, 30, 9, 10)] * 4 + [AT] * 2


def test_webhook_and_text(spark):
    inner = json.dumps({"id": "i1", "incident_type": "roadblock", "severity": 4, "lat": -6.8, "lon": 39.2, "reported_at": "2026-04-30T08:16:00Z"})
    hook = json.dumps({"entry": [{"changes": [{"value": {"messages": [{"id": "m", "text": {"body": inner}}]}}]}]})
    good, dead = ingest.extract_incidents(spark.createDataFrame([(hook,), (json.dumps({"body": "no pairs"}),), (json.dumps({"x": 1}),)], "value string"))
    [r] = good.collect()
    assert (r.id, r.incident_type, r.severity, r.source, r.reported_at) == ("i1", "roadblock", 4, "whatsapp", datetime(2026, 4, 30, 8, 16))
    assert sorted(x.error_message for x in dead.collect()) == ["message cannot be read", "unsupported payload"]
    texts = spark.createDataFrame([("a=1; b: 2\na = 3, c=x=y",), ("nothing",), ("",), (None,)], "t string").select(parse_kv_text(F.col("t")).alias("m")).collect()
    assert [x.m for x in texts] == [{"a": "3", "b": "2", "c": "x=y"}, None, None, None]


def test_camera_metrics(spark):
    def box(*b):
        return ((*map(float, b),), "car", 0.9)

    rows = [("c", 0, AT, 100, 100, 2.0, [box(0, 10, 20, 30), box(30, 40, 50, 60)]), ("c", 1, AT + timedelta(seconds=1), 100, 100, 2.0, [box(10, 10, 30, 30), box(40, 40, 60, 60)]), ("c", 2, AT + timedelta(seconds=2), 100, 100, 2.0, [])]
    df = spark.createDataFrame(rows, f"camera_id string, frame_index long, frame_timestamp timestamp_ntz, frame_width int, frame_height int, pixel_per_meter double, detections array<{cv.DETECTION}>")
    got = cv.cv_metrics(df).orderBy("frame_index").collect()
    assert (got[1].vehicle_count, got[1].avg_speed_kmh, got[1].lane_occupancy, got[1].queue_length_m) == (2, 18.0, 0.08, 15.0)
    assert (got[2].vehicle_count, got[2].avg_speed_kmh, got[2].lane_occupancy, got[2].queue_length_m) == (0, None, 0.0, None)
    tracks = spark.createDataFrame([(2.0, [(0.0, 0.0, 10.0, 0.0, 1), (0.0, 0.0, 99.0, 0.0, 0)]), (2.0, [])], "pixel_per_meter double, tracks array<struct<x0:double,y0:double,x1:double,y1:double,status:int>>")
    assert [r.tracked_kmh for r in cv.tracked_speed(tracks).collect()] == [18.0, None]
    with pytest.raises(Exception, match="JSON object"):
        cv.camera_dimension(spark.createDataFrame([("[1]",)], "value string")).collect()


def roads(spark):
    rows = [(101, [(39.0, -7.0), (39.1, -7.0), (39.1, -6.9), (39.0, -6.9)]), (202, [(39.2, -7.0), (39.3, -7.0), (39.3, -6.9), (39.2, -6.9)])]
    return spark.createDataFrame(rows, "road_segment_id long, buffer_geom array<struct<lon:double,lat:double>>")


POINTS = "source_type string, latitude double, longitude double, speed_mph double, timestamp timestamp, flow double"


def points():
    at = lambda h, m, s: datetime(2026, 4, 29, h, m, s)
    return [("fleet_gps", -6.95, 39.05, 30.0, at(8, 15, 1), 1.0), ("fleet_gps", -6.95, 39.05, 30.0, at(8, 15, 4), 1.0), ("fleet_gps", -6.95, 39.05, 42.0, at(8, 15, 22), 2.0), ("fleet_gps", -6.95, 39.25, 36.0, at(9, 5, 5), 3.0), ("fleet_gps", -6.95, 38.0, 36.0, at(9, 5, 5), 3.0)]


def test_silver_chain_as_stream_and_table(spark, tmp_path):
    spark.createDataFrame(points(), POINTS).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(POINTS).parquet(str(tmp_path / "in"))
    target, archive = str(tmp_path / "out"), str(tmp_path / "archive")
    sink = silver.table_sink(target, archive)
    silver.start_silver(silver.silver_stream(stream, "fleet_gps", roads(spark)), sink, str(tmp_path / "ck"), available_now=True).awaitTermination()
    want = [(101, datetime(2026, 4, 29, 8, 15), 2, 57.93624, 3.0), (202, datetime(2026, 4, 29, 9, 5), 1, 57.93624, 3.0)]
    got = spark.read.parquet(target).orderBy("road_segment_id").select("road_segment_id", "event_time", "vehicle_count", F.round("avg_speed_kmh", 5), "flow_rate").collect()
    assert [tuple(r) for r in got] == want
    assert spark.read.parquet(archive).count() == 2
    plan = spatial.spatial_within(spark.createDataFrame([(1.0, 1.0)], "lon double, lat double"), roads(spark))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_upsert_and_archive_replays(spark, tmp_path):
    target = str(tmp_path / "t")
    kind = "road_segment_id long, event_time timestamp_ntz, vehicle_count long"
    first = spark.createDataFrame([(k, AT, k) for k in range(501)], kind)
    for _ in range(2):
        sinks.upsert_batch(first, 1, target, ["road_segment_id", "event_time"])
    sinks.upsert_batch(spark.createDataFrame([(3, AT, 99), (900, AT + timedelta(days=1), 1), (None, AT, 5)], kind), 2, target, ["road_segment_id", "event_time"])
    sinks.upsert_batch(spark.createDataFrame([], kind), 3, target, ["road_segment_id", "event_time"])
    got = {r.road_segment_id: r.vehicle_count for r in spark.read.parquet(target).collect()}
    assert len(got) == 502 and got[3] == 99 and got[900] == 1
    rows = spark.createDataFrame([(10, AT.replace(minute=15)), (11, AT.replace(minute=45)), (12, AT + timedelta(hours=1, minutes=5)), (13, None)], "vehicle_count int, event_time timestamp_ntz")
    for _ in range(2):
        sinks.write_hour_partitions(rows, 88, str(tmp_path / "a"))
    read = lambda h: sorted(r.vehicle_count for r in spark.read.parquet(str(tmp_path / "a" / "checkpoint_date=2026-04-29" / f"checkpoint_hour={h}")).collect())
    assert read("08") == [10, 11] and read("09") == [12]


def test_landing_files(spark, tmp_path):
    for name, body in (("a", '[{"id": 1}, {"id": 2}]'), ("b", '{"id": 3}'), ("c", "oops")):
        (tmp_path / name).write_text(body)
    got = readers.read_landing_json(spark, str(tmp_path), "id int").collect()
    assert sorted((r.id or 0, r._corrupt or "") for r in got) == [(0, "oops"), (0, '{"id": 3}'), (1, ""), (2, "")]
    assert {r.id for r in readers.read_landing_json(spark, str(tmp_path), "id int", top="object").collect()} == {3, None}


def test_kafka_columns_and_latest(spark):
    raw = spark.createDataFrame([(bytearray(b"k"), bytearray(b"{}"), "t", 0, 5)], "key binary, value binary, topic string, partition int, offset long")
    assert tuple(readers.with_kafka_columns(raw).first()) == ("k", "{}", "t", 0, 5)
    df = spark.createDataFrame([(1, AT, "old"), (1, AT + timedelta(minutes=5), "new"), (2, AT - timedelta(hours=1), "stale")], "k int, ts timestamp_ntz, v string")
    assert [(r.k, r.v) for r in windows.latest_within(df, ["k"], "ts", F.lit(AT + timedelta(minutes=6))).collect()] == [(1, "new")]


def test_jdbc_lookup_and_staging(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    spark.createDataFrame([(1, "a"), (2, None)], "ID int, GEOM string").write.jdbc(url, "ROADS")
    got = readers.read_lookup_jdbc(spark, url, "ROADS", ["ID"], "GEOM is not null").collect()
    assert [r.ID for r in got] == [1]
    sql = sinks.stage_jdbc(spark.createDataFrame([(k, k) for k in range(501)], "SEG int, N int"), 1, url, "SILVER", ["SEG"])
    assert spark.read.jdbc(url, "SILVER_staging").count() == 501 and sql.startswith("MERGE INTO SILVER t USING SILVER_staging s ON t.SEG = s.SEG")


def test_streams_equal_their_batch_twins(spark, tmp_path):
    from trafficloom.streaming import state

    rows = [(k, "d", "t1" if k < 5 else "t2", AT + timedelta(minutes=5 * k)) for k in range(10)]
    kind = "event_id long, device_id_hash string, tower_id string, timestamp timestamp"
    spark.createDataFrame(rows, kind).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = state.flag_residential_stream(spark.readStream.schema(kind).parquet(str(tmp_path / "in")))
    stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(once=True).start().awaitTermination()
    got = {r.event_id: r.residential for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {r.event_id: r.residential for r in stateful.flag_residential(spark.createDataFrame(rows, kind)).collect()}
    assert [got[k] for k in range(10)] == [False, False, False, True, True] * 2

"""Keyed stream rules over groups of keys: the same rows as key by key, with state for each group."""

from datetime import timedelta

from pyspark.sql import functions as F

from trafficloom.operators import stateful
from trafficloom.plans import ingestion, streams
from trafficloom.streaming import ordered

from .test_ordered import KIND, START, batches, stream


def many(n=400, keys=90):
    return [(i, f"k{i * 7 % keys}", f"t{i % 11 // 6}", START + timedelta(seconds=i * 40)) for i in range(n)]


def test_first_within(spark, tmp_path):
    data = many()
    far = [(20_000, "beat", "t9", data[-1][3] + timedelta(days=5))]
    out = stream(spark, tmp_path, [*batches(data), far], lambda s: ordered.dedup_ttl_ordered(s, "id", "at", 120, bucket_s=900, order=["event_id"], shards=5))
    want = stateful.dedup_ttl(spark.createDataFrame(data, KIND), "id", "at", 7200).collect()
    assert sorted(r.event_id for r in out[-1] if r.id != "beat") == sorted(r.event_id for r in want) and len(want) < len(data)
    held = lambda name: spark.read.format("statestore").option("path", str(tmp_path / "ck")).option("stateVarName", name).load()
    assert held("chunks").select("key").distinct().count() <= 1 and held("carry").count() <= 1  # what is left are the beats


def test_state_is_kept_by_group(spark, tmp_path):
    data = many()
    stream(spark, tmp_path, [data[:200], data[200:]], lambda s: ordered.rate_limit_ordered(s, "id", "at", 2, 7200, bucket_s=900, order=["event_id"], shards=5))
    left = spark.read.format("statestore").option("path", str(tmp_path / "ck")).option("stateVarName", "carry").load()
    assert 1 <= left.count() <= 5 < len({r[1] for r in data})


def test_rate_limit_and_residential(spark, tmp_path):
    data = many()
    df = spark.createDataFrame(data, KIND)
    out = stream(spark, tmp_path / "rate", batches(data), lambda s: ordered.rate_limit_ordered(s, "id", "at", 2, 9000, bucket_s=900, order=["event_id"], shards=5))
    want = stateful.rate_limit(df, "id", "at", 2, 9000.0).collect()
    assert sorted((r.event_id, r.accepted) for r in out[-1] if r.id != "beat") == sorted((r.event_id, r.accepted) for r in want)
    assert {r.accepted for r in want} == {True, False} and set(out[-1][0].asDict()) == {"event_id", "id", "tower_id", "at", "accepted"}
    out = stream(spark, tmp_path / "home", batches(data), lambda s: ordered.flag_residential_ordered(s, "id", ts="at", after_min=60, bucket_s=900, order=["event_id"], shards=5))
    want = stateful.flag_residential(df, "id", ts="at", after="60 minutes").collect()
    assert sorted((r.event_id, r.residential) for r in out[-1] if r.id != "beat") == sorted((r.event_id, r.residential) for r in want)
    assert {r.residential for r in want} == {True, False}


def test_silence_forgets_a_key_of_a_group_alone(spark, tmp_path):
    at = lambda minutes: START + timedelta(minutes=minutes)
    data = [(1, "a", "t1", at(0)), (2, "b", "t1", at(1)), (3, "b", "t1", at(40)), (4, "b", "t1", at(80)), (5, "a", "t1", at(119)), (6, "b", "t1", at(120))]
    out = stream(spark, tmp_path, [data[:3], data[3:], [(10_000, "beat", "t9", at(9_999))]], lambda s: ordered.flag_residential_ordered(s, "id", ts="at", idle_min=50, bucket_s=600, order=["event_id"], shards=1))
    assert sorted((r.event_id, r.residential) for r in out[-1] if r.id != "beat") == [(1, False), (2, False), (3, True), (4, True), (5, False), (6, True)]


def test_halves_of_several_files_lose_no_row(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "FILE_ROWS", 1000)
    rows = spark.range(7000).select(F.col("id").alias("event_id"), (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("id") * 7919 % 7000)).alias("at"))
    source = streams._in_files(spark, rows.withColumn("_s", F.unix_seconds("at").cast("double")), "at", str(tmp_path / "in"))
    query = source.withWatermark("at", "1 hour").groupBy(F.window("at", "1 day")).count().writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert len(list((tmp_path / "in").glob("part-*.parquet"))) == 9  # four files a half, and the last row
    sizes = [p.numInputRows for p in query.recentProgress if p.numInputRows]
    assert len(sizes) == 3 and sum(sizes) == 7001 and sizes[2] == 1
    assert spark.read.parquet(str(tmp_path / "out")).agg(F.sum("count")).first()[0] == 7000


def test_rate_limit_of_a_busy_key_beside_others(spark, tmp_path):
    data = [(i, "busy" if i % 4 else f"k{i}", "t1", START + timedelta(seconds=i * 15 // 60 * 60)) for i in range(300)]
    out = stream(spark, tmp_path, batches(data, 3), lambda s: ordered.rate_limit_ordered(s, "id", "at", 5, 1800, bucket_s=600, order=["event_id"], shards=1))
    want = stateful.rate_limit(spark.createDataFrame(data, KIND), "id", "at", 5, 1800.0).collect()
    assert sorted((r.event_id, r.accepted) for r in out[-1] if r.id != "beat") == sorted((r.event_id, r.accepted) for r in want)
    assert sum(r.accepted for r in want if r.id == "busy") < 30 and all(r.accepted for r in want if r.id != "busy")


def test_ingest_counts_from_halves_of_several_files_and_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "FILE_ROWS", 200)
    monkeypatch.setattr(streams, "SHARDS", 3)
    monkeypatch.setattr(streams, "_scratch", lambda spark: str(tmp_path))
    data = "/root/testdata/sf0.001"
    got, want = (sorted(tuple(r) for r in q(spark, data).collect()) for q in (streams.stream_ingest_counts, ingestion.QUERIES["ingest_counts"]))
    assert got == [r for r in want if r[0] == "telecom"] and len(got) >= 2
    left = spark.read.format("statestore").option("path", str(tmp_path / "ck")).option("stateVarName", "carry").load()
    assert 1 <= left.count() <= 3 and len(list((tmp_path / "in").glob("part-*.parquet"))) == 7

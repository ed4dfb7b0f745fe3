"""Published tables: readers, replays, conflicts, expiry, and refreshes that are checked first."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trafficloom.operators import quality, refresh, windows
from trafficloom.sources import snapshots
from trafficloom.sources.snapshots import Conflict, SnapshotStore

SCHEMA = "seg long, event_date date, n long"
DAY = datetime(2024, 1, 1).date()


def rows(spark, data):
    return spark.createDataFrame([(s, None if d is None else DAY + timedelta(days=d), n) for s, d, n in data], SCHEMA)


def table(df):
    return sorted((r.seg, (r.event_date - DAY).days, r.n) for r in df.collect())


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "store"))


def test_a_reader_keeps_its_version_while_others_publish(spark, store):
    merge = lambda data, k: store.merge("t", rows(spark, data), ["seg", "event_date"], "event_date", ("s", k))
    assert store.read("t") is None
    assert merge([(1, 0, 10), (2, 0, 20), (1, 1, 11)], 0) == 1
    before = store.read("t")  # planned now, run later
    assert merge([(1, 0, 100), (3, 2, 30), (None, 0, 1), (4, None, 1)], 1) == 2
    assert store.merge("t", rows(spark, [(9, 0, 9)]), ["seg", "event_date"], "event_date", ("s", 1)) is None
    assert table(before) == [(1, 0, 10), (1, 1, 11), (2, 0, 20)]
    assert table(store.read("t")) == [(1, 0, 100), (1, 1, 11), (2, 0, 20), (3, 2, 30)]
    assert table(store.read("t", version=1)) == table(before)
    assert table(store.read("t", parts=["2024-01-02"])) == [(1, 1, 11)]
    assert merge([], 2) == 3 and len(table(store.read("t"))) == 4


def test_a_reader_during_a_merge_sees_the_old_table(spark, store, monkeypatch):
    store.merge("t", rows(spark, [(1, 0, 10), (2, 1, 20)]), ["seg", "event_date"], "event_date")
    seen, publish = [], SnapshotStore.publish

    def slow(self, *a, **b):  # all files of the merge are written, the version is not
        seen.append(table(store.read("t")))
        return publish(self, *a, **b)

    monkeypatch.setattr(SnapshotStore, "publish", slow)
    store.merge("t", rows(spark, [(1, 0, 11), (2, 1, 21)]), ["seg", "event_date"], "event_date")
    assert seen == [[(1, 0, 10), (2, 1, 20)]] and table(store.read("t")) == [(1, 0, 11), (2, 1, 21)]


def test_two_writers(spark, store, monkeypatch):
    store.merge("t", rows(spark, [(1, 0, 10)]), ["seg", "event_date"], "event_date")
    base = store.current()
    staged = store.stage(rows(spark, [(5, 0, 50)]), "event_date")
    publish, turns = SnapshotStore.publish, []

    def rival(self, *a, **b):  # another writer is faster, once
        if not turns:
            turns.append(1)
            publish(self, self.current(), {"t": self.stage(rows(spark, [(1, 0, 10), (2, 0, 20)]), "event_date")})
        return publish(self, *a, **b)

    monkeypatch.setattr(SnapshotStore, "publish", rival)
    store.merge("t", rows(spark, [(3, 0, 30)]), ["seg", "event_date"], "event_date")
    assert table(store.read("t")) == [(1, 0, 10), (2, 0, 20), (3, 0, 30)]
    with pytest.raises(Conflict):
        publish(store, base, {"t": staged})


def test_expiry_and_replacement(spark, store, tmp_path):
    for k in range(4):
        store.replace("t", rows(spark, [(k, k % 2, k)]), "event_date", whole=k < 2)
    assert table(store.read("t")) == [(2, 0, 2), (3, 1, 3)]
    store.stage(rows(spark, [(9, 9, 9)]), "event_date")  # of a writer that died
    assert store.expire(keep=1) == 0 and store.versions() == [4]  # all folders are young
    assert store.expire(keep=1, grace_s=0) == 3
    assert table(store.read("t")) == [(2, 0, 2), (3, 1, 3)]
    assert len(list((tmp_path / "store" / "data").iterdir())) == 2


def test_stream_sink_survives_a_restart(spark, store, tmp_path):
    schema = "seg long, event_time timestamp_ntz, n long"
    source = tmp_path / "in"
    for k in range(2):
        spark.createDataFrame([(k, datetime(2024, 1, 1 + k), 10 + k)], schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        sink = snapshots.snapshot_sink(store, "t", ["seg", "event_time"])
        stream.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    sink(rows(spark, [(7, 0, 7)]).withColumn("event_time", F.col("event_date").cast("timestamp_ntz")).select("seg", "event_time", "n"), 1)
    assert sorted((r.seg, r.n) for r in store.read("t").collect()) == [(0, 10), (1, 11)]


def events(spark, n, seed, first=0):
    r = random.Random(seed)
    start = datetime(2024, 1, 1)
    data = [(first + i, r.randrange(6), start + timedelta(minutes=r.randrange(4 * 1440)), r.choice((None, 3.0, 20.0, 45.0)), r.randrange(40), 1.0 * r.randrange(9), r.choice((1.0, 1.2))) for i in range(n)]
    return spark.createDataFrame(data, "event_id long, road_segment_id long, event_time timestamp_ntz, avg_speed_kmh double, vehicle_count int, flow_rate double, weather_factor double")


def edges(spark):
    return spark.createDataFrame([(i, 30 + 10 * i) for i in range(6)], "id long, speed_limit_kmh int")


LIMITS = {"min_edges": (0, None)}


def full(spark, store, all_events):
    silver = windows.segment_traffic_5min(all_events, edges(spark))
    same = lambda a, b: sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    assert same(store.read("silver").drop("event_date"), silver)
    gold = windows.segment_congestion_daily(silver)
    assert same(store.read("gold").select("road_segment_id", F.col("event_date").cast("timestamp_ntz"), *gold.columns[2:]), gold)


def test_refresh_equals_a_rebuild_and_writes_only_dates_that_changed(spark, store):
    old = events(spark, 500, 1).cache()
    assert refresh.refresh(store, old, old, edges(spark), limits=LIMITS).version == 1
    full(spark, store, old)
    late = events(spark, 6, 2, 1000).where("event_time >= '2024-01-03'").cache()
    parts = store.current()["tables"]["silver"]["parts"]
    done = refresh.refresh(store, old.unionByName(late), late, edges(spark), limits=LIMITS)
    assert done.version == 2 and 0 < done.changed < store.read("silver").count()
    full(spark, store, old.unionByName(late))
    now = store.current()["tables"]["silver"]["parts"]
    assert all(now[d] == parts[d] for d in ("2024-01-01", "2024-01-02")) and now != parts
    again = refresh.refresh(store, old.unionByName(late), late, edges(spark), limits=LIMITS)
    assert again.version is None and again.changed == 0  # nothing is new


def test_a_failing_check_keeps_the_old_tables(spark, store):
    old = events(spark, 200, 3).cache()
    refresh.refresh(store, old, old, edges(spark), limits=LIMITS)
    lost = events(spark, 5, 4, 1000).withColumn("road_segment_id", F.lit(77).cast("long"))
    done = refresh.refresh(store, old.unionByName(lost), lost, edges(spark), limits=LIMITS)
    assert done.version is None and store.versions() == [1]
    assert {r.check_name: r.status for r in done.report.collect()}["relationship_road_segment_id"] == "error"
    full(spark, store, old)
    allowed = {**LIMITS, "relationship_road_segment_id": (0, 100)}
    assert refresh.refresh(store, old.unionByName(lost), lost, edges(spark), limits=allowed).version == 2
    assert refresh.rebuild(store, old, edges(spark)).version is None  # too few roads


def test_limits(spark):
    report = spark.createDataFrame([("a", 0), ("a2", 3), ("b", 3), ("b2", 9), ("c", 5)], quality.REPORT)
    got = quality.with_limits(report, {"b": (2, 5), "b2": (2, 5), "c": (None, None)})
    assert {r.check_name: r.status for r in got.collect()} == {"a": "pass", "a2": "error", "b": "warn", "b2": "error", "c": "pass"}

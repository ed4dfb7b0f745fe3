"""Windows over sliced keys give what windows over whole keys give, and a hot key is many tasks."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from trafficloom.operators import scan, stateful, windows

START = datetime(2024, 1, 1)
WHOLE = 1 << 40


def events(n=3000, seed=4):
    """Half of the rows in one segment; times tie, some are null; a null segment; long silences."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        seg = 1 if i % 2 else r.choice((2, 3, 4, None))
        at = None if i % 400 == 7 else START + timedelta(seconds=r.choice((0, 40_000, 300_000)) + r.randrange(30_000))
        rows.append((i, seg, at, r.choice((None, 2.0, 3.0, 50.0)), r.randrange(5) if i % 50 else r.randrange(500), f"t{r.randrange(2) if seg == 1 else 0}"))
    return rows


@pytest.fixture
def frame(spark):
    return spark.createDataFrame(events(), "event_id long, road_segment_id long, event_time timestamp_ntz, avg_speed_kmh double, vehicle_count int, tower_id string").cache()


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


@pytest.mark.parametrize("rows", [7, 100])
def test_slices_are_bounded_and_in_order(frame, rows):
    got = scan.cut(frame, ["road_segment_id"], "event_time", rows, 600)
    assert got.count() == 3000
    unit = frame.groupBy("road_segment_id", F.floor(scan.micros(F.col("event_time")) / 600_000_000)).count().agg(F.max("count")).first()[0]
    by = got.groupBy("road_segment_id", "_slice").agg(F.count("*").alias("n"), F.min("event_time").alias("a"), F.max("event_time").alias("b"), F.count_if(F.col("event_time").isNull()).alias("gaps")).collect()
    large = {r[0] for r in frame.groupBy("road_segment_id").count().where(F.col("count") > rows).collect()}
    for seg in {r.road_segment_id for r in by}:
        own = sorted((r for r in by if r.road_segment_id == seg), key=lambda r: r._slice)
        assert (own[0]._slice > 0) == (seg in large)
        if seg in large:
            assert max(r.n for r in own) <= rows + unit
            assert all(r.gaps == 0 for r in own[1:])
            times = [(r.a, r.b) for r in own if r.a]
            assert all(x[1] < y[0] for x, y in zip(times, times[1:]))


@pytest.mark.parametrize("rows", [1, 20])
def test_running_state(frame, rows):
    w = Window.partitionBy("road_segment_id").orderBy("event_time", "event_id")
    plain = frame.select("*", windows.running_capacity(F.col("vehicle_count"), w.rowsBetween(Window.unboundedPreceding, 0)).alias("capacity"), windows.dwell_flag_rows(F.col("avg_speed_kmh"), w).alias("dwell_flag"))
    same(windows.running_state(frame, rows=rows), plain)


@pytest.mark.parametrize("rows, where", [(1, None), (25, "vehicle_count % 3 <> 0")])
def test_residential(frame, rows, where):
    cond = None if where is None else F.expr(where)
    args = dict(device="road_segment_id", ts="event_time", where=cond)
    rows_, plain = {}, {}
    for r in sorted(events(), key=lambda r: (r[2] or datetime.min, r[0])):
        if where and r[4] % 3 == 0:
            plain[r[0]] = False
            continue
        tower, since = rows_.get(r[1], (None, None))
        if r[1] not in rows_ or tower != r[5]:
            since = None
        since = since if since is not None else r[2]
        rows_[r[1]] = (r[5], since)
        plain[r[0]] = None if r[2] is None else r[2] >= since + timedelta(minutes=15)
    got = stateful.flag_residential(frame, rows=rows, **args)
    assert got.columns == [*frame.columns, "residential"]
    assert {r.event_id: r.residential for r in got.collect()} == plain
    assert any(plain.values())


def steps(spark):
    r = random.Random(9)
    rows, at = [], START
    for i in range(1500):
        at += timedelta(seconds=30 if r.random() < 0.9 else 60)
        rows.append((i, 1 if i % 2 else 2 + i % 6, at, r.choice((None, 3.0, 4.0, 50.0)) if r.random() < 0.7 else 1.0))
    rows += [(5000 + k, 9, START + timedelta(seconds=30 * k), 1.0) for k in range(400)]
    return spark.createDataFrame(rows, "event_id long, road_segment_id long, event_time timestamp_ntz, avg_speed_kmh double")


@pytest.mark.parametrize("rows, mode, n", [(1, "any", 3), (50, "any", 1), (1, "latest", 2), (50, "latest", 3)])
def test_dwell_anchor(spark, rows, mode, n):
    df = steps(spark)
    plain = stateful.dwell_anchor(df, n=n, mode=mode, rows=WHOLE)
    same(stateful.dwell_anchor(df, n=n, mode=mode, rows=rows), plain)
    assert plain.where("incident_flag").count() > 0


@pytest.mark.parametrize("rows", [60])
def test_trajectory_legs(frame, rows):
    points = frame.select("event_id", F.col("road_segment_id").alias("vehicle_id_hash"), (F.lit(-6.8) + F.col("vehicle_count") / 1000).alias("lat"), F.lit(39.2).alias("lon"), F.col("event_time").alias("timestamp"))
    same(windows.trajectory_legs(points, rows=rows), windows.trajectory_legs(points, rows=WHOLE))


@pytest.fixture
def many_tasks(spark):
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def test_half_the_rows_in_one_segment_are_many_tasks(many_tasks):
    n = 40_000
    df = many_tasks.range(n).select(F.col("id").alias("event_id"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 500).alias("road_segment_id"), (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("id") * 20).cast("decimal(18,6)"))).alias("event_time"), (F.col("id") % 97).cast("int").alias("vehicle_count"), F.lit(3.0).alias("avg_speed_kmh"))
    by_task = lambda rows: windows.running_state(df, rows=rows).groupBy(F.spark_partition_id()).agg(F.count("*"), F.max("capacity"), F.max("dwell_flag")).collect()
    assert max(r[1] for r in by_task(500)) < n / 10  # with the whole segment in one task it would be n / 2
    assert max(r[1] for r in by_task(WHOLE)) >= n / 2

"""Keyed stream rules in event-time order: several micro-batches with rows out of order equal the batch rules; state leaves."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trafficloom.operators import stateful
from trafficloom.streaming import ordered

START = datetime(2024, 1, 1)
KIND = "event_id long, id string, tower_id string, at timestamp"


def rows(n=240, seed=6):
    r = random.Random(seed)
    return [(i, r.choice("aab"), r.choice(("t1", "t1", "t1", "t2")), START + timedelta(seconds=i * 40 + r.randrange(90))) for i in range(n)]


def stream(spark, tmp_path, batches, build):
    """Runs one micro-batch for each list of rows, with a restart after each, and returns what came out after each."""
    out = []
    for k, batch in enumerate(batches):
        spark.createDataFrame(batch, KIND).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        df = build(spark.readStream.schema(KIND).parquet(str(tmp_path / "in")))
        df.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
        out.append(spark.read.schema(df.schema).parquet(str(tmp_path / "out")).collect())
    return out


def batches(data, k=4):
    """Rows in k batches, a few of them a batch late, then a row of another key that lets the watermark pass all."""
    size = len(data) // k
    cut = [data[j * size : (j + 1) * size] for j in range(k)]
    tails = [x[-2:] for x in cut]
    cut = [(tails[j - 1] if j else []) + (x[:-2] if j < k - 1 else x) for j, x in enumerate(cut)]
    return [*cut, [(10_000, "beat", "t9", data[-1][3] + timedelta(days=2))]]


@pytest.mark.parametrize("bucket_s", [600])
def test_residential(spark, tmp_path, bucket_s):
    data = rows()
    out = stream(spark, tmp_path, batches(data), lambda df: ordered.flag_residential_ordered(df, "id", ts="at", bucket_s=bucket_s, order=["event_id"]))
    want = stateful.flag_residential(spark.createDataFrame(data, KIND), "id", ts="at").collect()
    assert sorted((r.event_id, r.residential) for r in out[-1]) == sorted((r.event_id, r.residential) for r in want)
    assert 0 < len(out[1]) < len(out[2]) < len(out[-1])  # as the watermark moves on


def test_first_within_and_rate_limit(spark, tmp_path):
    data = rows(200, 8)
    df = spark.createDataFrame(data, KIND)
    out = stream(spark, tmp_path / "ttl", batches(data), lambda s: ordered.dedup_ttl_ordered(s, "id", "at", 7, order=["event_id"]))
    assert sorted(r.event_id for r in out[-1]) == sorted(r.event_id for r in stateful.dedup_ttl(df, "id", "at", 420).collect())
    out = stream(spark, tmp_path / "rate", batches(data), lambda s: ordered.rate_limit_ordered(s, "id", "at", 3, 300, order=["event_id"]))
    want = stateful.rate_limit(df, "id", "at", 3, 300.0).collect()
    assert sorted((r.event_id, r.accepted) for r in out[-1]) == sorted((r.event_id, r.accepted) for r in want)


def test_state_leaves_with_the_watermark(spark, tmp_path):
    data = rows(60)
    far = [(20_000, "beat", "t9", data[-1][3] + timedelta(days=4))]
    stream(spark, tmp_path, [*batches(data, 2), far], lambda s: ordered.dedup_ttl_ordered(s, "id", "at", 7))
    for name, of in (("carry", "value"), ("chunks", "map")):
        left = spark.read.format("statestore").option("path", str(tmp_path / "ck")).option("stateVarName", name).load()
        assert {r.key.id for r in left.select("key").collect()} <= {"beat"}, name


def test_rows_later_than_the_delay_go(spark, tmp_path):
    data = rows(60)
    late = (777, "a", "t1", START)
    out = stream(spark, tmp_path, [data[:30], data[30:], [late], [(10_000, "beat", "t9", START + timedelta(days=3))]], lambda s: ordered.rate_limit_ordered(s, "id", "at", 3, 300))
    assert 777 not in {r.event_id for r in out[-1]} and len(out[-1]) == 60

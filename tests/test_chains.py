"""Time-to-live and rate limits by chains of successors, against plain passes; a hot key is many tasks."""

import random
from collections import deque
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trafficloom.operators import chains, stateful
from trafficloom.sources.scratch import Steps

START = datetime(2024, 1, 1)
SCHEMA = "event_id long, id string, reported_at timestamp_ntz, more string"


def rows(seed, n=600):
    """Bursts, silences, ties, repeated rows, null keys and times."""
    r = random.Random(seed)
    out, at = [], {}
    for i in range(n):
        k = r.choice(("hot", "hot", "hot", "a", "b", None))
        at[k] = at.get(k, 0) + r.choice((0, 0, 1, 2, 5, 9, 10, 11, 40, 200))
        out.append((i, k, None if i % 90 == 5 else START + timedelta(seconds=at[k]), "x"))
    return out + out[:3] + [out[-1]]


def plain(data, n, width, null_keys):
    """Accepted rows as a list of flags in the order of time and tiebreak."""
    taken, out = {}, []
    for row in sorted(data, key=lambda x: (x[2] or datetime.min, x[0])):
        _, k, t, _ = row
        own = taken.setdefault(k, deque())
        if t is None or (k is None and not null_keys):
            out.append((row, False))
            continue
        while own and t - own[0] >= timedelta(seconds=width):
            own.popleft()
        out.append((row, len(own) < n))
        if out[-1][1]:
            own.append(t)
    return out


@pytest.mark.parametrize("seed, cut", [(0, 5), (1, 1 << 40)])
def test_dedup_ttl(spark, seed, cut):
    data = rows(seed)
    want = sorted(map(repr, [r for r, kept in plain(data, 1, 10, False) if kept]))
    got = stateful.dedup_ttl(spark.createDataFrame(data, SCHEMA), ttl_s=10, rows=cut)
    assert got.columns == ["event_id", "id", "reported_at", "more"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == want


@pytest.mark.parametrize("n, cut", [(2, 7), (3, 1 << 40)])
def test_rate_limit(spark, n, cut):
    data = rows(10 + n, 400)
    want = sorted((repr(r), a) for r, a in plain(data, n, 10, True))
    got = stateful.rate_limit(spark.createDataFrame(data, SCHEMA), "id", "reported_at", n, 10.0, rows=cut)
    assert sorted((repr(tuple(r)[:4]), r.accepted) for r in got.collect()) == want
    assert "Python" not in got._jdf.queryExecution().toString() and "Arrow" not in got._jdf.queryExecution().toString()


def test_large_limits_and_chains_agree(spark):
    data = rows(30, 500)
    df = spark.createDataFrame(data, SCHEMA)
    want = sorted((repr(r), a) for r, a in plain(data, stateful.CHAINS + 1, 60, True))
    got = stateful.rate_limit(df, "id", "reported_at", stateful.CHAINS + 1, 60.0).collect()
    assert sorted((repr(tuple(r)[:4]), r.accepted) for r in got) == want and not all(a for _, a in want)


def test_successors(spark):
    r = random.Random(3)
    times = {k: sorted({r.randrange(2000) if k else r.randrange(60) for _ in range(80)}) for k in (0, 1, None)}
    nodes = spark.createDataFrame([(k, t) for k, own in times.items() for t in own], "k long, _t long")
    for cell in (None, 1, 7, 10_000):
        got = {(x.k, x._t): x._to for x in chains.successors(nodes, ["k"], 37, cell).collect()}
        assert got == {(k, t): min((u for u in own if u >= t + 37), default=None) for k, own in times.items() for t in own}


def test_a_long_chain_takes_few_rounds(spark):
    nodes = spark.range(1000).select(F.lit("k").alias("k"), F.col("id").alias("_t"), F.when(F.col("id") < 999, F.col("id") + 1).alias("_to"), (F.col("id") == 0).alias("_mark"))
    steps = Steps(spark)
    assert chains.reached(nodes, ["k"], steps).where("_mark").count() == 1000
    assert steps.last <= 12


def test_empty_and_calm_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert stateful.dedup_ttl(none).count() == 0 and stateful.rate_limit(none, "id", "reported_at", 2, 5.0).count() == 0
    calm = spark.createDataFrame([(i, "k", START + timedelta(hours=i), "x") for i in range(20)], SCHEMA)
    assert stateful.dedup_ttl(calm).count() == 20


def test_a_hot_key_is_many_tasks(spark):
    held = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(20_000).select(F.col("id").alias("event_id"), F.lit("hot").alias("id"), F.timestamp_seconds(F.col("id") * 30).alias("reported_at"))
        by = chains.successors(df.select("id", (F.unix_micros("reported_at")).alias("_t")), ["id"], 1_800_000_000).groupBy(F.spark_partition_id()).agg(F.count("*"), F.max("_to")).collect()
        assert max(r[1] for r in by) < 20_000 / 5
        assert stateful.dedup_ttl(df, rows=500).count() == 334
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)

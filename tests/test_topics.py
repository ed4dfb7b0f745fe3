"""Recorded topics: offsets, start and limit, restarts, and the way from topics to flat rows."""

from datetime import datetime, timedelta

from trafficloom.sources import topics

T0 = datetime(2024, 1, 1)


def record(spark, root, first, n, parts=2):
    rows = [("traffic.raw.fleet" if i % 3 else "traffic.raw.weather", f"k{i % 5}", f"v{i}", T0 + timedelta(seconds=i)) for i in range(first, first + n)]
    topics.record_topics(spark.createDataFrame(rows, "topic string, key string, value string, timestamp timestamp"), root, parts)


def test_offsets_are_dense_and_in_order(spark, tmp_path):
    root = str(tmp_path / "log")
    assert topics.read_topics(spark, root).count() == 0
    record(spark, root, 0, 30)
    record(spark, root, 30, 20)
    got = topics.read_topics(spark, root).collect()
    assert sorted(r.value for r in got) == sorted(f"v{i}" for i in range(50))
    for part in {(r.topic, r.partition) for r in got}:
        own = sorted((r.offset, r.timestamp) for r in got if (r.topic, r.partition) == part)
        assert [o for o, _ in own] == list(range(len(own))) and [t for _, t in own] == sorted(t for _, t in own)
    assert {r.topic for r in topics.read_topics(spark, root, ["traffic.raw.fleet"]).collect()} == {"traffic.raw.fleet"}
    some = topics.read_topics(spark, root, ["traffic.raw.fleet"], starting={"traffic.raw.fleet": {"0": 3}}).collect()
    assert min(r.offset for r in some if r.partition == 0) == 3 and topics.read_topics(spark, root, starting="latest").count() == 0


def test_a_stream_restarts_where_it_was(spark, tmp_path):
    root = str(tmp_path / "log")

    def run(**options):
        sizes = []
        stream = topics.read_topics(spark, root, streaming=True, **options)

        def sink(df, k):
            sizes.append(df.count())
            df.write.mode("append").parquet(str(tmp_path / "out"))

        q = stream.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "ck")).start()
        q.processAllAvailable()
        q.stop()
        return sizes

    record(spark, root, 0, 40)
    assert max(run(max_offsets=12, group="g")) <= 12
    record(spark, root, 40, 15)
    sizes = run(max_offsets=4, group="g")
    assert max(sizes) <= 4 and sum(sizes) == 15
    got = [(r.topic, r.partition, r.offset, r.value) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert len(got) == len(set(got)) == 55 and sorted(x[3] for x in got) == sorted(f"v{i}" for i in range(55))

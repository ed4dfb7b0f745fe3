"""Recorded topics: logs of messages in files, written once and read as a source with an offset for each partition.

root/<topic>/<partition>/<first offset>-<messages>.parquet, so that names alone say which offsets there are.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

NAME = "recorded_topics"
SCHEMA = "key string, value string, topic string, partition int, offset long, timestamp timestamp"


def record_topics(rows: DataFrame, root: str, partitions: int = 1) -> None:
    """Appends rows (topic, key, value and, if they have it, timestamp) to the logs; a key's messages are in one partition, in order of time.

    Files appear by renames once all are written. One writer at a time. Rows without a topic go.
    """
    spark = rows.sparkSession
    if "timestamp" not in rows.columns:
        rows = rows.withColumn("timestamp", F.current_timestamp())
    rows = rows.where(F.col("topic").isNotNull()).select(F.col("key").cast("string"), F.col("value").cast("string"), F.col("timestamp").cast("timestamp"), F.col("topic").alias("_t"), F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int").alias("_p"))
    fs, draft = _fs(spark, root), f"{root}/_draft-{uuid.uuid4().hex}"
    rows.repartition("_t", "_p").sortWithinPartitions("_t", "_p", "timestamp", "key", "value").write.partitionBy("_t", "_p").option("maxRecordsPerFile", 0).parquet(draft)
    path = spark._jvm.org.apache.hadoop.fs.Path
    written = spark.read.parquet(draft).groupBy(F.input_file_name().alias("at"), F.col("_t").cast("string").alias("t"), F.col("_p").alias("p")).count().collect()  # a row for each partition of a topic
    known = _ends(root)
    for r in sorted(written, key=lambda r: r["at"]):
        first = known.setdefault(r["t"], {}).get(str(r["p"]), 0)
        home = path(f"{root}/{r['t']}/{r['p']}")
        fs.mkdirs(home)
        fs.rename(path(r["at"]), path(home, f"{first:020d}-{r['count']}.parquet"))
        known[r["t"]][str(r["p"])] = first + r["count"]
    fs.delete(path(draft), True)


def _fs(spark: SparkSession, root: str):
    return spark._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())


def _files(root: str):
    """(file system, folder) of a path or URI, as tasks open it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), os.path.abspath(root))


def _segments(root: str, topic: str | None = None, partition: str | None = None) -> Iterator[tuple[str, str, int, int, str]]:
    """(topic, partition, first offset, offset after the last, path) of the files."""
    from pyarrow import fs

    system, at = _files(root)
    at = "/".join([at, *[x for x in (topic, partition) if x is not None]])
    for info in system.get_file_info(fs.FileSelector(at, recursive=True, allow_not_found=True)):
        *_, t, p, name = info.path.split("/")
        if name.endswith(".parquet") and name[0].isdigit():
            first, n = map(int, name.removesuffix(".parquet").split("-"))
            yield t, p, first, first + n, info.path


def _ends(root: str, topics: list[str] | None = None) -> dict[str, dict[str, int]]:
    out: dict[str, dict[str, int]] = {}
    for t, p, _, end, _ in _segments(root):
        if topics is None or t in topics:
            own = out.setdefault(t, {})
            own[p] = max(own.get(p, 0), end)
    return out


class Span(InputPartition):
    """Offsets of one partition of a topic from start up to end."""

    def __init__(self, topic: str, partition: str, start: int, end: int):
        self.topic, self.partition, self.start, self.end = topic, partition, start, end


def _spans(start: dict, end: dict) -> list[Span]:
    return [Span(t, p, start.get(t, {}).get(p, 0), z) for t, own in end.items() for p, z in own.items() if z > start.get(t, {}).get(p, 0)]


def _read(root: str, span: Span | None) -> Iterator[pa.RecordBatch]:
    import pyarrow.parquet as pq

    if span is None:  # Spark reads a table without partitions as one
        return
    system, _ = _files(root)
    for _, _, first, end, path in sorted(_segments(root, span.topic, span.partition), key=lambda x: x[2]):
        low, high = max(first, span.start), min(end, span.end)
        if low >= high:
            continue
        at = first
        with system.open_input_file(path) as source:
            for batch in pq.ParquetFile(source).iter_batches(batch_size=10_000, columns=["key", "value", "timestamp"]):
                a, b = max(low - at, 0), min(high - at, batch.num_rows)
                if a < b:
                    part = batch.slice(a, b - a)
                    n = part.num_rows
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(1), pa.array([span.topic] * n), pa.array([int(span.partition)] * n, pa.int32()), pa.array(range(at + a, at + b), pa.int64()), part.column(2).cast(pa.timestamp("us", "UTC"))],
                        names=["key", "value", "topic", "partition", "offset", "timestamp"],
                    )
                at += batch.num_rows


class RecordedTopics(DataSource):
    """Format "recorded_topics": path; topics, comma-separated (all by default); startingOffsets "earliest" (default), "latest" or {topic: {partition: offset}}; maxOffsetsPerTrigger, with a group.

    A source is not told where its query is when it is asked for the latest offsets, so a limit needs a group: a name under
    which the offsets last planned are kept beside the logs. It belongs to one query and goes with its checkpoint.
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Batch(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(self.options)


class _Log:
    def __init__(self, options):
        self._root = options["path"]
        self._topics = options["topics"].split(",") if options.get("topics") else None
        start = options.get("startingOffsets", "earliest")
        self._first = _ends(self._root, self._topics) if start == "latest" else {} if start == "earliest" else json.loads(start)
        self._limit, self._group = int(options.get("maxOffsetsPerTrigger", 0)), options.get("group")
        if self._limit and not self._group:
            raise ValueError("maxOffsetsPerTrigger needs a group")


class _Batch(_Log, DataSourceReader):
    def partitions(self) -> list[Span]:
        return _spans(self._first, _ends(self._root, self._topics))

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        return _read(self._root, partition)


class _Stream(_Log, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return self._first

    def _planned(self) -> dict:
        from pyarrow import fs

        system, at = _files(f"{self._root}/_groups/{self._group}.json")
        if system.get_file_info(at).type == fs.FileType.NotFound:
            return self._first
        with system.open_input_file(at) as source:
            return json.loads(source.read())

    def latestOffset(self) -> dict:
        ends = _ends(self._root, self._topics)
        if self._limit:  # shared out evenly
            spans = _spans(start := self._planned(), ends)
            share = max(1, self._limit // max(1, len(spans)))
            for t, own in ends.items():
                for p, end in own.items():
                    own[p] = min(end, start.get(t, {}).get(p, 0) + share)
        return ends

    def partitions(self, start: dict, end: dict) -> list[Span]:
        if self._limit:
            system, at = _files(f"{self._root}/_groups/{self._group}.json")
            system.create_dir(at.rsplit("/", 1)[0], recursive=True)
            with system.open_output_stream(at) as out:
                out.write(json.dumps(end).encode())
        return _spans(start, end)

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        return _read(self._root, partition)


def read_topics(spark: SparkSession, root: str, topics: list[str] | None = None, streaming: bool = False, starting: str | dict = "earliest", max_offsets: int | None = None, group: str | None = None) -> DataFrame:
    """Messages of recorded topics with topic, partition, offset and timestamp, as `read_raw_stream` has them of a broker."""
    spark.dataSource.register(RecordedTopics)
    reader = (spark.readStream if streaming else spark.read).format(NAME).option("path", root).option("startingOffsets", starting if isinstance(starting, str) else json.dumps(starting))
    if topics:
        reader = reader.option("topics", ",".join(topics))
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets).option("group", group)
    return reader.load()

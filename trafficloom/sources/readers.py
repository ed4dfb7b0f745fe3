"""Sources: Kafka topics, JDBC lookups, lake tables, landed JSON files."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trafficloom import schemas as S


def with_kafka_columns(df: DataFrame) -> DataFrame:
    """key and value as text, with topic, partition, offset and timestamp where the source has them."""
    rest = [c for c in ("topic", "partition", "offset", "timestamp") if c in df.columns]
    return df.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), *rest)


def read_raw_stream(spark: SparkSession, brokers: str, topics: list[str] | None = None, starting: str = "latest", max_offsets: int | None = None, prefix: str = S.TOPIC_PREFIX) -> DataFrame:
    """Stream of the raw topics (all five by default)."""
    topics = topics or [f"{prefix}.{t}" for k, t in S.TOPICS.items() if k != "fused"]
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", brokers).option("subscribe", ",".join(topics)).option("startingOffsets", starting)
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return with_kafka_columns(reader.load())


def source_of_topic(topic, prefix: str = S.TOPIC_PREFIX):
    """Source type of a topic column; null for others."""
    pairs = [F.lit(x) for k, t in S.TOPICS.items() for x in (f"{prefix}.{t}", k)]
    return F.try_element_at(F.create_map(*pairs), topic)


def read_lookup_jdbc(spark: SparkSession, url: str, table: str, columns: list[str], predicate: str | None = None, options: dict | None = None) -> DataFrame:
    """Columns of a database table; columns and predicate are pushed to the database. Joins decide by size whether to broadcast it."""
    df = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**(options or {})).load()
    df = df.where(predicate) if predicate else df
    return df.select(*columns)


def read_lake(spark: SparkSession, root: str, date_from: datetime.date | str | None = None, date_to: datetime.date | str | None = None, column: str = "event_date") -> DataFrame:
    """A Parquet table, only the partitions of dates from date_from up to date_to."""
    df = spark.read.parquet(root)
    if date_from is not None:
        df = df.where(F.col(column) >= F.lit(str(date_from)).cast("date"))
    if date_to is not None:
        df = df.where(F.col(column) <= F.lit(str(date_to)).cast("date"))
    return df


def read_landing_json(spark: SparkSession, path: str, schema: str, streaming: bool = False, top: str = "array") -> DataFrame:
    """Rows of landed JSON bodies, one body a file, with _corrupt (the text of what does not parse) for the dead-letter table.

    top "array": a body must be an array of objects, and an object is corrupt; top "object": the other way round.
    """
    reader = spark.readStream if streaming else spark.read
    bodies = reader.format("text").option("wholetext", "true").load(path)
    text = F.trim("value")
    fits = text.startswith("[" if top == "array" else "{")
    kind = T._parse_datatype_string(schema)
    parsed = F.from_json(F.when(fits, F.when(text.startswith("["), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))), T.ArrayType(kind))
    rows = bodies.select("value", parsed.alias("_rows")).select(F.when(F.col("_rows").isNull(), F.col("value")).alias("_corrupt"), F.explode_outer("_rows").alias("_r"))
    return rows.select("_r.*", "_corrupt")

"""Sinks: merged tables, archives by hour, Kafka rows, replaced tables, JDBC staging."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficloom import schemas as S

JDBC_BATCH = 500
#: Times in JSON keep their microseconds.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def merge_latest(base: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """base with the rows of updates in place of rows of equal keys. updates has one row per key; keys are not null."""
    return base.join(updates.select(*keys), keys, "left_anti").unionByName(updates)


def upsert_batch(batch_df: DataFrame, batch_id: int, target: str, keys: list[str], date_from: str = "event_time") -> None:
    """Merges a micro-batch into a Parquet table partitioned by event_date; only the dates of the batch are rewritten.

    Replaying a batch gives the same table. The merged dates are written beside the table first, as Spark cannot
    overwrite what it reads. Of several rows of a key in the batch one wins (the greatest row). Rows without a key or a
    time go. An empty batch changes nothing.
    """
    spark = batch_df.sparkSession
    rows = batch_df.dropna(subset=[*keys, date_from]).withColumn("event_date", F.to_date(date_from))
    rest = [c for c in rows.columns if c not in keys]
    rows = rows.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_r")).select(*keys, *[F.col("_r")[c].alias(c) for c in rest])
    staged = f"{target}_staging/{uuid.uuid4().hex}"
    rows.write.parquet(f"{staged}/new")
    new = spark.read.schema(rows.schema).parquet(f"{staged}/new")
    dates = [r.event_date for r in new.select("event_date").distinct().collect()]  # the dates of one micro-batch
    if not dates:
        return
    merged = new
    if _exists(spark, target):
        old = spark.read.parquet(target).where(F.col("event_date").isin(dates))
        merged = merge_latest(old.select(*rows.columns), new, keys)
    merged.write.parquet(f"{staged}/merged")
    replace_table(spark.read.schema(rows.schema).parquet(f"{staged}/merged"), target, ["event_date"])


def _exists(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def replace_table(df: DataFrame, target: str, partition_by: list[str] | None = None) -> None:
    """Replaces a table, or with partition_by the partitions that df has rows of."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(target)


def write_hour_partitions(batch_df: DataFrame, batch_id: int, root: str, ts: str = "event_time") -> None:
    """Archives a batch under date, hour and batch id; a replay overwrites its own files only. Rows without a time go."""
    t = F.col(ts).try_cast("timestamp_ntz")
    rows = batch_df.where(t.isNotNull()).withColumns({"checkpoint_date": F.date_format(t, "yyyy-MM-dd"), "checkpoint_hour": F.date_format(t, "HH"), "batch_id": F.lit(batch_id)})
    rows = rows.repartition("checkpoint_date", "checkpoint_hour")  # one file an hour
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("checkpoint_date", "checkpoint_hour", "batch_id").parquet(root)


def to_kafka_rows(df: DataFrame, source_col: str, prefix: str = S.TOPIC_PREFIX) -> DataFrame:
    """(topic, key, value) for the Kafka sink; an unknown source gives the dead-letter topic."""
    source = F.col(source_col)
    topic = reduce(lambda acc, x: acc.when(source == x[0], f"{prefix}.{x[1]}"), S.TOPICS.items(), F.when(source.isNull(), f"{prefix}.{S.DLQ_TOPIC}")).otherwise(f"{prefix}.{S.DLQ_TOPIC}")
    return df.select(topic.alias("topic"), source.alias("key"), F.to_json(F.struct(*df.columns), JSON).alias("value"))


def write_kafka(df: DataFrame, brokers: str, checkpoint: str | None = None):
    """Sends (topic, key, value) rows: at once, or for a stream as a started query."""
    if df.isStreaming:
        return df.writeStream.format("kafka").option("kafka.bootstrap.servers", brokers).option("checkpointLocation", checkpoint).start()
    df.write.format("kafka").option("kafka.bootstrap.servers", brokers).save()
    return None


def stage_jdbc(batch_df: DataFrame, batch_id: int, url: str, table: str, keys: list[str], options: dict | None = None) -> str:
    """Writes a batch to `table`_staging from the executors, 500 rows a statement, and returns the MERGE that the database runs once."""
    batch_df.write.mode("overwrite").options(**(options or {})).option("batchsize", JDBC_BATCH).jdbc(url, f"{table}_staging")
    rest = [c for c in batch_df.columns if c not in keys]
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    sets = ", ".join(f"{c} = s.{c}" for c in rest)
    cols = ", ".join(batch_df.columns)
    return f"MERGE INTO {table} t USING {table}_staging s ON {on} WHEN MATCHED THEN UPDATE SET {sets} WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({', '.join('s.' + c for c in batch_df.columns)})"

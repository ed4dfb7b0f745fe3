"""The silver stream: normalise, place on roads, drop repeats, aggregate, write."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trafficloom.operators import spatial
from trafficloom.operators.normalize import normalize
from trafficloom.operators.windows import segment_window_agg
from trafficloom.sources import sinks

KEYS = ["road_segment_id", "source_type"]


def dedup_stream(df: DataFrame, keys: list[str] | None = None, ts: str = "event_time", bucket: str = "10 seconds", watermark: str = "30 seconds") -> DataFrame:
    """First row of each key and bucket. State goes with the watermark, whose delay should be a bucket and the lateness or more."""
    bucketed = df.withWatermark(ts, watermark).withColumn("_bucket", F.window(ts, bucket)["start"].cast("string"))
    return bucketed.dropDuplicatesWithinWatermark([*(keys or KEYS), "_bucket"]).drop("_bucket")


def silver_stream(df: DataFrame, source_type: str, roads: DataFrame, lookup: DataFrame | None = None, duration: str = "30 seconds", speed: str = "speed_kmh", flow: str = "flow", bucket: str = "10 seconds", watermark: str = "30 seconds") -> DataFrame:
    """Raw points to windows per segment; works on streams and, without the watermark's effect, on tables.

    Roads with equal buffers see the same points, so repeats and sums are kept once for the buffer, and its windows are
    unfolded to the roads that have it as they close. Several rows of a road are one road with all their buffers.
    """
    points = normalize(df, source_type, lookup).where(F.col("event_time").isNotNull())
    whole = roads.where(spatial.has_area()).groupBy(F.col("road_segment_id").cast("long").alias("road_segment_id"))
    shapes, members = spatial.shared_buffers(whole.agg(F.array_sort(F.collect_set("buffer_geom")).alias("_rings")))
    placed = spatial.within_shapes(points, shapes.select("_shape", "_rings"))
    once = dedup_stream(placed, ["_shape", "source_type"], bucket=bucket, watermark=watermark)
    sums = segment_window_agg(once, duration, speed=speed, flow=flow, by="_shape")
    return sums.join(members, "_shape").select(F.explode("_ids").alias("road_segment_id"), *[c for c in sums.columns if c != "_shape"])


def start_silver(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "update", available_now: bool = False) -> StreamingQuery:
    """Starts the stream into a micro-batch sink, with a checkpoint of its own."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def table_sink(target: str, archive: str | None = None) -> Callable[[DataFrame, int], None]:
    """A sink that merges each batch into a table by segment and time, and archives it by hour."""

    def write(batch_df: DataFrame, batch_id: int) -> None:
        batch_df = batch_df.persist()
        sinks.upsert_batch(batch_df, batch_id, target, ["road_segment_id", "event_time"])
        if archive:
            sinks.write_hour_partitions(batch_df, batch_id, archive)
        batch_df.unpersist()

    return write

"""Read models: segments with their latest state, history, heatmap, predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficloom.functions import geo as G
from trafficloom.functions import traffic as T

from .windows import SEGMENT, latest_per_key

HISTORY_ROWS = 500


def _latest(silver: DataFrame) -> DataFrame:
    return latest_per_key(silver.select(SEGMENT, "event_time", "avg_speed_kmh", "congestion_score", "congestion_level"), [SEGMENT], ["event_time"]).drop("event_time")


def segments_latest(edges: DataFrame, silver: DataFrame, road_type: str | None = None) -> DataFrame:
    """Every road (of a type) with its newest traffic; roads without traffic stay."""
    roads = edges if road_type is None else edges.where(F.col("road_type") == road_type)
    return roads.select(F.col("id").alias(SEGMENT), "name", "road_type").join(_latest(silver), SEGMENT, "left")


def segment_history(silver: DataFrame, segment_id: int, as_of: Column, hours: int = 1) -> DataFrame:
    """A segment's windows of the last hours (1 to 24, else 1), newest first, at most 500."""
    hours = hours if 0 < hours <= 24 else 1
    rows = silver.where((F.col(SEGMENT) == segment_id) & (F.col("event_time") >= as_of - F.expr(f"INTERVAL {hours} HOURS")))
    return rows.select(SEGMENT, "event_time", "vehicle_count", "avg_speed_kmh", "flow_rate", "congestion_score").orderBy(F.desc("event_time")).limit(HISTORY_ROWS)


def parse_bbox(text: str | None) -> tuple[float, float, float, float] | None:
    """(minx, miny, maxx, maxy) of a text; None if it is missing or malformed."""
    try:
        box = tuple(float(x) for x in (text or "").split(","))
    except ValueError:
        return None
    return box if len(box) == 4 else None


def crosses_box(coords: Column, box: tuple[float, float, float, float]) -> Column:
    """Whether a polyline touches the box: some part has a stretch inside all four sides (Liang-Barsky)."""
    x0, y0, x1, y1 = box
    return F.exists(G.line_parts(coords), lambda p: clip_range(p, x0, y0, x1, y1)["inside"])


def clip_range(part: Column, x0: float, y0: float, x1: float, y1: float) -> Column:
    """struct<inside, t0, t1>: the stretch of a part, from 0 at a to 1 at b, that lies in the box."""
    ax, ay = part["a"]["lon"], part["a"]["lat"]
    dx, dy = part["b"]["lon"] - ax, part["b"]["lat"] - ay
    low, high, apart = [F.lit(0.0)], [F.lit(1.0)], F.lit(False)
    for p, q in ((-dx, ax - x0), (dx, x1 - ax), (-dy, ay - y0), (dy, y1 - ay)):
        r = q / F.nullif(p, F.lit(0.0))
        low.append(F.when(p < 0, r))
        high.append(F.when(p > 0, r))
        apart = apart | ((p == 0) & (q < 0))
    t0, t1 = F.greatest(*low), F.least(*high)
    return F.struct((~apart & (t0 <= t1)).alias("inside"), t0.alias("t0"), t1.alias("t1"))


def congestion_heatmap(edges: DataFrame, silver: DataFrame, bbox: str | None = None) -> DataFrame:
    """Centroid, newest speed, score and level of every road that touches the box; one GeoJSON feature a row."""
    box = parse_bbox(bbox)
    roads = edges if box is None else edges.where(crosses_box(F.col("geom"), box))
    rows = roads.select(F.col("id").alias(SEGMENT), G.line_centroid(F.col("geom")).alias("c")).join(_latest(silver).drop("congestion_level"), SEGMENT, "left")
    rows = rows.select(SEGMENT, F.col("c.lon").alias("centroid_lon"), F.col("c.lat").alias("centroid_lat"), "avg_speed_kmh", "congestion_score", T.heatmap_level(F.col("congestion_score")).alias("congestion_level"))
    return rows.withColumn("feature", G.to_geojson_feature(F.col("centroid_lon"), F.col("centroid_lat"), F.struct(SEGMENT, "congestion_score", "congestion_level", "avg_speed_kmh")))


def historical_speed(silver: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    recent = silver.where(F.col("event_time") >= as_of - F.expr(f"INTERVAL {days} DAYS"))
    return recent.groupBy(SEGMENT).agg(F.avg("avg_speed_kmh").alias("predicted_speed_kmh"))


def predictions_or_fallback(segments: DataFrame, predictions: DataFrame, silver: DataFrame, as_of: Column) -> DataFrame:
    """Each segment's latest prediction, else its mean speed of a week, tagged historical_avg, without confidence.

    `predictions` has one or more of a segment; of equal predicted_at the greatest prediction_id wins.
    """
    last = latest_per_key(predictions, [SEGMENT], ["predicted_at", "prediction_id"]).withColumn("_found", F.lit(True))
    mean = historical_speed(silver, as_of).withColumnRenamed("predicted_speed_kmh", "_mean")
    rows = segments.select(SEGMENT).join(last, SEGMENT, "left").join(mean, SEGMENT, "left")
    found = F.col("_found").isNotNull()
    return rows.select(SEGMENT, "predicted_at", F.when(found, F.col("predicted_speed_kmh")).otherwise(F.col("_mean")).alias("predicted_speed_kmh"), "confidence", F.when(found, F.col("model_version")).otherwise("historical_avg").alias("model"))

"""Camera frames: array expressions over their detections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VEHICLES = ("car", "truck", "bus", "motorcycle")
MIN_CONFIDENCE = 0.25
DETECTION = "struct<bbox:struct<x1:double,y1:double,x2:double,y2:double>,class_name:string,confidence:double>"


def filter_detections(df: DataFrame, classes: tuple = VEHICLES, min_conf: float = MIN_CONFIDENCE) -> DataFrame:
    keep = lambda d: d["class_name"].isin(*classes) & (d["confidence"] >= min_conf)
    return df.withColumn("detections", F.filter("detections", keep))


def sample_frames(df: DataFrame, n: int = 15) -> DataFrame:
    return df.where(F.col("frame_index") % n == 0)


def camera_dimension(df: DataFrame, json_col: str = "value") -> DataFrame:
    """Cameras from a JSON object keyed by camera id; an error for anything else."""
    schema = "map<string,struct<road_segment_id:long,location_name:string,pixel_per_meter:double,lat:double,lon:double>>"
    text = F.col(json_col)
    checked = F.when(F.get_json_object(text, "$").startswith("{"), text).otherwise(F.raise_error(F.lit("camera registry must be a JSON object keyed by camera id")).cast("string"))
    return df.select(F.explode(F.from_json(checked, schema)).alias("camera_id", "c")).select("camera_id", "c.*")


def enrich_camera(df: DataFrame, cameras: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with their camera's columns, rows of unknown cameras). The registry's size decides how it is joined."""
    new = [c for c in cameras.columns if c == "camera_id" or c not in df.columns]
    return df.join(cameras.select(*new), "camera_id"), df.join(cameras.select("camera_id"), "camera_id", "left_anti")


def _centre(d: Column) -> Column:
    return F.struct(((d["bbox"]["x1"] + d["bbox"]["x2"]) / 2.0).alias("x"), ((d["bbox"]["y1"] + d["bbox"]["y2"]) / 2.0).alias("y"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def _kmh(pixels: Column, ppm: Column, seconds: Column) -> Column:
    return pixels / ppm / seconds * 3.6


def cv_metrics(df: DataFrame, seconds: Column | float | None = None) -> DataFrame:
    """Count, speed, occupancy and queue of each frame; speed from the camera's frame before, paired by place in the list.

    Null where there is nothing to measure. Area and pixels per metre must be positive, as must `seconds`, by default the
    time between the frames.
    """
    w = Window.partitionBy("camera_id").orderBy("frame_index")
    rows = df.withColumn("_before", F.lag("detections").over(w)).withColumn("_dt", (F.unix_micros(F.col("frame_timestamp").cast("timestamp")) - F.unix_micros(F.lag("frame_timestamp").over(w).cast("timestamp"))) / 1e6)
    dt = F.col("_dt") if seconds is None else seconds if isinstance(seconds, Column) else F.lit(float(seconds))
    now, before, ppm = F.col("detections"), F.col("_before"), F.col("pixel_per_meter")
    n = F.least(F.size(now), F.size(before))
    move = F.zip_with(F.slice(now, F.lit(1), n), F.slice(before, F.lit(1), n), lambda a, b: F.hypot(_centre(a)["x"] - _centre(b)["x"], _centre(a)["y"] - _centre(b)["y"]))
    speed = F.when((n > 0) & (dt > 0), _kmh(_sum(move) / n, ppm, dt))
    area = _sum(F.transform(now, lambda d: F.greatest(F.lit(0.0), d["bbox"]["x2"] - d["bbox"]["x1"]) * F.greatest(F.lit(0.0), d["bbox"]["y2"] - d["bbox"]["y1"])))
    frame = F.col("frame_width").cast("double") * F.col("frame_height")
    good = (frame > 0) & (ppm > 0)
    span = lambda c: F.array_max(F.transform(now, lambda d: _centre(d)[c])) - F.array_min(F.transform(now, lambda d: _centre(d)[c]))
    return rows.select(
        "camera_id", "frame_index", "frame_timestamp",
        F.size(now).cast("long").alias("vehicle_count"),
        F.when(good, speed).alias("avg_speed_kmh"),
        F.when(good, F.least(area / frame, F.lit(1.0))).alias("lane_occupancy"),
        F.when(good & (F.size(now) > 0), F.greatest(span("x"), span("y")) / ppm).alias("queue_length_m"),
    )


def tracked_speed(df: DataFrame, seconds: float = 1.0) -> DataFrame:
    """`df` with tracked_kmh: mean speed of the tracked points (tracks array<struct<x0,y0,x1,y1,status>>), null without any."""
    ok = F.filter("tracks", lambda t: t["status"] == 1)
    moves = F.transform(ok, lambda t: F.hypot(t["x1"] - t["x0"], t["y1"] - t["y0"]))
    return df.withColumn("tracked_kmh", F.when(F.size(ok) > 0, _kmh(_sum(moves) / F.size(ok), F.col("pixel_per_meter"), F.lit(float(seconds)))))

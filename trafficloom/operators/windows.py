"""Event-time windows, latest rows and the tables built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trafficloom.functions import traffic as T

from . import scan

STEP = "5 minutes"
SEGMENT = "road_segment_id"


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key with the greatest order columns, by one partial aggregation and no sort. The columns in `order` should tell rows apart."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def latest_within(df: DataFrame, key: list[str], ts: str, as_of: Column, max_age: str = "10 minutes") -> DataFrame:
    """The latest row of each key that is no older than max_age at as_of."""
    fresh = df.where((F.col(ts) <= as_of) & (F.col(ts) > as_of - F.expr(f"INTERVAL {max_age}")))
    return latest_per_key(fresh, key, [ts, *[c for c in df.columns if c not in (*key, ts)]])


def segment_window_agg(df: DataFrame, duration: str = "30 seconds", ts: str = "event_time", speed: str = "speed_kmh", flow: str = "flow", by: str = SEGMENT) -> DataFrame:
    """Per segment (or `by`) and tumbling window: rows, mean speed, summed flow. Works on streams that have a watermark on ts."""
    flows = F.col(flow) if flow in df.columns else F.lit(1.0)
    key = F.col(SEGMENT).cast("long").alias(SEGMENT) if by == SEGMENT else F.col(by)
    return df.groupBy(key, F.window(ts, duration).alias("w")).agg(
        F.count("*").alias("vehicle_count"), F.avg(speed).alias("avg_speed_kmh"), F.sum(flows.cast("double")).alias("flow_rate")
    ).select(by, F.col("w.start").alias("event_time"), "vehicle_count", "avg_speed_kmh", "flow_rate")


def running_capacity(count: Column, w) -> Column:
    """The greatest count of this and earlier windows, 1 at least."""
    return F.greatest(F.max(F.coalesce(count, F.lit(0))).over(w), F.lit(1))


def dwell_flag_rows(speed: Column, w, threshold: float = 5.0) -> Column:
    """Whether this and the two rows before are slow; gaps in time do not count, missing rows and speeds are not slow."""
    slow = [speed < threshold, *(F.lag(speed, k).over(w) < threshold for k in (1, 2))]
    return F.coalesce(slow[0] & slow[1] & slow[2], F.lit(False))


def running_state(events: DataFrame, count: str = "vehicle_count", speed: str = "avg_speed_kmh", threshold: float = 5.0, segment: str = SEGMENT, ts: str = "event_time", tiebreak: str = "event_id", rows: int = scan.ROWS) -> DataFrame:
    """`events` with capacity (the greatest count of the segment so far, 1 at least) and dwell_flag (this and the two rows before are slow).

    A segment with more than `rows` rows is cut into slices: the greatest count of the slices before is carried to each,
    and the two rows before it.
    """
    cut = scan.with_neighbours(scan.cut(events, [segment], ts, rows), [segment], [ts, tiebreak], back=2)
    cut = scan.with_carry(cut, [segment], {count: "_most"})
    w = scan.slice_window([segment], [ts, tiebreak])
    so_far = running_capacity(F.coalesce("_most", count), w.rowsBetween(Window.unboundedPreceding, 0))
    return cut.withColumns({"capacity": so_far, "dwell_flag": dwell_flag_rows(F.col(speed), w, threshold)}).where("_own").select(*events.columns, "capacity", "dwell_flag")


def window_sums(events: DataFrame, step: str = STEP, tiebreak: str = "event_id") -> DataFrame:
    """Per segment and window: counts, mean speed, flow and the last weather factor. Rows of equal time are told apart by `tiebreak`."""
    return (
        events.groupBy(SEGMENT, F.window("event_time", step).alias("w"))
        .agg(
            F.sum(F.coalesce("vehicle_count", F.lit(0))).cast("long").alias("vehicle_count"),
            F.avg("avg_speed_kmh").alias("avg_speed_kmh"),
            F.sum(F.coalesce("flow_rate", F.lit(0.0))).alias("flow_rate"),
            F.max_by("weather_factor", F.struct("event_time", tiebreak)).alias("weather_factor"),
        )
        .select(SEGMENT, F.col("w.start").alias("event_time"), F.col("w.end").alias("window_end"), "vehicle_count", "avg_speed_kmh", "flow_rate", "weather_factor")
    )


def traffic_features(sums: DataFrame, edges: DataFrame, dwell_below: float = 5.0) -> DataFrame:
    """The rows of `window_sums` with capacity so far, the window before, dwelling, score and level.

    The road's limit depends on the segment alone: it is joined to the sums, which are fewer rows than the events.
    """
    limits = edges.select(F.col("id").alias(SEGMENT), F.col("speed_limit_kmh").cast("double").alias("limit"))
    rows = sums.join(limits, SEGMENT, "left").withColumn("free_flow", F.coalesce("limit", F.lit(50.0))).drop("limit")
    w = Window.partitionBy(SEGMENT).orderBy("event_time")
    full = rows.select(
        "*",
        running_capacity(F.col("vehicle_count"), w).alias("capacity"),
        F.lag("avg_speed_kmh").over(w).alias("upstream_speed_kmh"),
        dwell_flag_rows(F.col("avg_speed_kmh"), w, dwell_below).alias("dwell_flag"),
    ).withColumn("congestion_score", T.congestion_score_sql(F.col("avg_speed_kmh"), F.col("free_flow"), F.col("vehicle_count"), F.col("capacity")))
    return full.select(SEGMENT, "event_time", "window_end", "vehicle_count", "avg_speed_kmh", "flow_rate", "upstream_speed_kmh", "weather_factor", "dwell_flag", "congestion_score", T.congestion_level(F.col("congestion_score")).alias("congestion_level"))


def segment_traffic_5min(events: DataFrame, edges: DataFrame, step: str = STEP, dwell_below: float = 5.0, tiebreak: str = "event_id") -> DataFrame:
    """Traffic per segment and window, with capacity so far, the window before, dwelling, score and level.

    The aggregation comes first, so the windows over a segment see one row per step, however many events it has. The
    aggregate and the windows over it shuffle by segment once more, as the aggregate's key is finer.
    """
    return traffic_features(window_sums(events, step, tiebreak), edges, dwell_below)


def segment_congestion_daily(silver: DataFrame, step_minutes: float = 5.0) -> DataFrame:
    """Per segment and day: greatest and mean score, congested hours, hour of the peak (of equal ones the first)."""
    score = F.round("congestion_score", 9)
    return silver.groupBy(SEGMENT, F.date_trunc("day", F.col("event_time")).cast("timestamp_ntz").alias("event_date")).agg(
        F.max("congestion_score").alias("max_congestion_score"),
        F.avg("congestion_score").alias("avg_congestion_score"),
        F.sum(F.when(score >= T.CONGESTED_FROM, F.lit(step_minutes / 60.0)).otherwise(F.lit(0.0))).alias("total_congestion_hours"),
        F.min_by(F.hour("event_time"), F.struct(-score, "event_time")).alias("peak_hour"),
    )


def trajectory_legs(fleet: DataFrame, vehicle: str = "vehicle_id_hash", ts: str = "timestamp", tiebreak: str = "event_id", rows: int = scan.ROWS) -> DataFrame:
    """Length, bearing and speed of the leg from each vehicle's point before; nulls at its first point or without time between.

    A vehicle with more than `rows` points is cut into slices, each given the last point before it.
    """
    from trafficloom.functions import geo as G

    cut = scan.with_neighbours(scan.cut(fleet, [vehicle], ts, rows), [vehicle], [ts, tiebreak])
    legs = cut.withColumn("_p", F.lag(F.struct("lat", "lon", ts)).over(scan.slice_window([vehicle], [ts, tiebreak]))).where("_own")
    seconds = (F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.col(f"_p.{ts}").cast("timestamp"))) / 1e6
    args = (F.col("_p.lat"), F.col("_p.lon"), F.col("lat"), F.col("lon"))
    return legs.select(*fleet.columns, G.haversine_m(*args).alias("leg_m"), G.bearing_deg(*args).alias("leg_bearing"), seconds.alias("leg_s")).withColumn("leg_kmh", F.when(F.col("leg_s") > 0, F.col("leg_m") / F.col("leg_s") * 3.6))

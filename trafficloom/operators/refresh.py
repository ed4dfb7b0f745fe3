"""Refreshes of the five-minute and daily tables: written, checked, and published only if the checks pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trafficloom.sources.scratch import Steps
from trafficloom.sources.snapshots import SnapshotStore

from . import quality
from .windows import SEGMENT, STEP, segment_congestion_daily, traffic_features, window_sums

SUMS = [SEGMENT, "event_time", "window_end", "vehicle_count", "avg_speed_kmh", "flow_rate", "weather_factor"]
DATE = "event_date"


@dataclass
class Outcome:
    """The version published, or None; the checks with their status; how many rows of the five-minute table changed."""

    version: int | None
    report: DataFrame
    changed: int


def _dated(silver: DataFrame) -> DataFrame:
    return silver.withColumn(DATE, F.to_date("event_time"))


def _gold(silver: DataFrame, step_minutes: float) -> DataFrame:
    return segment_congestion_daily(silver, step_minutes).withColumn(DATE, F.to_date(DATE))


def _judge(rows: DataFrame, edges: DataFrame, limits: dict | None, steps: Steps) -> tuple[bool, DataFrame]:
    report = steps.write(quality.with_limits(quality.quality_report(rows, edges), limits))
    return report.where("status = 'error'").limit(1).count() == 0, report


def rebuild(store: SnapshotStore, events: DataFrame, edges: DataFrame, step: str = STEP, step_minutes: float = 5.0, dwell_below: float = 5.0, limits: dict | None = None) -> Outcome:
    """Makes both tables from all events; see `quality.with_limits` for limits. Without a pass nothing is published."""
    steps = Steps(store.spark)
    silver = steps.write(_dated(traffic_features(window_sums(events, step), edges, dwell_below)))
    passed, report = _judge(silver, edges, limits, steps)
    if not passed:
        return Outcome(None, report, silver.count())
    staged = {"silver": store.stage(silver, DATE), "gold": store.stage(_gold(silver, step_minutes), DATE)}
    version = store.publish(store.current(), staged, list(staged))
    return Outcome(version, report, silver.count())


def refresh(store: SnapshotStore, events: DataFrame, new: DataFrame, edges: DataFrame, step: str = STEP, step_minutes: float = 5.0, dwell_below: float = 5.0, limits: dict | None = None) -> Outcome:
    """Brings both tables up to `events`, which has the rows of `new`, late ones too, besides those already counted.

    The windows that `new` falls in are summed again from the events. What the windows of those segments say of windows
    before them (capacity so far, speed before, dwelling) is made anew from the sums that the table holds; rows that come
    out as they were are left alone. Rows that changed are checked, and dates that have any are written anew with their
    daily rows. If no check fails with an error both tables appear in one version; else the old ones stay.
    """
    base = store.current()
    old = store.read("silver", base["version"]) if "silver" in base["tables"] else None
    if old is None:
        return rebuild(store, events, edges, step, step_minutes, dwell_below, limits)
    steps = Steps(store.spark)
    key = [SEGMENT, "event_time"]
    hit = steps.write(new.select(SEGMENT, F.window("event_time", step)["start"].alias("event_time")).distinct())
    windows_of = events.withColumn("_w", F.window("event_time", step)["start"])
    touched = hit.select(F.col(SEGMENT).alias("_s"), F.col("event_time").alias("_e"))
    again = windows_of.join(touched, (F.col(SEGMENT) == F.col("_s")) & (F.col("_w") == F.col("_e")), "left_semi").drop("_w")
    segments = hit.select(SEGMENT).distinct()
    known = old.join(segments, SEGMENT, "left_semi").join(hit, key, "left_anti").select(*SUMS)
    made = _dated(traffic_features(known.unionByName(window_sums(again, step).select(*SUMS)), edges, dwell_below))
    was = old.select(*[F.col(c).alias(f"_{c}") for c in key], F.struct(*made.columns).alias("_was"))
    same = (F.col(SEGMENT) == F.col(f"_{SEGMENT}")) & (F.col("event_time") == F.col("_event_time")) & F.struct(*made.columns).eqNullSafe(F.col("_was"))
    changed = steps.write(made.join(was, same, "left_anti"))
    passed, report = _judge(changed, edges, limits, steps)
    n = changed.count()
    if not passed or not n:
        return Outcome(None, report, n)
    dates = [str(r[DATE]) for r in changed.select(DATE).distinct().collect()]
    silver = steps.write(store.read("silver", base["version"], dates).join(changed.select(*key), key, "left_anti").unionByName(changed))
    days = changed.select(SEGMENT, DATE).distinct()
    daily = _gold(silver.join(days, [SEGMENT, DATE], "left_semi"), step_minutes)
    gold = store.read("gold", base["version"], dates).join(days, [SEGMENT, DATE], "left_anti").unionByName(daily)
    version = store.publish(base, {"silver": store.stage(silver, DATE), "gold": store.stage(gold, DATE)})
    return Outcome(version, report, n)

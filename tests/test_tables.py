"""Golden values and edge cases of the window tables and read models."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trafficloom.functions import traffic as T
from trafficloom.operators import quality, serving, stateful, windows

AT = datetime(2026, 4, 29, 8, 0)
EVENT = "event_id long, road_segment_id long, event_time timestamp_ntz, avg_speed_kmh double, vehicle_count int, flow_rate double, weather_factor double"


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("args,want", [((0.0, 50.0, 10, 10), 1.0), ((50.0, 50.0, 0, 10), 0.0), ((10.0, 0.0, 1, 10), None), ((10.0, 50.0, 1, 0), None)])
def test_congestion_score(spark, args, want):
    assert value(spark, T.congestion_score(*map(F.lit, args))) == want


def test_strict_score_raises(spark):
    with pytest.raises(Exception, match="must be positive"):
        value(spark, T.congestion_score(F.lit(1.0), F.lit(0.0), F.lit(1), F.lit(1), strict=True))


@pytest.mark.parametrize("score,weather,want", [(0.5, "clear", 0.5), (0.5, "rain", 0.55), (0.5, "heavy_rain", 0.6), (0.5, "fog", 0.575), (0.95, "heavy_rain", 1.0), (0.5, None, 0.5)])
def test_weather_adjust(spark, score, weather, want):
    assert value(spark, T.weather_adjust(F.lit(score), F.lit(weather).cast("string"))) == pytest.approx(want)


@pytest.mark.parametrize("score,level,heat", [(0.91, "severe", "severe"), (0.6, "moderate", "heavy"), (0.7, "heavy", "heavy"), (0.3, "light", "moderate"), (0.0, "free_flow", "free_flow"), (None, None, "unknown")])
def test_levels(spark, score, level, heat):
    s = F.lit(score).cast("double")
    assert (value(spark, T.congestion_level(s)), value(spark, T.heatmap_level(s))) == (level, heat)


def test_bbox_and_clamp(spark):
    assert value(spark, T.clamp(F.lit(-10.0), -7.0, -6.6)) == -7.0 and value(spark, T.clamp(F.lit(50.0), 39.1, 39.4)) == 39.4
    box = (-7.0, 39.1, -6.6, 39.4)
    assert value(spark, T.in_bbox(F.lit(-7.0), F.lit(39.4), box)) and not value(spark, T.in_bbox(F.lit("x"), F.lit("39.2"), box)) and not value(spark, T.in_bbox(F.lit(None), F.lit(39.2), box))


def dwell(spark, speeds, step=30, mode="any"):
    rows = [(1, AT + timedelta(seconds=step * k), s) for k, s in enumerate(speeds)]
    df = spark.createDataFrame(rows, "road_segment_id long, event_time timestamp_ntz, avg_speed_kmh double")
    return [r.incident_flag for r in stateful.dwell_anchor(df, mode=mode).orderBy("event_time").collect()]


def test_dwell_anchor(spark):
    assert dwell(spark, [10.0, 4.5, 4.2, 4.8]) == [False, True, True, True]
    assert dwell(spark, [4.9, 4.3]) == [False, False]
    assert dwell(spark, [4.0, 4.0, 4.0], step=31) == [False] * 3
    assert dwell(spark, [None, 4.0, 4.0]) == [True] * 3
    assert dwell(spark, [1.0, 1.0, 1.0, 9.0], mode="latest") == [False] * 4


def silver(spark, rows, limit=50):
    edges = spark.createDataFrame([(1, limit)], "id long, speed_limit_kmh int")
    return windows.segment_traffic_5min(spark.createDataFrame(rows, EVENT), edges)


def test_silver_edges(spark):
    got = silver(spark, [(1, 1, AT, None, None, None, 1.0), (2, 1, AT + timedelta(minutes=6), 25.0, 4, 2.0, 1.1), (3, 1, AT + timedelta(minutes=6), 25.0, 4, 2.0, 1.2), (4, 9, AT, 10.0, 1, 1.0, 1.0)]).orderBy("road_segment_id", "event_time").collect()
    assert [r.vehicle_count for r in got] == [0, 8, 1] and got[0].congestion_score == pytest.approx(0.6) and got[1].weather_factor == 1.2
    assert got[1].congestion_score == pytest.approx(0.7) and got[1].congestion_level == "heavy" and got[0].upstream_speed_kmh is None
    assert silver(spark, [], 50).count() == 0
    assert silver(spark, [(1, 1, AT, 5.0, 1, 1.0, 1.0)], 0).first().congestion_score == pytest.approx(0.4)


def test_silver_shuffles_segments_without_nested_loops(spark):
    plan = windows.segment_traffic_5min(spark.createDataFrame([], EVENT), spark.createDataFrame([], "id long, speed_limit_kmh int"))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_gold_peak_takes_the_first_of_equals(spark):
    rows = [(1, datetime(2026, 4, 29, h), 0.8) for h in (9, 7, 11)]
    got = windows.segment_congestion_daily(spark.createDataFrame(rows, "road_segment_id long, event_time timestamp_ntz, congestion_score double")).first()
    assert got.peak_hour == 7 and got.total_congestion_hours == pytest.approx(0.25)


def test_predictions_fallback(spark):
    s = spark.createDataFrame([(7, AT, 20.0), (7, AT, 40.0)], "road_segment_id long, event_time timestamp_ntz, avg_speed_kmh double")
    p = spark.createDataFrame([], "road_segment_id long, predicted_at timestamp_ntz, prediction_id long, predicted_speed_kmh double, model_version string, confidence double")
    got = serving.predictions_or_fallback(s.select("road_segment_id").distinct(), p, s, F.lit(AT)).first()
    assert (got.predicted_speed_kmh, got.model, got.confidence) == (30.0, "historical_avg", None)


def test_history_hours_and_bbox(spark):
    assert serving.parse_bbox("1,2,3") is None and serving.parse_bbox("a,b,c,d") is None and serving.parse_bbox("1,2,3,4") == (1.0, 2.0, 3.0, 4.0)
    s = silver(spark, [(k, 1, AT - timedelta(minutes=30 * k), 25.0, 4, 2.0, 1.1) for k in range(5)])
    assert serving.segment_history(s, 1, F.lit(AT), 99).count() == 3


def test_quality_counts_failures(spark):
    df = spark.createDataFrame([(1, "x", 0.5), (None, "light", 2.0)], "road_segment_id long, congestion_level string, congestion_score double")
    assert [r.n_failed for r in quality.check_not_null(df, ["road_segment_id"]).collect()] == [1]
    assert quality.check_accepted(df, "congestion_level", ("light",)).first().n_failed == 1
    assert quality.check_relationship(df, "road_segment_id", spark.createDataFrame([(2,)], "id long"), "id").first().n_failed == 1
    assert quality.check_min_rows(df, 3).first().n_failed == 1 and quality.check_expression(df, "score", "congestion_score <= 1").first().n_failed == 1

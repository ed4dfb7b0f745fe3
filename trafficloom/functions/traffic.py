"""Column expressions of congestion: scores, levels, weather."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SPEED_WEIGHT, DENSITY_WEIGHT = 0.6, 0.4
#: Upper bounds of the congestion levels.
LEVELS = ((0.30, "free_flow"), (0.50, "light"), (0.70, "moderate"), (0.90, "heavy"))
TOP_LEVEL = "severe"
#: Lower bounds of the heatmap's levels.
HEATMAP_LEVELS = ((0.75, "severe"), (0.5, "heavy"), (0.25, "moderate"))
#: Factors by weather.
WEATHER_FACTORS = {"rain": 1.10, "heavy_rain": 1.20, "fog": 1.15}
CONGESTED_FROM = 0.70


def unit(c: Column) -> Column:
    """c cut to [0, 1]; null stays null."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0)))


def clamp(c: Column, low: float, high: float) -> Column:
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(float(low))), F.lit(float(high))))


def in_bbox(lat: Column, lon: Column, bbox: tuple[float, float, float, float]) -> Column:
    """Whether a point lies in (south, west, north, east), borders included. Missing or non-numeric coordinates do not."""
    south, west, north, east = bbox
    inside = lat.try_cast("double").between(south, north) & lon.try_cast("double").between(west, east)
    return F.coalesce(inside, F.lit(False))


def floor_time(ts: Column, minutes: int) -> Column:
    return F.window(ts, f"{minutes} minutes").start


def congestion_score(speed: Column, free_flow: Column, count: Column, capacity: Column, strict: bool = False) -> Column:
    """Weighted lack of speed and density, in [0, 1]. Where free flow or capacity is not positive: null, or an error if strict."""
    valid = (free_flow > 0) & (capacity > 0)
    score = unit((1.0 - unit(speed / free_flow)) * SPEED_WEIGHT + unit(count.cast("double") / capacity) * DENSITY_WEIGHT)
    return F.when(valid, score).otherwise(F.raise_error(F.lit("free flow speed and capacity must be positive")).cast("double") if strict else F.lit(None).cast("double"))


def congestion_score_sql(speed: Column, free_flow: Column, count: Column, capacity: Column) -> Column:
    """The tables' variant: no speed counts as standing still, and a divisor of 0 gives a full ratio."""

    def ratio(x, y):
        return F.least(F.coalesce(x.cast("double"), F.lit(0.0)) / F.nullif(y.cast("double"), F.lit(0.0)), F.lit(1.0))

    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (1.0 - ratio(speed, free_flow)) * SPEED_WEIGHT + ratio(count, capacity) * DENSITY_WEIGHT))


def congestion_level(score: Column) -> Column:
    """Level of a score; null for none. Scores are rounded to 9 places first, so that sums on a bound fall on one side."""
    s = F.round(score, 9)
    level = reduce(lambda acc, x: acc.when(s < x[0], x[1]), LEVELS, F.when(s.isNull(), F.lit(None).cast("string")))
    return level.otherwise(TOP_LEVEL)


def heatmap_level(score: Column) -> Column:
    s = F.round(score, 9)
    level = reduce(lambda acc, x: acc.when(s >= x[0], x[1]), HEATMAP_LEVELS, F.when(s.isNull(), "unknown"))
    return level.otherwise("free_flow")


def weather_adjust(score: Column, weather: Column) -> Column:
    factor = reduce(lambda acc, x: acc.when(weather == x[0], F.lit(x[1])), WEATHER_FACTORS.items(), F.when(weather.isNull(), F.lit(1.0)))
    return unit(score * factor.otherwise(F.lit(1.0)))

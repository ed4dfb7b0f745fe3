"""Column expressions over raw road attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROAD_TYPES = ("primary", "secondary", "tertiary", "residential")
DEFAULT_SPEED_LIMIT = 50


def allowed_road_type(values: Column) -> Column:
    """The first allowed type of an array of them, in lower case; null if there is none."""
    low = F.transform(values, lambda v: F.lower(v))
    return F.try_element_at(F.filter(low, lambda v: v.isin(*ROAD_TYPES)), F.lit(1))


def coerce_speed_limit(c: Column, mode: str = "first") -> Column:
    """Speed limit in a text: its first number, or (mode "concat") all its digits run together; 50 without any."""
    digits = F.regexp_extract(c, r"\d+", 0) if mode == "first" else F.regexp_replace(c, r"[^0-9]", "")
    return F.coalesce(digits.try_cast("int"), F.lit(DEFAULT_SPEED_LIMIT))

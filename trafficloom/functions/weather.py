"""Column expressions that read weather payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEAVY_RAIN_MM = 7.5


def weather_condition(main: Column, description: Column, rain_mm: Column) -> Column:
    """heavy_rain, fog, rain or clear, tested in this order; upper and lower case are equal."""
    m, d = (F.lower(F.coalesce(c, F.lit(""))) for c in (main, description))
    heavy = (F.coalesce(rain_mm, F.lit(0.0)) >= HEAVY_RAIN_MM) | d.contains("heavy")
    fog = m.contains("fog") | d.contains("mist") | d.contains("fog")
    rain = m.contains("rain") | d.contains("rain")
    return F.when(heavy, "heavy_rain").when(fog, "fog").when(rain, "rain").otherwise("clear")


def parse_any_timestamp(c: Column, fallback: Column) -> Column:
    """A UTC time from epoch seconds or ISO text (Z or an offset allowed; none: UTC), else the fallback. As timestamp_ntz."""
    text = c.cast("string")
    seconds = text.try_cast("double")
    epoch = F.timestamp_micros((seconds * 1000000).cast("long"))
    # an offset is applied in UTC whatever the session's zone is
    zoned = F.try_to_timestamp(F.concat(F.regexp_replace(text, "Z$", ""), F.when(text.rlike(r"[+-]\d\d:?\d\d$"), "").otherwise("+00:00")))
    return F.coalesce(utc_ntz(F.when(seconds.isNotNull(), epoch).otherwise(F.when(text.rlike(r"^\d{4}-\d\d-\d\d"), zoned))), fallback)


def utc_ntz(ts: Column) -> Column:
    """The UTC wall clock of an instant, whatever the session's zone is."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))


def utc_instant(ts: Column) -> Column:
    """The instant of a UTC wall clock (timestamp_ntz), whatever the session's zone is."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), ts).cast("timestamp")

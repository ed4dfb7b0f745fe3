"""From parsed payloads to one shape: coordinates, event time, speeds, missing speeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficloom import schemas as S


def deserialize(df: DataFrame, source_type: str | None = None, envelope: str = "auto", prefix: str = S.TOPIC_PREFIX) -> DataFrame:
    """Payload columns of `value` (JSON), with source_type, kafka_timestamp and parsed (false for what is no JSON object).

    The source is `source_type`, whose schema is used; rows of other topics should be filtered first. envelope "auto"
    takes a field from the flat payload, else from the envelope (geo, timestamp, attributes). Keyed rows keep their key
    as source_type.
    """
    if source_type not in S.SOURCE_SCHEMAS:
        raise ValueError(f"unknown source type: {source_type}")
    flat = S.SOURCE_SCHEMAS[source_type]
    fields = [f.split() for f in flat.split(", ")]
    value = F.col("value")
    rows = df.withColumn("_p", F.from_json(value, flat)).withColumn("parsed", F.get_json_object(value, "$").startswith("{") & F.col("_p").isNotNull())
    cols = []
    for name, kind in fields:
        c = F.col("_p")[name]
        if envelope == "auto":
            wrapped = F.get_json_object(value, f"$.attributes.{S.ATTRIBUTE_NAMES.get(source_type, {}).get(name, name)}")
            own = {"lat": F.get_json_object(value, "$.geo.lat"), "lon": F.get_json_object(value, "$.geo.lon"), S.EVENT_TIME[source_type]: F.get_json_object(value, "$.timestamp")}.get(name)
            c = F.coalesce(c, wrapped.try_cast(kind), *([own.try_cast(kind)] if own is not None else []))
        cols.append(c.alias(name))
    key = [F.coalesce(F.col("key"), F.lit(source_type)).alias("source_type")] if "key" in df.columns else [F.lit(source_type).alias("source_type")]
    stamp = [F.col("timestamp").alias("kafka_timestamp")] if "timestamp" in df.columns else []
    return rows.select(*key, *stamp, "parsed", "value", *cols)


def standardize_coordinates(df: DataFrame) -> DataFrame:
    """latitude to lat and longitude or lng to lon, unless the target exists."""
    for old, new in (("latitude", "lat"), ("longitude", "lon"), ("lng", "lon")):
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    return df


def standardize_event_time(df: DataFrame, source_type: str) -> DataFrame:
    """The source's time column, as event_time; text without an offset is UTC in a UTC session."""
    old = S.EVENT_TIME[source_type]
    if old not in df.columns:
        return df
    kind = dict(df.dtypes)[old]
    stamp = F.col(old) if kind.startswith("timestamp") else F.col(old).try_cast("timestamp")
    return df.withColumn("event_time", stamp).drop(old)


def standardize_speeds(df: DataFrame) -> DataFrame:
    """Every *_mph column as *_kmh, unless that exists."""
    new = {c[:-4] + "_kmh": F.col(c).cast("double") * S.MPH_TO_KMH for c in df.columns if c.endswith("_mph") and c[:-4] + "_kmh" not in df.columns}
    return df.withColumns(new) if new else df


def speed_lookup(history: DataFrame, segment: str = "road_segment_id", speed: str = "avg_speed_kmh") -> DataFrame:
    return history.groupBy(segment).agg(F.percentile(speed, F.lit(0.5)).alias("median_speed_kmh"))


def fill_speed(df: DataFrame, lookup: DataFrame, segment: str = "road_segment_id", speed: str = "avg_speed_kmh") -> DataFrame:
    """Missing speeds from each segment's median. The lookup's size decides how it is joined. Frames without the columns stay as they are."""
    missing = {segment, "median_speed_kmh"} - set(lookup.columns)
    if missing:
        raise ValueError(f"lookup lacks {sorted(missing)}")
    if not {segment, speed} <= set(df.columns):
        return df
    medians = lookup.select(F.col(segment).alias("_segment"), F.col("median_speed_kmh").alias("_median"))
    return df.join(medians, F.col(segment) == F.col("_segment"), "left").withColumn(speed, F.coalesce(speed, "_median")).drop("_segment", "_median")


def normalize(df: DataFrame, source_type: str, lookup: DataFrame | None = None) -> DataFrame:
    df = df.transform(standardize_coordinates).transform(standardize_event_time, source_type).transform(standardize_speeds)
    return df if lookup is None else fill_speed(df, lookup)


def rule_errors(contract: str) -> Column:
    """array<string>: names of the contract's rules that a row breaks."""
    rules = [F.when(~F.coalesce(F.expr(f"({rule})"), F.lit(False)), F.lit(name)) for name, rule in S.CONTRACTS[contract]]
    return F.filter(F.array(*rules), lambda e: e.isNotNull())


def validate(df: DataFrame, contract: str) -> DataFrame:
    """`df` with `errors`, the names of the broken rules."""
    return df.withColumn("errors", rule_errors(contract))


def split_valid_dlq(df: DataFrame, contract: str, source_topic: str, failed_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, dead letters): a dead letter holds the row as JSON, the error's type and message, topic and time."""
    parsed = F.col("parsed") if "parsed" in df.columns else F.lit(True)
    checked = validate(df, contract)
    bad = (F.size("errors") > 0) | ~parsed
    payload = F.col("value") if "value" in df.columns else F.to_json(F.struct(*df.columns))
    dlq = checked.where(bad).select(
        payload.alias("original_payload"),
        F.when(~parsed, "parse_error").otherwise("validation_error").alias("error_type"),
        F.when(~parsed, "payload is no JSON object").otherwise(F.concat(F.lit("invalid: "), F.array_join("errors", ", "))).alias("error_message"),
        F.lit(source_topic).alias("source_topic"),
        (failed_at if failed_at is not None else F.current_timestamp()).alias("failed_at"),
    )
    return checked.where(~bad).drop("errors"), dlq

"""Ingestion chains: envelopes, pseudonyms, filters with reasons, counters, webhook and weather payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficloom import schemas as S
from trafficloom.functions import text as X
from trafficloom.functions import traffic as T
from trafficloom.functions import weather as W

from trafficloom.sources.sinks import JSON

from .normalize import rule_errors
from .stateful import flag_residential

INCIDENT_KEYS = ("incident_type", "lat", "lon", "severity", "reported_at", "id")


def wrap_envelope(df: DataFrame, source: str, ts: str, lat: str = "lat", lon: str = "lon", attrs: list[str] | None = None, id_cols: list[str] | None = None) -> DataFrame:
    """Rows as raw messages: source, UTC timestamp, geo, attributes (JSON), message_id, schema_version.

    With id_cols the id is a hash of them, so that a replay gives the same; else it is random.
    """
    attrs = attrs if attrs is not None else [c for c in df.columns if c not in (ts, lat, lon)]
    message_id = F.sha2(F.concat_ws("|", F.lit(source), *[F.col(c).cast("string") for c in id_cols]), 256) if id_cols else F.uuid()
    return df.select(
        F.lit(source).alias("source"),
        F.col(ts).alias("timestamp"),
        F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lon")).alias("geo"),
        F.to_json(F.struct(*attrs), JSON).alias("attributes"),
        message_id.alias("message_id"),
        F.lit(S.SCHEMA_VERSION).alias("schema_version"),
    )


def pseudonymize(df: DataFrame, col: str, salt_date: Column, out: str | None = None) -> DataFrame:
    """SHA-256 of the id and the salt's ISO date in place of the id, which goes. A missing id gives null; the contract's rule then rejects it."""
    out = out or f"{col}_hash"
    digest = F.sha2(F.concat(F.col(col).cast("string"), F.date_format(salt_date, "yyyy-MM-dd")), 256)
    return df.withColumn(out, digest).drop(*([col] if out != col else []))


TELECOM_OUTCOMES = ("bbox", "invalid", "residential", "published")


def telecom_judged(pings: DataFrame, salt_date: Column, bbox: tuple = S.BBOX) -> DataFrame:
    """Pings with device_id_hash, and outcome: bbox or invalid, null for those that are still to be looked at for dwelling. Works on streams."""
    inside = T.in_bbox(F.col("lat"), F.col("lon"), bbox)
    bad = F.size(rule_errors("telecom")) > 0
    return pseudonymize(pings, "device_id", salt_date).withColumn("outcome", F.when(~inside, "bbox").when(bad, "invalid"))


def telecom_bronze(pings: DataFrame, salt_date: Column, bbox: tuple = S.BBOX, tiebreak: str = "event_id") -> DataFrame:
    """Pings (device_id, tower_id, lat, lon, timestamp) with device_id_hash and outcome: bbox, invalid, residential or published.

    The order is the reference's: outside points leave before contracts and dwelling are looked at.
    """
    rows = telecom_judged(pings, salt_date, bbox)
    return flag_residential(rows, tiebreak=tiebreak, where=F.col("outcome").isNull()).withColumn("outcome", F.coalesce("outcome", F.when(F.col("residential"), "residential").otherwise("published"))).drop("residential")


def fleet_bronze(points: DataFrame, salt_date: Column) -> DataFrame:
    """Fleet points (vehicle_id, …) with vehicle_id_hash and outcome: published or invalid."""
    rows = pseudonymize(points, "vehicle_id", salt_date)
    return rows.withColumn("outcome", F.when(F.size(rule_errors("fleet_gps")) > 0, "invalid").otherwise("published"))


def ingest_counts(df: DataFrame, source: str) -> DataFrame:
    """(source, outcome, n_rows) of rows with an outcome."""
    return df.groupBy(F.lit(source).alias("source"), "outcome").agg(F.count("*").alias("n_rows"))


_WEATHER = "name string, dt string, timestamp string, visibility string, rain struct<`1h`: string, `3h`: string>, weather array<struct<main: string, description: string>>, main struct<temp: string>"


def weather_readings(df: DataFrame, json_col: str = "value", station: str = "unknown", fallback: Column | None = None) -> DataFrame:
    """Readings from weather payloads, one per row; what is no JSON object goes. A payload is parsed once."""
    rows = df.where(F.get_json_object(json_col, "$").startswith("{")).withColumn("_j", F.from_json(json_col, _WEATHER))
    number = lambda c, default: F.coalesce(*[F.col(f"_j.{x}").try_cast("double") for x in c], F.lit(default))
    rows = rows.withColumn("_rain", number(["rain.`1h`", "rain.`3h`"], 0.0)).withColumn("_first", F.try_element_at("_j.weather", F.lit(1)))
    return rows.select(
        *[c for c in df.columns if c != json_col],
        F.coalesce(F.nullif(F.col("_j.name"), F.lit("")), F.lit(station)).alias("station_id"),
        W.parse_any_timestamp(F.coalesce("_j.dt", "_j.timestamp"), fallback if fallback is not None else W.utc_ntz(F.current_timestamp())).alias("timestamp"),
        W.weather_condition(F.col("_first.main"), F.col("_first.description"), F.col("_rain")).alias("condition"),
        F.col("_rain").alias("rainfall_mm"),
        number(["visibility"], 0.0).alias("visibility_m"),
        number(["main.temp"], 0.0).alias("temperature_c"),
    )


def _object(c: Column) -> Column:
    """The text if it is a JSON object."""
    got = F.get_json_object(c, "$")
    return F.when(got.startswith("{"), got)


_REPORT = ("id", "incident_id", "incident_type", "lat", "lon", "reported_at", "source", "description", "severity")
_HOOK = ", ".join(f"{k} string" for k in dict.fromkeys(("incident", "report", "payload", "body", "message", "text", *INCIDENT_KEYS)))
_HOOK += ", entry array<struct<changes: array<struct<value: struct<messages: array<struct<text: struct<body: string>>>>>>>>"


def _message_body(j: Column) -> Column:
    """Text of a parsed webhook message: body, message or text, else the first text.body under entry[].changes[].value.messages[]."""
    bodies = F.flatten(F.transform(j["entry"], lambda e: F.flatten(F.transform(e["changes"], lambda c: F.transform(c["value"]["messages"], lambda m: m["text"]["body"])))))
    first = F.try_element_at(F.filter(bodies, lambda b: b.isNotNull()), F.lit(1))
    return F.coalesce(*[F.when(~j[k].startswith("{"), j[k]) for k in ("body", "message", "text")], first)


def read_incidents(df: DataFrame, json_col: str = "value") -> DataFrame:
    """`df` with report, a struct of texts, or error, why there is none. A payload is parsed once, and what it holds once more.

    A report is the object under incident, report or payload; else the message text, read as a JSON object or as k=v
    parts; else the payload itself if it has a report's keys.
    """
    rows = df.withColumn("_j", F.from_json(json_col, _HOOK))
    rows = rows.withColumn("_body", F.trim(_message_body(F.col("_j"))))
    nested = F.coalesce(*[F.when(F.col(f"_j.{k}").startswith("{"), F.col(f"_j.{k}")) for k in ("incident", "report", "payload")])
    rows = rows.withColumn("_nested", nested)
    own = F.when(F.greatest(*[F.col(f"_j.{k}").isNotNull() for k in INCIDENT_KEYS]), F.col(json_col))
    said = F.when(F.col("_body").isNull(), own).otherwise(_object(F.col("_body")))
    rows = rows.withColumn("_text", F.coalesce("_nested", said))
    # a map only for texts that are no objects: the parts are read, not written as JSON and parsed again
    rows = rows.withColumn("_pairs", F.when(F.col("_text").isNull() & F.col("_body").isNotNull(), X.parse_kv_text(F.col("_body"))))
    rows = rows.withColumn("_object", F.from_json("_text", ", ".join(f"{k} string" for k in _REPORT)))
    report = F.when(F.col("_text").isNotNull(), F.col("_object")).when(F.col("_pairs").isNotNull(), F.struct(*[F.col("_pairs")[k].alias(k) for k in _REPORT]))
    error = F.when(F.col("_body") == "", "message is empty").when(F.col("_body").isNotNull(), "message cannot be read").otherwise("unsupported payload")
    return rows.withColumn("report", report).withColumn("error", F.when(F.col("report").isNull(), error)).select(*df.columns, "report", "error")


def report_columns(default_time: Column | None = None, id_cols: list[str] | None = None) -> list[Column]:
    """The columns of a report read by read_incidents. Defaults: a new id (a hash if id_cols are given), source whatsapp, reported now."""
    new_id = F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in id_cols]), 256) if id_cols else F.uuid()
    now = default_time if default_time is not None else W.utc_ntz(F.current_timestamp())
    r = F.col("report")
    return [
        F.coalesce(r["id"], r["incident_id"], new_id).alias("id"),
        r["incident_type"].alias("incident_type"),
        r["lat"].try_cast("double").alias("lat"),
        r["lon"].try_cast("double").alias("lon"),
        W.parse_any_timestamp(r["reported_at"], now).alias("reported_at"),
        F.coalesce(r["source"], F.lit("whatsapp")).alias("source"),
        r["description"].alias("description"),
        r["severity"].try_cast("int").alias("severity"),
    ]


def extract_incidents(df: DataFrame, json_col: str = "value", default_time: Column | None = None, id_cols: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(reports, dead letters) from webhook payloads, as `read_incidents` reads them."""
    rows = read_incidents(df, json_col)
    keep = [c for c in df.columns if c != json_col]
    reports = rows.where("report is not null").select(*keep, *report_columns(default_time, id_cols))
    dlq = rows.where("report is null").select(*keep, F.col(json_col).alias("original_payload"), F.lit("parse_error").alias("error_type"), F.col("error").alias("error_message"))
    return reports, dlq


def to_event_json(df: DataFrame) -> DataFrame:
    """Events as outgoing JSON, with the level of their score."""
    return df.select(F.to_json(F.struct(*df.columns, T.congestion_level(F.col("congestion_score")).alias("congestion_level")), JSON).alias("value"))

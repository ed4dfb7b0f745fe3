"""Stateful rules on streams, by keyed state. They need the RocksDB state store."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

MINUTE_MS = 60_000


def _sorted(rows: Iterator[pd.DataFrame], ts: str) -> pd.DataFrame:
    frames = list(rows)  # one key's rows of one micro-batch
    return pd.concat(frames).sort_values(ts, kind="stable") if frames else pd.DataFrame()


def _micros(values: pd.Series) -> list[int]:
    return values.astype("datetime64[us]").astype("int64").tolist()


class Residential(StatefulProcessor):
    """Keeps a device's tower and its first time there; the state lives 15 minutes of processing time after the last row."""

    def __init__(self, tower: str, ts: str, after_ms: int):
        self._tower, self._ts, self._after = tower, ts, after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._stay = handle.getValueState("stay", T.StructType([T.StructField("tower", T.StringType()), T.StructField("since", T.LongType())]), self._after)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, self._ts)
        stay = self._stay.get() if self._stay.exists() else None
        out = []
        for tower, t in zip(pdf[self._tower].tolist(), _micros(pdf[self._ts])):
            if stay is None or stay[0] != tower:
                stay = (tower, t)
            out.append(t - stay[1] >= self._after * 1000)
        self._stay.update(stay)
        yield pdf.assign(residential=out)

    def close(self) -> None:
        pass


class FirstWithin(StatefulProcessor):
    """Lets a key's first row through and drops the others until its time to live is over; it is not refreshed."""

    def __init__(self, ts: str, ttl_ms: int):
        self._ts, self._ttl = ts, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._last = handle.getValueState("last", T.StructType([T.StructField("t", T.LongType())]), self._ttl)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, self._ts)
        last = self._last.get()[0] if self._last.exists() else None
        keep = []
        for t in _micros(pdf[self._ts]):
            keep.append(last is None or t - last >= self._ttl * 1000)
            if keep[-1]:
                last = t
                self._last.update((t,))
        yield pdf[keep]

    def close(self) -> None:
        pass


class RateLimit(StatefulProcessor):
    """Accepts a row if fewer than n accepted rows of its key came in the window before it."""

    def __init__(self, ts: str, n: int, window_ms: int):
        self._ts, self._n, self._window = ts, n, window_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._taken = handle.getListState("taken", T.StructType([T.StructField("t", T.LongType())]))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, self._ts)
        taken = [x[0] for x in self._taken.get()] if self._taken.exists() else []
        out = []
        for t in _micros(pdf[self._ts]):
            taken = [x for x in taken if t - x < self._window * 1000]
            out.append(len(taken) < self._n)
            if out[-1]:
                taken.append(t)
        self._taken.put([(t,) for t in taken])
        yield pdf.assign(accepted=out)

    def close(self) -> None:
        pass


def _with(df: DataFrame, name: str) -> T.StructType:
    return T.StructType([*[f for f in df.schema if f.name != name], T.StructField(name, T.BooleanType())])


def _run(df: DataFrame, key: str, processor: StatefulProcessor, schema: T.StructType) -> DataFrame:
    return df.groupBy(key).transformWithStateInPandas(statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="ProcessingTime")


def flag_residential_stream(df: DataFrame, device: str = "device_id_hash", tower: str = "tower_id", ts: str = "timestamp", after_min: int = 15) -> DataFrame:
    return _run(df, device, Residential(tower, ts, after_min * MINUTE_MS), _with(df, "residential"))


def dedup_ttl_stream(df: DataFrame, key: str = "id", ts: str = "reported_at", ttl_min: int = 30) -> DataFrame:
    return _run(df, key, FirstWithin(ts, ttl_min * MINUTE_MS), df.schema)


def rate_limit_stream(df: DataFrame, key: str, ts: str, n: int = 100, window_s: int = 60) -> DataFrame:
    return _run(df, key, RateLimit(ts, n, window_s * 1000), _with(df, "accepted"))

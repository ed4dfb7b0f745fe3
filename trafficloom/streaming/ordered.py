"""Keyed rules over streams in the order of event time: rows wait in state until the watermark has passed their bucket of time.

A key's rows are kept as they come, in chunks by bucket; a timer at the end of the bucket sorts its rows, runs the rule over
them and hands them on. So the result does not depend on how rows fall into micro-batches, as long as they come within the
watermark's delay, and memory is one bucket of one key. Every access to state is a message to the JVM, so where keys are many
and have few rows each, they can be dealt to `shards` groups, whose rows are kept and judged together: memory is then one
bucket of one group. They need the RocksDB state store.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: (text, times in microseconds): all that a rule knows of the rows before.
Carry = tuple[str | None, list[int]] | None


class Residential:
    """Flags rows of a device that has been at their tower for `after_us` or longer. What it knows does not expire, unless silence of `idle_us` is given."""

    def __init__(self, tower: str, after_us: int, idle_us: int | None = None):
        self.column, self._after, self._idle = tower, after_us, idle_us

    def run(self, carry: Carry, towers: list[str | None], times: list[int]) -> tuple[list[bool], Carry, int | None]:
        tower, since = (carry[0], carry[1][0]) if carry else (None, None)
        out = []
        for now, t in zip(towers, times):
            if since is None or now != tower:
                tower, since = now, t
            out.append(t - since >= self._after)
        return out, (tower, [since]), None if self._idle is None else times[-1] + self._idle


class FirstWithin:
    """Flags the first row of a key and each that comes `ttl_us` or more after the last one flagged; after that time the key is forgotten."""

    column = None

    def __init__(self, ttl_us: int):
        self._ttl = ttl_us

    def run(self, carry: Carry, _: list, times: list[int]) -> tuple[list[bool], Carry, int | None]:
        last, out = carry[1][0] if carry else None, []
        for t in times:
            out.append(last is None or t - last >= self._ttl)
            last = t if out[-1] else last
        return out, (None, [last]), last + self._ttl


class RateLimit:
    """Flags a row if fewer than n flagged rows of its key came in the `window_us` before it; a window after the last one the key is forgotten."""

    column = None

    def __init__(self, n: int, window_us: int):
        self._n, self._window = n, window_us

    def run(self, carry: Carry, _: list, times: list[int]) -> tuple[list[bool], Carry, int | None]:
        taken, out = deque(carry[1] if carry else []), []
        for t in times:
            while taken and t - taken[0] >= self._window:
                taken.popleft()
            out.append(len(taken) < self._n)
            if out[-1]:
                taken.append(t)
        return out, (None, list(taken)), (taken[-1] if taken else times[-1]) + self._window


#: Columns of the rows of a group that are not handed on (frames of state do not know names that begin with an underscore).
_OWN = ("state_shard", "state_key")
_CARRIES = pa.schema([("key", pa.string()), ("text", pa.string()), ("times", pa.list_(pa.int64())), ("until", pa.int64())])


def _field(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind)


class Ordered(StatefulProcessor):
    """Buffers rows by bucket, and runs a rule over each key of a bucket when its timer fires.

    A key of the state is one key of the rule, or (`key` names its column as text) a group of them.
    """

    def __init__(self, rule: Any, ts: str, order: list[str], flag: str, bucket_ms: int, key: str | None = None):
        self._rule, self._ts, self._order, self._flag, self._bucket, self._key = rule, ts, order, flag, bucket_ms, key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        bucket = T.StructType([_field("bucket", T.LongType())])
        self._chunks = handle.getMapState("chunks", bucket, T.StructType([_field("n", T.IntegerType())]))
        self._rows = handle.getMapState("rows", T.StructType([*bucket, _field("chunk", T.IntegerType())]), T.StructType([_field("arrow", T.BinaryType())]))
        self._carry = handle.getValueState("carry", T.StructType([_field("arrow", T.BinaryType())]))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        closed = timerValues.getCurrentWatermarkInMs()
        for frame in rows:  # one chunk of the key's rows
            for bucket, part in frame.groupby(_micros(frame[self._ts]) // (self._bucket * 1000), sort=False):
                end = (int(bucket) + 1) * self._bucket
                if end <= closed:
                    continue  # later than the watermark allows
                n = self._chunks.getValue((int(bucket),))[0] if self._chunks.containsKey((int(bucket),)) else 0
                self._rows.updateValue((int(bucket), n), (_packed(pa.Table.from_pandas(part, preserve_index=False)),))
                self._chunks.updateValue((int(bucket),), (n + 1,))
                if not n:
                    self._handle.registerTimer(end)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        at, first_open = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() // self._bucket
        if at % self._bucket == 0 and not self._chunks.containsKey((at // self._bucket - 1,)):
            return  # judged with an earlier bucket
        carries = self._carries()
        for bucket in sorted(b for (b,) in self._chunks.keys() if b < first_open):
            n = self._chunks.getValue((bucket,))[0]
            rows = pd.concat([_unpacked(self._rows.getValue((bucket, k))[0]).to_pandas() for k in range(n)])
            for k in range(n):
                self._rows.removeKey((bucket, k))
            self._chunks.removeKey((bucket,))
            yield self._judged(rows, carries, bucket * self._bucket * 1000)
        self._keep(carries, first_open * self._bucket * 1000)

    def _judged(self, rows: pd.DataFrame, carries: dict[str, tuple], begin: int) -> pd.DataFrame:
        """`rows` of a bucket that starts at `begin` with the flag; `carries` moves on."""
        rows = rows.sort_values([*([self._key] if self._key else []), self._ts, *self._order], kind="stable")
        times = _micros(rows[self._ts]).tolist()
        texts = rows[self._rule.column].tolist() if self._rule.column else []
        keys = rows[self._key].tolist() if self._key else [""] * len(times)
        flags, low = [], 0
        while low < len(keys):
            high = low + 1
            while high < len(keys) and keys[high] == keys[low]:
                high += 1
            carry = carries.get(keys[low])
            if carry is not None and carry[2] is not None and carry[2] <= begin:
                carry = None  # the rows of this bucket come after it has expired
            some, left, until = self._rule.run(carry[:2] if carry else None, texts[low:high], times[low:high])
            flags += some
            carries[keys[low]] = (*left, until)
            low = high
        return rows.drop(columns=[c for c in _OWN if c in rows.columns]).assign(**{self._flag: flags})

    def _carries(self) -> dict[str, tuple]:
        if not self._carry.exists():
            return {}
        columns = _unpacked(self._carry.get()[0]).to_pydict()
        return dict(zip(columns["key"], zip(columns["text"], columns["times"], columns["until"])))

    def _keep(self, carries: dict[str, tuple], begin: int) -> None:
        """Keeps what can still matter to a bucket that starts at `begin` or later."""
        left = {k: c for k, c in carries.items() if c[2] is None or c[2] > begin}
        if not left:
            self._carry.clear()
            return
        columns = [list(left), *map(list, zip(*left.values()))]
        self._carry.update((_packed(pa.table(columns, _CARRIES)),))
        ends = [c[2] for c in left.values() if c[2] is not None]
        if ends:  # beside the times of buckets
            self._handle.registerTimer(-(-max(ends) // (self._bucket * 1000)) * self._bucket + 1)

    def close(self) -> None:
        pass


def _micros(values: pd.Series):
    return values.astype("datetime64[us]").astype("int64")


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def ordered(df: DataFrame, key: str, ts: str, rule: Any, flag: str, bucket_s: int, delay: str, order: list[str] | None = None, shards: int | None = None) -> DataFrame:
    """`df` with the rule's flag, each row once the watermark (`delay` behind the latest time) has passed its bucket of `bucket_s` seconds.

    Rows of equal time go by the columns `order`. Rows without a key or a time go, as do rows that come later than the delay.
    With `shards`, state is kept for so many groups of keys in place of each key; the result is the same.
    """
    schema = T.StructType([*[f for f in df.schema if f.name != flag], T.StructField(flag, T.BooleanType())])
    rows = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).withWatermark(ts, delay)
    if shards:
        rows = rows.withColumns({"state_shard": F.pmod(F.xxhash64(key), F.lit(shards)).cast("int"), "state_key": F.col(key).cast("string")})
    processor = Ordered(rule, ts, order or [], flag, bucket_s * 1000, "state_key" if shards else None)
    return rows.groupBy("state_shard" if shards else key).transformWithStateInPandas(statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="EventTime")


def flag_residential_ordered(df: DataFrame, device: str = "device_id_hash", tower: str = "tower_id", ts: str = "timestamp", after_min: int = 15, idle_min: int | None = None, bucket_s: int = 300, delay: str = "5 minutes", order: list[str] | None = None, shards: int | None = None) -> DataFrame:
    rule = Residential(tower, after_min * 60_000_000, None if idle_min is None else idle_min * 60_000_000)
    return ordered(df, device, ts, rule, "residential", bucket_s, delay, order, shards)


def dedup_ttl_ordered(df: DataFrame, key: str = "id", ts: str = "reported_at", ttl_min: int = 30, bucket_s: int = 300, delay: str = "5 minutes", order: list[str] | None = None, shards: int | None = None) -> DataFrame:
    return ordered(df, key, ts, FirstWithin(ttl_min * 60_000_000), "_first", bucket_s, delay, order, shards).where("_first").drop("_first")


def rate_limit_ordered(df: DataFrame, key: str, ts: str, n: int = 100, window_s: int = 60, bucket_s: int = 60, delay: str = "1 minute", order: list[str] | None = None, shards: int | None = None) -> DataFrame:
    return ordered(df, key, ts, RateLimit(n, window_s * 1_000_000), "accepted", bucket_s, delay, order, shards)

"""Helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one vectorised step handles; a longer single document is one step.
CHUNK_BYTES = 1 << 20


_own: dict[int, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir. Where none is named, a temporary one in local mode; a cluster has none that all share."""
    named = spark.conf.get("spark.checkpoint.dir", None) or _own.get(0)
    if not named:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = _own[0] = tempfile.mkdtemp(prefix="spark-")
    return named


def materialize(df: DataFrame) -> DataFrame:
    """Writes df as Parquet in the shared scratch folder and rereads it: lineage is cut and every executor sees the rows."""
    path = f"{scratch_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that materialize wrote, once what was made from them is itself written."""
    for df in tables:
        path = getattr(df, "_written_at", None) if "_written_at" in df.__dict__ else None
        if path:
            jvm = df.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Splits Arrow batches into runs of rows of about `limit` text bytes: (rows, UTF-8 bytes, offsets). A null text is empty."""
    for batch in batches:
        col = pc.fill_null(batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()), "")
        sizes = np.concatenate(([0], np.cumsum(pc.binary_length(col).to_numpy(zero_copy_only=False), dtype=np.int64)))
        at = 0
        while at < len(col):
            to = max(at + 1, int(np.searchsorted(sizes, sizes[at] + limit, "right")) - 1)
            part = col.slice(at, to - at)
            offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
            body = part.buffers()[2]
            data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.empty(0, np.uint8)
            yield batch.slice(at, to - at), data, offsets - offsets[0]
            at = to


# --- vectorised words and hashes -------------------------------------------------------------------------------------

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

#: The prime of the span hashes and the bases of their two independent lanes.
PRIME = (1 << 61) - 1
_BASES = (0x1E3779B97F4A7C15, 0x02B2AE3D27D4EB4F)
_P, _LOW31, _LOW30 = np.uint64(PRIME), np.uint64((1 << 31) - 1), np.uint64((1 << 30) - 1)
_powers: dict[int, np.ndarray] = {}


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo the prime."""
    x = (x & _P) + (x >> np.uint64(61))
    return np.minimum(x, x - _P)  # below the prime, x - p wraps to more


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo the prime, both below it: products of halves of 31 and 30 bits, as 2^61 is 1."""
    a1, a0, b1, b0 = a >> np.uint64(31), a & _LOW31, b >> np.uint64(31), b & _LOW31
    middle = a0 * b1 + a1 * b0
    return _reduced((a1 * b1 << np.uint64(1)) + (middle >> np.uint64(30)) + ((middle & _LOW30) << np.uint64(31)) + a0 * b0)


def _power_table(base: int, n: int) -> np.ndarray:
    """Powers of a base modulo the prime, at least n of them."""
    have = _powers.get(base)
    if have is None:
        have = np.ones(1, np.uint64)
    while len(have) < n:
        have = np.concatenate((have, _times(have, np.uint64(pow(base, len(have), PRIME)))))
    _powers[base] = have
    return have


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Values that one step of the sums takes: their temporary arrays stay in the processor's cache, and sums of products of 9 and 31 bits fit 64.
_RUN = 1 << 13


def prefix_hash(data: np.ndarray, lane: int = 0) -> np.ndarray:
    """Prefix sums of byte times power of the lane's base, modulo the prime, from which span_hash gets the hash of any span."""
    power = _power_table(_BASES[lane], len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    for at in range(0, len(data), _RUN):
        value = data[at : at + _RUN].astype(np.uint64) + np.uint64(1)
        p = power[at : at + len(value)]
        high, low = np.cumsum(value * (p >> np.uint64(31))), np.cumsum(value * (p & _LOW31))
        # high times 2^31 is high turned by 31 of 61 bits
        total = ((high & _LOW30) << np.uint64(31)) + (high >> np.uint64(30)) + (low & _P) + (low >> np.uint64(61)) + out[at]
        out[at + 1 : at + 1 + len(value)] = _reduced(total)
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
    """64-bit hashes of the spans [start, end): equal contents have equal hashes wherever they stand.

    A polynomial modulo 2^61 - 1: two different spans of n bytes are equal at no more than n of all bases.
    """
    inverse = _power_table(pow(_BASES[lane], -1, PRIME), len(prefix))
    out = np.empty(len(start), np.uint64)
    for at in range(0, len(start), _RUN):
        a, b = start[at : at + _RUN], end[at : at + _RUN]
        out[at : at + len(a)] = mix64(_times(_reduced(prefix[b] + _P - prefix[a]), inverse[a]) ^ ((b - a).astype(np.uint64) << np.uint64(40)))
    return out


def distinct_spans(data: np.ndarray, at: np.ndarray, to: np.ndarray, salt: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(one span of each content, which of them each span equals), by hash, and then by the bytes themselves.

    at, to: spans that follow each other without gaps over all of `data`. salt: spans of unlike salt are unlike.
    """
    key = span_hash(prefix_hash(data), at, to)
    if salt is not None:
        key = mix64(key + salt)
    _, sample, which = np.unique(key, return_index=True, return_inverse=True)
    size, twin = to - at, sample[which]
    same = np.array_equal(size[twin], size)
    if same:
        same = np.array_equal(data[np.arange(len(data)) + np.repeat(at[twin] - at, size)], data)
    if not same:  # two contents under one hash: tell them apart by their bytes
        raw, seen = data.tobytes(), {}
        keys = zip(at.tolist(), to.tolist(), [0] * len(at) if salt is None else salt.tolist())
        which = np.array([seen.setdefault((raw[a:b], s), len(seen)) for a, b, s in keys], np.int64)
        _, sample = np.unique(which, return_index=True)
    return sample, which


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document index of every maximal run without white space."""
    n = len(data)
    if not n:
        return (np.empty(0, np.int64),) * 3
    solid = ~WHITE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    edge[0] = edge[n] = True
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:n]
    last[:-1] &= ~solid[1:] | edge[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def fold_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; other bytes stay."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data).astype(np.uint8)


def shingle_hashes(words: np.ndarray, doc: np.ndarray, n_docs: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words and their documents; a document with fewer words (but any) has one, of all its words."""
    n = len(words)
    per_doc = np.bincount(doc, minlength=n_docs)
    first = np.concatenate(([0], np.cumsum(per_doc)))[:-1]
    reach = np.minimum(per_doc, width)
    acc = np.zeros(n, np.uint64)
    span = reach[doc]
    for k in range(width):
        use = np.arange(n) + k
        inside = (use < n) & (k < span)
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + np.where(inside, words[np.minimum(use, n - 1)] if n else words, np.uint64(0))
    whole = np.arange(n) - first[doc] <= per_doc[doc] - span
    return mix64(acc + span.astype(np.uint64))[whole], doc[whole]

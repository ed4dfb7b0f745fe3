"""Document fingerprints: bottom-k sketches of word-shingle hashes."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import CHUNK_BYTES, chunks, documents, fold_ascii, prefix_hash, shingle_hashes, span_hash, word_spans

SHINGLE_WORDS = 5
K = 128
#: Documents of one range of ids, about, at most.
RANGE_ROWS = 100_000


def sketches(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE_WORDS, k: int = K) -> list[np.ndarray]:
    """Per document the k smallest distinct shingle hashes, ascending. Words are folded to lower case (A-Z)."""
    n_docs = len(offsets) - 1
    start, end, doc = word_spans(data, offsets)
    words = span_hash(prefix_hash(fold_ascii(data)), start, end)
    h, at = shingle_hashes(words, doc, n_docs, width)
    cut = np.searchsorted(at, np.arange(n_docs + 1))
    out = []
    for d in range(n_docs):
        own = h[cut[d] : cut[d + 1]]
        if len(own) > 4 * k:  # a first cut that leaves the smallest; widened if repeats leave too few
            low = np.unique(np.partition(own, 2 * k)[: 2 * k])
            out.append(low[:k] if len(low) >= k else np.unique(own)[:k])
        else:
            out.append(np.unique(own)[:k])
    return out


def encode(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype(">u8").tobytes()).decode()


def decode(text: str | None) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text or ""), ">u8").astype(np.uint64)


def merge(parts: Iterable[np.ndarray], k: int = K) -> np.ndarray:
    """The sketch of the union of the sets whose sketches are given."""
    parts = list(parts)
    return np.unique(np.concatenate(parts))[:k] if parts else np.empty(0, np.uint64)


def distinct_count(sketch: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below k."""
    return float(len(sketch)) if len(sketch) < k else (k - 1) / ((float(sketch[k - 1]) + 1) / 2.0**64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard likeness: the share of the union's k smallest that both have. Two empty sets: 1; one empty: 0."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    low = np.unique(np.concatenate((a, b)))[:k]
    return float(np.intersect1d(np.intersect1d(a, b, True), low, True).size / low.size)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has. An empty a is contained in anything."""
    if not len(a):
        return 1.0
    union = distinct_count(merge((a, b), k), k)
    return min(1.0, resemblance(a, b, k) * union / distinct_count(a, k))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id_col, fingerprint, n_shingles): one sketch per row; n_shingles is the estimated number of distinct shingles.

    The shingles are runs of five words; a shorter document has one shingle, of all its words; null, empty or blank
    text has none and the fingerprint "". Equal texts have equal fingerprints.
    """

    def run(batches):
        for rows, data, offsets in chunks(batches, text):
            own = sketches(data, offsets)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([encode(s) for s in own]), pa.array([distinct_count(s) for s in own])], names=[id_col, "fingerprint", "n_shingles"])

    return docs.select(id_col, text).mapInArrow(run, f"{id_col} {docs.schema[id_col].dataType.simpleString()}, fingerprint string, n_shingles double")


def merge_fingerprints(prints: DataFrame, key: str, fingerprint: str = "fingerprint") -> DataFrame:
    """(key, fingerprint, n_shingles): the sketch of the union of each key's documents.

    Each task first merges what it has of a key, so a hot key sends one sketch a task; null keys form a group.
    """
    kind = prints.schema[key].dataType.simpleString()

    def partial(batches):
        have: dict = {}
        for b in batches:
            for k, f in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                have[k] = merge((have[k], decode(f))) if k in have else decode(f)
            if len(have) > 10_000:
                yield _rows(have)
                have = {}
        yield _rows(have)

    def _rows(have):
        return pa.RecordBatch.from_arrays([pa.array(list(have), b_type), pa.array([encode(v) for v in have.values()], pa.string())], names=[key, "fingerprint"])

    from pyspark.sql.pandas.types import to_arrow_type

    b_type = to_arrow_type(prints.schema[key].dataType)

    def final(pdf):
        sketch = merge(decode(x) for x in pdf["fingerprint"])
        return pdf.head(1)[[key]].assign(fingerprint=encode(sketch), n_shingles=distinct_count(sketch))

    parts = prints.select(key, F.col(fingerprint).alias("fingerprint")).mapInArrow(partial, f"{key} {kind}, fingerprint string")
    return parts.groupBy(key).applyInPandas(final, f"{key} {kind}, fingerprint string, n_shingles double")


def beside_next(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (part, guest, i, t) dealt by ranges of the id; each range also gets, as guests, the first rows of the range after it.

    The text is shuffled once. A null id is taken as the smallest. Range bounds are found from the ids alone; what reaches
    the driver is one id per range, and there are four ranges per shuffle partition of the session, or one for each
    RANGE_ROWS documents if those are more.
    """
    spark = docs.sparkSession
    known = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    parts = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // RANGE_ROWS))
    ids = docs.select(known.alias("i"))
    ends = ids.repartitionByRange(parts, "i").groupBy(F.spark_partition_id()).agg(F.min("i").alias("low"))
    lows = np.array(sorted(r.low for r in ends.select("low").collect()), np.int64)

    @F.pandas_udf("array<int>")
    def homes(i: pd.Series) -> pd.Series:
        v = i.to_numpy(np.int64)
        at = np.searchsorted(lows, v, "right") - 1
        return pd.Series([[p, (p - 1) % len(lows)] if first else [p] for p, first in zip(at.tolist(), (lows[at] == v).tolist())])

    dealt = docs.select(known.alias("i"), F.col(text).alias("t")).select(F.posexplode(homes("i")).alias("guest", "part"), "i", "t")
    return dealt.select("part", "guest", "i", "t").repartition(parts, "part").sortWithinPartitions("part", "guest", "i", "t")


def _pairs(batches) -> Iterator[list[tuple]]:
    """Runs of (id, text, next text) of about CHUNK_BYTES characters; in a run, each next text is the following row's text, up to the last."""
    run: list[tuple] = []
    size, last, closed = 0, None, None
    for b in batches:
        for part, guest, i, t in zip(*(c.to_pylist() for c in b.columns)):
            t = t or ""
            if guest and closed == part:
                continue  # rows that share the first id of the next range
            if last is not None and last[0] == part:
                run.append((last[1], last[2], t))
                size += len(t)
                if size > CHUNK_BYTES:
                    yield run
                    run, size = [], 0
            elif run:
                yield run
                run, size = [], 0
            last = (part, i, t)
            if guest:
                closed, last = part, None
    if run:
        yield run


def with_next(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its fingerprint, that of its edited text, and their likeness to each other and to the next row's.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many of the next document in
    ascending id (after the last, the first; a lone document is its own next). Ids are integers. Rows with one id are put
    in order by their text and stand in one range; a null id is the smallest; a null text is empty.
    """

    def run(batches):
        for rows in _pairs(batches):
            texts = [r[1] for r in rows]
            edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for _, t, n in rows]
            every = [s for _, d, o in chunks(iter([pa.RecordBatch.from_arrays([pa.array([*texts, rows[-1][2], *edited], pa.large_string())], names=["t"])]), "t") for s in sketches(d, o)]
            own, after, other = every[: len(rows)], every[1 : len(rows) + 1], every[len(rows) + 1 :]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([None if r[0] == -(1 << 63) else r[0] for r in rows], pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                    pa.array([encode(s) for s in own]),
                    pa.array([encode(s) for s in other]),
                    pa.array([resemblance(a, b) for a, b in zip(own, other)]),
                    pa.array([resemblance(a, b) for a, b in zip(own, after)]),
                ],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    return beside_next(docs, id_col, text).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_next(documents(spark, sf_dir))

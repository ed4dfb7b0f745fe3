"""Line dedup by winnowing: runs of lines that stand earlier in the corpus are deleted."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, discard, documents, materialize, word_spans

#: A run is deletable with this many lines, or with this many words. Any such shared run holds a window that is one too.
MIN_LINES = 3
MIN_WORDS = 40

_POSITION_ROWS = "fp long, i int, near array<struct<o int, n int, a long, b long>>"


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, end, document, number in the document and words of every line that has a word."""
    n_docs = len(offsets) - 1
    start, _, _ = word_spans(data, offsets)
    feeds = np.flatnonzero(data == 10)
    at = np.concatenate((offsets[:-1], feeds + 1))
    doc = np.concatenate((np.arange(n_docs), np.searchsorted(offsets, feeds, "right") - 1))
    order = np.lexsort((at, doc))
    at, doc = at[order], doc[order]
    to = np.append(at[1:] - 1, len(data))
    last = np.append(doc[1:] != doc[:-1], True)
    to[last] = offsets[doc[last] + 1]
    number = np.arange(len(at)) - np.searchsorted(doc, doc)
    words = np.searchsorted(start, to) - np.searchsorted(start, at)
    keep = words > 0
    return at[keep], to[keep], doc[keep], number[keep], words[keep]


def _hashes(raw: memoryview, at: list[int], to: list[int]) -> tuple[bytes, np.ndarray]:
    """128-bit hashes of spans, one after the other, and as two columns."""
    out = b"".join(xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(at, to))
    return out, np.frombuffer(out, np.int64).reshape(-1, 2)


def _positions(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Winnowed lines: (document, line, fingerprint, first window of each and the end), and of the windows (first line less the line, lines, hashes).

    Lines are counted among those with words. The least deletable windows, from each line forth and to each line back,
    slide over the line hashes; the last line of the least hash in a window is its fingerprint, and one line that is
    the fingerprint of several windows is one position. Equal windows have their fingerprint at the same place.
    """
    at, to, doc, _, words = _lines(data, offsets)
    n = len(at)
    empty = np.empty(0, np.int64)
    if not n:
        return empty, empty, empty, np.zeros(1, np.int64), empty, empty, np.empty((0, 2), np.int64)
    digests, line = _hashes(memoryview(data), at.tolist(), to.tolist())
    low = line[:, 0]
    sums = np.concatenate(([0], np.cumsum(words)))
    k = np.arange(n)
    forth = np.minimum(np.searchsorted(sums, sums[:-1] + MIN_WORDS) - k, MIN_LINES)
    back = np.minimum(k + 1 - (np.searchsorted(sums, sums[1:] - MIN_WORDS, "right") - 1), MIN_LINES)
    first, size = np.concatenate((k, k + 1 - back)), np.concatenate((forth, back))
    whole = (first >= 0) & (first + size <= n)
    first, size = first[whole], size[whole]
    whole = doc[first] == doc[first + size - 1]
    first, size = np.unique(np.stack((first[whole], size[whole])), axis=1) if whole.any() else (empty, empty)
    least = first.copy()
    for step in range(1, MIN_LINES):
        other = np.minimum(first + step, n - 1)
        least = np.where((size > step) & (low[other] <= low[least]), other, least)
    order = np.lexsort((size, first, least))
    first, size, least = first[order], size[order], least[order]
    _, hashes = _hashes(memoryview(digests), (first * 16).tolist(), ((first + size) * 16).tolist())
    chosen, begin = np.unique(least, return_index=True)
    return doc[chosen], chosen - np.searchsorted(doc, doc[chosen]), low[chosen], np.append(begin, len(first)), first - least, size, hashes


def _keyed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """A document is its id and its text: rows equal in both are one document."""
    return docs.withColumn("_id", F.col(id_col)).withColumn("_th", F.xxhash64(F.coalesce(F.col(text), F.lit(""))))


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(_id, _th, runs): for each document with repeated runs, array<struct<i, n>> of windows that stand earlier in the corpus.

    Earlier is by id (null first), text hash and line. A position whose fingerprint stands once is dropped. Those left are
    joined, by the windows around them, to the earliest place of the same window: a position may stand in several
    surroundings, and each finds its own partner. Windows reach from a line forth and back, so those joined around a
    position are the match extended both ways. Both comparisons are minima and counts that are summed before the
    shuffle and joined back, so a line that a third of all documents have is no hot group.
    """
    kind = docs.schema[id_col].dataType

    def run(batches):
        for rows, data, offsets in chunks(batches, "_t"):
            doc, i, fp, begin, o, n, hashes = _positions(data, offsets)
            take = pa.array(doc, pa.int64())
            windows = pa.StructArray.from_arrays([pa.array(o, pa.int32()), pa.array(n, pa.int32()), pa.array(hashes[:, 0]), pa.array(hashes[:, 1])], names=["o", "n", "a", "b"])
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(take), rows.column(1).take(take), pa.array(fp), pa.array(i, pa.int32()), pa.ListArray.from_arrays(pa.array(begin, pa.int32()), windows)],
                names=["_id", "_th", "fp", "i", "near"],
            )

    keyed = _keyed(docs.select(id_col, F.col(text).alias("_t")), id_col, "_t").select("_id", "_th", "_t")
    every = materialize(keyed.mapInArrow(run, f"_id {kind.simpleString()}, _th long, {_POSITION_ROWS}"))
    often = materialize(every.groupBy("fp").agg(F.count("*").alias("c")).where("c > 1").select("fp"))
    found = materialize(every.join(often, "fp", "left_semi").select("_id", "_th", "i", F.inline("near")).select("_id", "_th", (F.col("i") + F.col("o")).alias("i"), "n", "a", "b"))
    discard(every, often)
    where = F.struct("_id", "_th", "i")
    first = materialize(found.groupBy("a", "b").agg(F.min(where).alias("first"), F.max(where).alias("last")).where("not (first <=> last)").select("a", "b", "first"))
    later = found.join(first, ["a", "b"]).where(~where.eqNullSafe(F.col("first")))
    runs = materialize(later.groupBy("_id", "_th").agg(F.collect_set(F.struct("i", "n")).alias("runs")))
    discard(found, first)
    return runs


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with `text` less its repeated runs of lines, and the columns n_lines and n_removed (replacing columns of these names).

    A run of lines with words (MIN_LINES of them, or MIN_WORDS words) that stands earlier in the corpus is deleted; every
    line stays where it stands first. Lines without words neither count nor go. Null texts stay null; rows equal in id
    and text are one document and are treated alike. An empty table gives no rows.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    runs = repeated_windows(docs, id_col, text).withColumnsRenamed({"_id": "_rid", "_th": "_rth"})
    rows = _keyed(docs.select(*kept), id_col, text)
    # always a sort-merge join, at every size: what is repeated grows with the corpus
    both = rows.join(runs.hint("merge"), rows._id.eqNullSafe(runs._rid) & (rows._th == runs._rth), "left").select(*[rows[c] for c in kept], "runs")
    at = kept.index(text)

    def run(batches):
        for rows, data, offsets in chunks(batches, text):
            start, _, doc, number, _ = _lines(data, offsets)
            cut = np.searchsorted(doc, np.arange(len(offsets)))
            gone = np.zeros(len(start), bool)
            column = rows.column(len(kept))
            for d, spans in zip(np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False)).tolist(), column.drop_null().to_pylist()):
                for s in spans:
                    gone[cut[d] + s["i"] : cut[d] + s["i"] + s["n"]] = True
            removed = np.bincount(doc[gone], minlength=len(offsets) - 1)
            raw = data.tobytes()
            valid = rows.column(at).is_valid().to_pylist()
            texts = []
            for d, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                if not removed[d]:
                    texts.append(raw[a:b].decode() if valid[d] else None)
                    continue
                drop = set(number[cut[d] : cut[d + 1]][gone[cut[d] : cut[d + 1]]].tolist())
                texts.append(b"\n".join(x for k, x in enumerate(raw[a:b].split(b"\n")) if k not in drop).decode())
            cols = [rows.column(k) if k != at else pa.array(texts, pa.string()) for k in range(len(kept))]
            lines = np.bincount(doc, minlength=len(offsets) - 1)
            yield pa.RecordBatch.from_arrays([*cols, pa.array(lines), pa.array(removed)], names=[*kept, "n_lines", "n_removed"])

    schema = T.StructType([*[docs.schema[c] for c in kept], T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())])
    return both.mapInArrow(run, schema)


def op6_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed (lines) and the SHA-256 of the text that stays, for every document."""
    done = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE_SQL = rf"""
WITH raw AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL),
worded AS (SELECT doc_id, line, pos, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words FROM raw WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
lines AS (SELECT *, row_number() OVER w AS i, lead(words) OVER w AS w1, lag(words) OVER w AS v1, lead(line) OVER w AS l1, lead(line, 2) OVER w AS l2, lag(line) OVER w AS k1, lag(line, 2) OVER w AS k2 FROM worded WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
windows AS (
  SELECT doc_id, i, CASE WHEN words >= {MIN_WORDS} THEN 1 WHEN words + w1 >= {MIN_WORDS} THEN 2 WHEN l2 IS NOT NULL THEN {MIN_LINES} END AS n,
    CASE n WHEN 1 THEN [line] WHEN 2 THEN [line, l1] WHEN 3 THEN [line, l1, l2] END AS body FROM lines
  UNION
  SELECT doc_id, i - n + 1, n, CASE n WHEN 1 THEN [line] WHEN 2 THEN [k1, line] WHEN 3 THEN [k2, k1, line] END AS body FROM
    (SELECT *, CASE WHEN words >= {MIN_WORDS} THEN 1 WHEN words + v1 >= {MIN_WORDS} THEN 2 WHEN k2 IS NOT NULL THEN {MIN_LINES} END AS n FROM lines)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, i) AS r FROM windows WHERE n IS NOT NULL),
gone AS (SELECT DISTINCT l.doc_id, l.pos FROM ranked k JOIN lines l ON l.doc_id = k.doc_id AND l.i BETWEEN k.i AND k.i + k.n - 1 WHERE r > 1),
kept AS (SELECT raw.doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM raw ANTI JOIN gone ON raw.doc_id = gone.doc_id AND raw.pos = gone.pos GROUP BY raw.doc_id)
SELECT d.doc_id, coalesce((SELECT count(*) FROM lines l WHERE l.doc_id = d.doc_id), 0) AS n_lines, coalesce((SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id), 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

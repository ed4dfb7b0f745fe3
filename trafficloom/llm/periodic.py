"""Runs of words that repeat with a period, found in tiles of each octave of periods and stitched by document and period."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WHITE, chunks, distinct_spans, documents, mix64, word_spans

#: A run has at least so many periods and words.
PERIODS = 4
LEAST = 6
#: Pairs of a boundary and a period that a tile has, or the periods of one boundary where those are more.
TILE = 1 << 20
_WORD = r"[^\x20\x09-\x0D]+"


@lru_cache(1 << 16)
def _prime_factors(n: int) -> tuple[int, ...]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return (*out, n) if n > 1 else tuple(out)


class Names:
    """Names of the windows of 1, 2, 4, ... words of a stretch of texts: equal windows have equal names."""

    def __init__(self, words: np.ndarray, seed: int = 0):
        self._levels = [mix64(words.astype(np.uint64) + np.uint64(1 + (seed << 40)))]

    def level(self, k: int) -> np.ndarray:
        """Names of the windows of 2^k words, from both halves' names."""
        while len(self._levels) <= k:
            half, low = 1 << (len(self._levels) - 1), self._levels[-1]
            self._levels.append(mix64(low[:-half] * np.uint64(0x9E3779B97F4A7C15) + low[half:]) if len(low) > half else low[:0])
        return self._levels[k]

    def boundary_z(self, at: np.ndarray, shift: np.ndarray, limit: np.ndarray, back: bool = False) -> np.ndarray:
        """Z-values at boundaries: how many words from `at` on (back: before `at`) equal those `shift` words later, up to `limit`.

        Many boundaries and shifts are taken together, by windows that halve. So many words as `limit`, and their
        partners, lie within the text.
        """
        out = np.zeros(len(at), np.int64)
        for k in reversed(range(int(limit.max()).bit_length() if len(limit) else 0)):
            size, names = 1 << k, self.level(k)
            fits = np.flatnonzero(out + size <= limit)
            a = at[fits] - out[fits] - size if back else at[fits] + out[fits]
            out[fits[names[a] == names[a + shift[fits]]]] += size
        return out

    def primitive(self, at: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Whether the `period` words from each boundary on are no repetition of fewer words.

        If they are one, all that has this period around them has the smaller one too, and is found by that.
        """
        out = np.ones(len(at), bool)
        factors = [_prime_factors(q) for q in period.tolist()]
        for k in range(max(map(len, factors), default=0)):
            some = np.array([i for i, f in enumerate(factors) if len(f) > k], np.int64)
            small = period[some] // np.array([factors[i][k] for i in some.tolist()], np.int64)
            out[some] &= self.boundary_z(at[some], small, period[some] - small) < period[some] - small
        return out


def _tile(names: Names, c: np.ndarray, begin: np.ndarray, end: np.ndarray, p: int) -> np.ndarray:
    """Fragments (index of a boundary, period, from, to) of one tile, for the periods from p up to 2 p: word i equals word i + period for from <= i < to.

    c: the tile's boundaries, p words apart within a document that reaches from begin to end. A run of period q has 3 q
    or more such i, so at some boundary c of it the p words from c on equal those from c + q on; at its first such
    boundary it reaches back by less than p words, at its last one forth by less than 2 p. Such boundaries next to each
    other make one fragment. A fragment that reaches the tile's edge, where the next tile's fragment begins, is kept at
    any length; others only if they are long enough for a run.
    """
    window, parts = names.level(p.bit_length() - 1), []
    for low in range(p, 2 * p, TILE):
        q = np.arange(low, min(low + TILE, 2 * p))
        partner = c[:, None] + q[None, :]
        equal = window[np.minimum(partner, len(window) - 1)] == window[c][:, None]
        r, j = np.nonzero(equal & (partner + p <= end[:, None]))
        parts.append((r, q[j]))
    r, q = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((r, q))
    r, q = r[order], q[order]
    new = np.ones(len(r), bool)
    new[1:] = (q[1:] != q[:-1]) | (c[r[1:]] != c[r[:-1]] + p) | (begin[r[1:]] != begin[r[:-1]])
    head = np.flatnonzero(new)
    a, z, q = r[head], r[np.append(head[1:], len(r)) - 1] if len(r) else r, q[head]
    onward = c[z] + p
    back = names.boundary_z(c[a], q, np.minimum(p, c[a] - begin[a]), back=True)
    forth = names.boundary_z(onward, q, np.minimum(2 * p, end[z] - q - onward))
    start, stop = c[a] - back, onward + forth
    keep = np.flatnonzero((back == p) | (forth >= p) | (stop - start + q >= np.maximum(LEAST, PERIODS * q)))
    keep = keep[names.primitive(c[a[keep]], q[keep])]
    return np.stack([a[keep], q[keep], start[keep], stop[keep]], 1)


def fragments(words: np.ndarray, first: np.ndarray, count: np.ndarray, tile: int | None = None) -> np.ndarray:
    """Fragments (document, period, from, to) of all octaves of periods; places count within the document.

    words: those of all documents, document d's from first[d] on, count[d] of them. Each octave's boundaries are dealt to
    tiles, which overlap by the words that the boundaries at their edges see; a tile is solved from its words alone.
    Fragments are compared word for word; should names of unlike windows be equal, other names are taken.
    """
    tile, seed = tile or TILE, 0
    while True:
        out, octave, whole = [np.empty((0, 4), np.int64)], 0, Names(words, seed)
        while len(count) and PERIODS << octave <= count.max():
            p = 1 << octave
            docs = np.flatnonzero(count >= max(LEAST, PERIODS * p))
            many = (count[docs] - p) // p  # boundaries c for which c + 2 p is within the document
            ends = np.cumsum(many)
            total = int(ends[-1]) if len(docs) else 0
            for low in range(0, total, max(1, tile // p)):
                k = np.arange(low, min(low + max(1, tile // p), total))
                d = np.searchsorted(ends, k, "right")
                begin, own = first[docs[d]], count[docs[d]]
                c = begin + (k - (ends[d] - many[d])) * p
                if len(k) == total:
                    names, shift = whole, 0
                else:
                    shift = max(0, int(c[0]) - p)
                    names = Names(words[shift : int(c[-1]) + 5 * p], seed)
                # what lies beyond the tile's words is beyond the sight of its boundaries
                found = _tile(names, c - shift, np.maximum(begin - shift, 0), np.minimum(begin + own - shift, len(words) - shift), p)
                if len(found):
                    i = found[:, 0]
                    out.append(np.stack([docs[d[i]], found[:, 1], found[:, 2] + shift - begin[i], found[:, 3] + shift - begin[i]], 1))
            octave += 1
        found = np.concatenate(out)
        if all(np.array_equal(words[first[d] + a : first[d] + b], words[first[d] + a + q : first[d] + b + q]) for d, q, a, b in found.tolist()):
            return found
        seed += 1


_CUT = "_id {kind}, _text_hash binary, n_words long, _words string, _fragments array<struct<period: long, lo: long, hi: long>>"
_RUNS = "array<struct<start: long, length: long, period: long>>"


def _cut(docs: DataFrame, id_col: str, text: str, tile: int | None) -> DataFrame:
    """A row per row of `docs`: how many words, the words joined by one space, and their fragments."""
    import xxhash

    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for rows, data, offsets in chunks(batches, "_text"):
            at, to, doc = word_spans(data, offsets)
            n, size = len(offsets) - 1, to - at
            count = np.bincount(doc, minlength=n)
            first = np.cumsum(count) - count
            solid, ends = data[~WHITE[data]], np.cumsum(size)
            words = distinct_spans(solid, ends - size, ends)[1] if len(at) else np.empty(0, np.int64)
            found = fragments(words, first, count, tile)
            found = found[np.argsort(found[:, 0], kind="stable")]
            # a space before each word: a document's words from its second byte on
            spaced = np.full(len(solid) + len(at), 0x20, np.uint8)
            spaced[np.arange(len(solid)) + np.repeat(np.arange(1, len(at) + 1), size)] = solid
            edge = np.concatenate(([0], ends + np.arange(1, len(at) + 1)))
            raw = spaced.tobytes()
            texts = [raw[a + 1 : b] for a, b in zip(edge[first].tolist(), edge[first + count].tolist())]
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(found[:, 0], np.arange(n + 1)), pa.int32()), pa.StructArray.from_arrays([pa.array(found[:, k]) for k in (1, 2, 3)], ["period", "lo", "hi"]))
            hashes = pa.array([xxhash.xxh3_128_digest(x) for x in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([rows.column(0), hashes, pa.array(count), pa.array(texts, pa.binary()).cast(pa.string()), lists], names=["_id", "_text_hash", "n_words", "_words", "_fragments"])

    return docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")).mapInArrow(run, _CUT.format(kind=kind))


def _stitched(cut: DataFrame) -> DataFrame:
    """(_id, n_words, _words, runs) of documents with fragments, once for each row.

    Fragments are dealt by document and period; those that touch are one stretch, and long stretches are runs. Copies of a
    row within a partition are one document until the end; those of other partitions are apart, so that a text that
    stands in very many rows is no hot group. A document's words travel in a row of their own, with period 0.
    """
    key = ["_id", "_text_hash", "_part"]
    head = F.struct(F.lit(0).cast("long").alias("period"), F.lit(None).cast("long").alias("lo"), F.lit(None).cast("long").alias("hi"))
    rows = cut.withColumn("_part", F.spark_partition_id()).select(*key, "n_words", "_words", F.explode(F.concat(F.array(head), "_fragments")).alias("_f"))
    lead = F.col("_f.period") == 0
    dealt = rows.groupBy(*key, F.col("_f.period").alias("period")).agg(
        F.collect_set(F.when(~lead, F.struct("_f.lo", "_f.hi"))).alias("_pieces"), F.max(F.when(lead, F.col("_words"))).alias("_words"), F.max("n_words").alias("n_words"), F.sum(lead.cast("long")).alias("_copies")
    )
    w = Window.partitionBy(*key, "period").orderBy("lo", "hi")
    pieces = dealt.select(*key, "period", "n_words", "_words", "_copies", F.explode_outer("_pieces").alias("_f")).select("*", "_f.lo", "_f.hi").drop("_f")
    pieces = pieces.withColumn("_reached", F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    pieces = pieces.withColumn("_stretch", F.count_if(F.col("_reached").isNull() | (F.col("lo") > F.col("_reached"))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    whole = pieces.groupBy(*key, "period", "_stretch").agg(F.min("lo").alias("start"), (F.max("hi") - F.min("lo") + F.col("period")).alias("length"), F.max("_words").alias("_words"), F.max("n_words").alias("n_words"), F.max("_copies").alias("_copies"))
    is_run = (F.col("period") > 0) & (F.col("length") >= F.greatest(F.lit(LEAST), PERIODS * F.col("period")))
    docs = whole.groupBy(*key).agg(F.sort_array(F.collect_list(F.when(is_run, F.struct("start", "period", "length")))).alias("_r"), F.max("_words").alias("_words"), F.max("n_words").alias("n_words"), F.max("_copies").alias("_copies"))
    runs = F.transform("_r", lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period")))
    return docs.select("_id", "n_words", "_words", runs.alias("runs"), F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).drop("col")


def _collapsed(rows: DataFrame) -> DataFrame:
    """`rows` with collapsed: their words but for those that a run contains after its first period."""
    names = rows.columns

    def run(batches):
        for b in batches:
            out = []
            for text, runs in zip(b.column(names.index("_words")).to_pylist(), b.column(names.index("runs")).to_pylist()):
                if runs:
                    words = text.split(" ")
                    edge = np.zeros(len(words) + 1, np.int64)
                    at = np.array([(r["start"] + r["period"], r["start"] + r["length"]) for r in runs])
                    np.add.at(edge, at[:, 0], 1)
                    np.add.at(edge, at[:, 1], -1)
                    text = " ".join(words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist())
                out.append(text)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string())], names=[*names, "collapsed"])

    from pyspark.sql import types as T

    return rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField("collapsed", T.StringType())]))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", tile: int | None = None) -> DataFrame:
    """(id_col, n_words, runs, collapsed), one row per row of `docs`, from whole texts.

    runs: array of (start, length, period) in words from 0, by start and period: the stretches with a smallest period q,
    of 4 q words and of 6 at least, that neither neighbour extends. collapsed: the words joined by one space, but for
    those that a run contains after its first q words. Words are what stands between ASCII white space.

    Each document is cut into overlapping tiles for each octave of periods, solved apart by the Z-values at their
    boundaries; the fragments are shuffled by document and period and stitched where they touch. Documents without any
    fragment are not shuffled: they are read a second time, as moving all texts would cost more.
    tile: boundaries times periods of a tile (tests take small ones).
    Null, empty and blank texts have no words, no runs and an empty `collapsed`. Rows of a repeated or null id have their
    own results, repeated rows equal ones; other columns do not matter. An empty table gives an empty one.
    """
    cut = _cut(docs, id_col, text, tile)
    plain = cut.where(F.size("_fragments") == 0).select("_id", "n_words", F.array().cast(_RUNS).alias("runs"), F.col("_words").alias("collapsed"))
    met = _collapsed(_stitched(cut.where(F.size("_fragments") > 0)))
    return plain.unionByName(met.select("_id", "n_words", "runs", "collapsed")).withColumnRenamed("_id", id_col)


def best_run(runs: Column) -> Column:
    """The run of the greatest length over period, compared exactly; of equal ones the first by start, then period. Null without runs."""

    def better(best: Column, r: Column) -> Column:
        return F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start: long, length: long, period: long>"), better)


def planted(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with a periodic tail in about every tenth text: words from a on become the words from a on with period p, where a and p follow from the id."""
    h, n = F.crc32(F.col(id_col).cast("string").cast("binary")), F.size("_w")
    some = F.when(h % 10 == 0, F.regexp_extract_all(text, F.lit(f"({_WORD})"), 1))
    rows = docs.withColumn("_w", some).withColumn("_g", h).withColumn("_g", F.expr("_g div 10"))
    rows = rows.withColumn("_a", F.when(n > 0, F.expr("_g % size(_w)"))).withColumn("_p", F.when(n > 0, F.expr("1 + (size(_w) - _a) div (3 + _g % 8)")))
    words = F.transform("_w", lambda w, i: F.when(i < F.col("_a"), w).otherwise(F.element_at("_w", (F.col("_a") + (i - F.col("_a")) % F.col("_p") + 1).cast("int"))))
    return rows.withColumn(text, F.when(n > 0, F.array_join(words, " ")).otherwise(F.col(text))).drop("_w", "_g", "_a", "_p")


def op11_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic_runs(planted(documents(spark, sf_dir).select("doc_id", "text")))
    best = best_run(F.col("runs"))
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    rows = rows.withColumn("_b", best)
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_b.start").alias("start"), F.col("_b.length").alias("length"), F.col("_b.period").alias("period"),
        F.expr("1000 * _b.length div _b.period").alias("exponent_milli"), F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )

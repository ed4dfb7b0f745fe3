"""Near copies by the Jaccard likeness of word shingles: MinHash bands find the candidates, the shingle sets decide."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, discard, fold_ascii, materialize, mix64, prefix_hash, shingle_hashes, span_hash, word_spans
from .components import connected_components

SHINGLE_WORDS = 5
#: Least likeness of two near copies, as a fraction, so that it is tested in whole numbers.
LIKE = (4, 5)
#: A pair at likeness 0.8 shares a key of some band with probability 1 - (1 - 0.8^6)^25 = 0.9995.
BANDS, ROWS = 25, 6
#: Up to so many texts under one key are compared each with each as pairs of rows; more, with a leader and then in blocks.
FEW = 16
BLOCK = 512

_FACTORS = mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_LINK = "a long, b long"


def _shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of a chunk, and where those of each document begin (one more for the end)."""
    n_docs = len(offsets) - 1
    start, end, doc = word_spans(data, offsets)
    h, at = shingle_hashes(span_hash(prefix_hash(fold_ascii(data)), start, end), doc, n_docs, width)
    return h, np.searchsorted(at, np.arange(n_docs + 1))


def band_keys(docs: DataFrame, text: str, width: int = SHINGLE_WORDS) -> DataFrame:
    """`docs` with `keys`, one per band, in place of the text. Texts without words have the same keys."""
    read = docs.columns
    kept = [c for c in read if c != text]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField("keys", T.ArrayType(T.LongType()))])

    def run(batches):
        for rows, data, offsets in chunks(batches, text):
            h, cut = _shingles(data, offsets, width)
            some = np.flatnonzero(cut[1:] > cut[:-1])
            keys = np.zeros((len(offsets) - 1, BANDS), np.uint64)
            for k, factor in enumerate(_FACTORS):
                if len(some):
                    keys[some, k // ROWS] = mix64(keys[some, k // ROWS] + np.minimum.reduceat(h * factor, cut[some]))
            keys = mix64(keys + np.arange(1, BANDS + 1, dtype=np.uint64))
            wide = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * BANDS), pa.array(keys.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([*(rows.column(read.index(c)) for c in kept), wide], names=[*kept, "keys"])

    return docs.mapInArrow(run, schema)


def shingle_sets(texts: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """(node, own) of (node, _t): the distinct shingle hashes, ascending, as bytes."""

    def run(batches):
        for rows, data, offsets in chunks(batches, "_t"):
            h, cut = _shingles(data, offsets, width)
            own = [np.unique(h[a:b]).tobytes() for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(own, pa.binary())], names=["node", "own"])

    return texts.select("node", "_t").mapInArrow(run, "node long, own binary")


def _alike(a: bytes, b: bytes) -> bool:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if min(len(x), len(y)) * LIKE[1] < max(len(x), len(y)) * LIKE[0]:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both * LIKE[1] >= (len(x) + len(y) - both) * LIKE[0]


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose shingle sets are alike, written; two sets without shingles are."""

    def run(batches):
        for rows in batches:
            keep = [_alike(x, y) for x, y in zip(rows.column(2).to_pylist(), rows.column(3).to_pylist())]
            yield rows.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    pairs = materialize(pairs.select("a", "b").distinct())
    # the sets of these pairs alone are shuffled
    own = materialize(sets.join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi"))
    left, right = own.select(F.col("node").alias("a"), F.col("own").alias("x")), own.select(F.col("node").alias("b"), F.col("own").alias("y"))
    out = materialize(pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y").mapInArrow(run, _LINK))
    discard(pairs, own)
    return out


def forest(sets: list[bytes], wanted: np.ndarray, columns: int = 4096) -> list[tuple[int, int]]:
    """Links that join what pairs of alike sets join, where one of a pair is wanted: at most one link less than sets.

    Intersections are products of 0/1 matrices over the shingles that two sets or more have, some columns at a time.
    """
    own = [np.frombuffer(x, np.uint64) for x in sets]
    size = np.array([len(x) for x in own], np.int64)
    n = len(own)
    doc = np.repeat(np.arange(n), size)
    _, which, count = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
    column = np.where(count > 1, np.cumsum(count > 1) - 1, -1)[which]
    doc, column = doc[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    doc, column = doc[order], column[order]
    both = np.zeros((n, n), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        a, b = np.searchsorted(column, (at, at + columns))
        part = np.zeros((n, columns), np.float32)
        part[doc[a:b], column[a:b] - at] = 1
        both += part @ part.T
    alike = both * LIKE[1] >= (size[:, None] + size[None] - both) * LIKE[0]
    alike &= wanted[:, None] | wanted[None]
    links, seen = [], np.zeros(n, bool)
    for root in range(n):
        front = [] if seen[root] else [root]
        seen[root] = True
        while len(front):
            fresh = np.flatnonzero(alike[front].any(axis=0) & ~seen)
            links += [(front[k], f) for k, f in zip(alike[np.ix_(front, fresh)].argmax(axis=0).tolist(), fresh.tolist())]
            seen[fresh] = True
            front = fresh.tolist()
    return links


def _in_blocks(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links among the texts of crowded keys (key, node, n, wanted): members are dealt to blocks, and every two blocks of a key meet in one task of a bounded size."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks.cast("long")).cast("int")
    other = F.when(blocks == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), blocks - 1), lambda j: j != own))
    dealt = members.join(sets, "node").select("key", "node", "wanted", "own", own.alias("block"), F.explode(other).alias("other"))
    dealt = dealt.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "wanted", "own")

    def compare(table: pa.Table) -> pa.Table:
        node = table.column("node").to_pylist()
        links = forest(table.column("own").to_pylist(), np.array(table.column("wanted").to_pylist(), bool))
        return pa.table([pa.array([node[x] for x, _ in links], pa.int64()), pa.array([node[y] for _, y in links], pa.int64())], names=["a", "b"])

    return materialize(dealt.groupBy("key", "i", "j").applyInArrow(compare, _LINK))


def _parted(members: DataFrame, joined: DataFrame) -> DataFrame:
    """`members` (key, node, n) of the keys whose texts are not all in one component of `joined`, with their component c."""
    own = members.join(joined, "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("c"))
    mixed = own.groupBy("key").agg(F.min("c").alias("_lo"), F.max("c").alias("_hi")).where("_lo < _hi").select("key")
    return materialize(own.join(mixed, "key", "left_semi"))


def _links(nodes: DataFrame, texts: DataFrame, width: int, pairs: DataFrame | None = None) -> DataFrame:
    """(node, component): the components of near copies. Those of `pairs` (a, b) that are alike are joined first, and keys
    whose texts these join are passed over.

    Texts that share a key are compared each with each if they are few. If they are many, each is compared with a leader:
    the text that shares its keys with most others (of a text and its edited copies, the text). Those that are near
    copies of it need no link among themselves; those that are not are compared with all texts of the key, in blocks. So
    no link that joins two components is lost.
    """
    wide = materialize(nodes.select("node", F.explode("keys").alias("key")))
    shared = materialize(wide.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    members = materialize(wide.join(shared, "key"))
    discard(wide, shared)
    # copies are one text before the shuffle, and the join reads that shuffle
    once = texts.groupBy("node").agg(F.first("_t").alias("_t"))
    named = members.select("node")
    if pairs is not None:
        named = named.unionByName(pairs.select(F.explode(F.array("a", "b")).alias("node")))
    sets = materialize(shingle_sets(once.join(named.distinct().hint("merge"), "node", "left_semi"), width))
    links = None
    if pairs is not None:
        links = verified(pairs, sets)
        members, every = _parted(members, connected_components(links)), members
        discard(every)
    else:
        members = members.withColumn("c", F.col("node"))
    group = members.where(F.col("n") <= FEW).groupBy("key").agg(F.collect_list(F.struct("node", "c")).alias("g"))
    few = group.select(F.explode("g").alias("x"), "g").select("x", F.explode("g").alias("y")).where("x.node < y.node and x.c <> y.c")
    few = verified(few.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")), sets)
    many = members.where(F.col("n") > FEW)
    many = materialize(many.join(many.groupBy("node").agg(F.sum("n").alias("w")), "node").select("key", "node", "n", "c", "w"))
    leader = materialize(many.groupBy("key").agg(F.max_by(F.struct("node", "c"), F.struct("w", "node")).alias("l")).select("key", F.col("l.node").alias("b"), F.col("l.c").alias("of")))
    led = materialize(many.join(leader, "key").select("key", "n", F.col("node").alias("a"), "b", (F.col("c") == F.col("of")).alias("joined")))
    close = verified(led.where(~F.col("joined")), sets)
    judged = led.join(close.withColumn("_near", F.lit(True)), ["a", "b"], "left").select("key", F.col("a").alias("node"), "n", (F.col("_near").isNull() & ~F.col("joined")).alias("wanted"))
    judged = materialize(judged)
    crowded = judged.join(judged.where("wanted").select("key").distinct(), "key", "left_semi")
    found = few.unionByName(close).unionByName(_in_blocks(crowded, sets))
    links = found if links is None else links.unionByName(found)
    component = connected_components(links)
    discard(members, sets, many, leader, led, judged)
    return component


def near_copy_names(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS, first: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows as (id_col, text_hash), and (text_hash, group, component_id) with one row a distinct text: see near_copy_groups.

    `first` finds pairs (a, b) in the texts (node, _t), a row for each document, that are checked and joined before the bands' are.
    """
    own = docs.select(id_col, F.col(text).alias("_t"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"))
    rows = materialize(band_keys(own, "_t", width))
    nodes = materialize(rows.groupBy(F.col("text_hash").alias("node")).agg(F.min(id_col).alias("lowest"), F.first("keys").alias("keys")))
    texts = own.select(F.col("text_hash").alias("node"), F.coalesce("_t", F.lit("")).alias("_t"))
    links = _links(nodes, texts, width, first(texts) if first else None)
    owner = materialize(nodes.select("node", "lowest").join(links, "node", "left").select("node", "lowest", F.coalesce("component", "node").alias("group")))
    names = owner.groupBy("group").agg(F.min("lowest").alias("component_id"))
    named = materialize(owner.join(names, "group").select(F.col("node").alias("text_hash"), "group", "component_id"))
    discard(nodes, owner)
    return rows.select(id_col, "text_hash"), named


def near_copy_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """(id_col, text_hash, group, component_id): documents linked by pairs of likeness 0.8 or more, chains included; component_id is the group's smallest id.

    Likeness is that of the sets of `width`-word shingles (white space parts words, A-Z lower-cased; fewer words are one
    shingle). Equal texts are one node, so copies never multiply; null is the empty text. A candidate shares all ROWS
    minima of a band; a text alone under all its keys has no near copy. Null ids are rows of their own in a group but never name it unless all its ids are null.
    """
    rows, named = near_copy_names(docs, id_col, text, width)
    return rows.join(named, "text_hash").select(id_col, "text_hash", "group", "component_id")

"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WHITE, chunks, discard, documents, fold_ascii, materialize, word_spans
from .components import connected_components
from .nearcopies import near_copy_names

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
#: Likeness of texts: whole fingerprints of 5-word shingles may differ in so many bits, beyond which no two texts at 0.8 are expected.
NEAR_WORDS, REACH = 5, 20


def _fingerprint_rows(data: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """One 64-bit fingerprint per document of a chunk."""
    n_docs = len(offsets) - 1
    start, end, doc = word_spans(data, offsets)
    if not len(start):
        return np.zeros(n_docs, np.uint64)
    # words with one space after each: a shingle is then one slice
    keep = ~WHITE[data]
    gap = end[end < len(data)]
    gap = gap[WHITE[data[gap]]]
    keep[gap] = True
    text = np.where(WHITE[data], np.uint8(32), fold_ascii(data))[keep].tobytes()
    place = np.cumsum(keep) - 1
    at, to = place[start], place[end - 1] + 1
    per_doc = np.bincount(doc, minlength=n_docs)
    first = np.cumsum(per_doc) - per_doc
    many = np.where(per_doc == 0, 0, np.maximum(per_doc - width + 1, 1))
    i = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
    j = i + np.repeat(np.minimum(per_doc, width), many) - 1
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(text[a:b], SEED) for a, b in zip(at[i].tolist(), to[j].tolist())], np.uint64)
    out = np.zeros(n_docs, np.uint64)
    cut = np.cumsum(many)
    weights = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
    for d in np.flatnonzero(many):
        a, b = cut[d] - many[d], cut[d]
        ones = np.zeros(64, np.int64)
        for k in range(a, b, 1 << 16):
            ones += np.unpackbits(h[k : min(b, k + (1 << 16))].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        out[d] = weights[2 * ones > many[d]].sum(dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint", width: int = SHINGLE_WORDS, keep_text: bool = True) -> DataFrame:
    """`docs` (without keep_text: less its text) with a column `out`, the 64 bits of the SimHash as long; it replaces a column of that name.

    Words are maximal runs without white space, A-Z lower-cased; features are the hashes (XXH64, seed 42) of all word
    shingles, repeats included. A bit is 1 if more than half of the hashes have it. Fewer words than a shingle: the
    whole sequence; null, empty or blank text: 0.
    """
    read = [c for c in docs.columns if c != out]
    kept = [c for c in read if keep_text or c != text]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(out, T.LongType())])

    def run(batches):
        for rows, data, offsets in chunks(batches, text):
            fp = _fingerprint_rows(data, offsets, width).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(rows.column(read.index(c)) for c in kept), pa.array(fp)], names=[*kept, out])

    return docs.select(*read).mapInArrow(run, schema)


def _balls(points: DataFrame, radius: int, bits: int = 64) -> DataFrame:
    """(variant, b): all points within half the radius (rounded up) of each b, in its lowest `bits`."""
    masks = [0]
    for k in range(1, (radius + 1) // 2 + 1):
        masks += [sum(1 << i for i in at) for at in combinations(range(bits), k)]
    masks = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    wide = points.select("b", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])).alias("m"))
    return wide.select(F.col("b").bitwiseXOR(F.col("m")).alias("variant"), "b")


def ball_links(prints: DataFrame, fp: str = "fp", radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that join every two of the distinct fingerprints at `radius` or fewer differing bits, directly or by others in reach.

    Every fingerprint emits all variants within half the radius. Two prints within the radius share a variant, and a
    variant has at most as many prints as the ball has points (65 at radius 2) however large a group of copies is, so no
    group is unbounded. Neighbours in a variant's sorted group are linked and verified; that keeps each group connected.
    """
    wide = _balls(prints.select(F.col(fp).alias("b")).where("b is not null").distinct(), radius)
    if radius % 2:  # members of a group may then lie one bit too far apart: compare all of the bounded group
        group = wide.groupBy("variant").agg(F.collect_set("b").alias("g")).where(F.size("g") > 1)
        pairs = group.select(F.explode("g").alias("a"), "g").select("a", F.explode("g").alias("b")).where("a < b")
    else:
        pairs = wide.withColumn("a", F.lag("b").over(Window.partitionBy("variant").orderBy("b"))).where("a is not null")
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).select("a", "b").distinct()


def near_pairs(texts: DataFrame, node: str = "node", text: str = "_t", width: int = NEAR_WORDS, reach: int = REACH) -> DataFrame:
    """Pairs (a, b) of nodes that balls around the halves of their fingerprints bring together, written; for an exact check.

    Two fingerprints that differ in 5 bits or fewer have a half that differs in 2 or fewer; so balls of radius 2, of 33
    points each, around each distinct half of 32 bits meet in a variant (of two at more bits, some do). A variant has at
    most 33 halves, but a half may have many nodes: each node is paired with the one that meets most others there, if the
    whole fingerprints differ in `reach` bits or fewer, so pairs grow with the nodes and not with their squares.
    """
    rows = materialize(fingerprints(texts.select(node, text), text, "fp", width, keep_text=False).groupBy(F.col(node).alias("node")).agg(F.first("fp").alias("fp")))
    low = F.col("fp").bitwiseAND(F.lit((1 << 32) - 1))
    high = F.shiftrightunsigned("fp", 32).bitwiseOR(F.lit(1 << 32))  # bit 32 tells the halves apart
    halves = rows.select("node", "fp", F.explode(F.array(low, high)).alias("b"))
    points = materialize(halves.groupBy("b").agg(F.count("*").alias("n")))
    met = _balls(points.select("b"), RADIUS, 32).withColumn("n", F.count("*").over(Window.partitionBy("variant"))).where("n > 1").select("variant", "b")
    met = met.unionByName(points.where("n > 1").select(F.col("b").alias("variant"), "b")).distinct()
    members = materialize(met.join(halves, "b").select("variant", "node", "fp"))
    weight = members.groupBy("node").agg(F.count("*").alias("w"))
    leader = members.join(weight, "node").groupBy("variant").agg(F.max_by(F.struct("node", "fp"), F.struct("w", "node")).alias("l"))
    led = members.join(leader, "variant").where((F.col("node") != F.col("l.node")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("l.fp"))) <= reach))
    pairs = materialize(led.select(F.least("node", "l.node").alias("a"), F.greatest("node", "l.node").alias("b")).distinct())
    discard(rows, points, members)
    return pairs


def near_duplicate_names(docs: DataFrame, id_col: str = "doc_id", text: str = "text", radius: int = RADIUS) -> tuple[DataFrame, DataFrame]:
    """The rows as (id_col, text_hash, fp), and (fp, group, component_id) with one row a distinct fingerprint: see near_duplicate_groups."""
    own = docs.select(id_col, F.col(text).alias("_t"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"))
    rows = materialize(fingerprints(own, "_t", "fp", keep_text=False))
    nodes = materialize(rows.groupBy("fp").agg(F.min(id_col).alias("lowest")))
    links = connected_components(ball_links(nodes, "fp", radius))
    owner = nodes.join(links, nodes.fp == links.node, "left").select("fp", "lowest", F.coalesce("component", "fp").alias("group"))
    owner = materialize(owner)
    names = owner.groupBy("group").agg(F.min("lowest").alias("component_id"))
    named = materialize(owner.join(names, "group").select("fp", "group", "component_id"))
    discard(nodes, owner)
    return rows, named


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """(id_col, text_hash, fp, group, component_id): documents whose fingerprints are linked, chains included; component_id is the group's smallest id.

    Equal fingerprints are one node, so copies never multiply. Null ids are rows of their own in a group but never name it
    unless all its ids are null. An empty table gives no rows.
    """
    rows, named = near_duplicate_names(docs, id_col, text, radius)
    return rows.join(named, "fp").select(id_col, "text_hash", "fp", "group", "component_id")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every document."""
    found = near_duplicate_groups(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", similar: bool = False) -> DataFrame:
    """`docs` without the near-duplicates: of each group one row stays, the one with the smallest id.

    Groups are those of linked fingerprints or, with `similar`, of texts whose 5-word shingles have a likeness of 0.8 or
    more: there balls around the halves of fingerprints of such shingles bring texts together first, and the shingle sets
    decide. At that likeness fingerprints differ in some 10 of 64 bits, so balls miss a part of the pairs: MinHash bands
    then find those between texts that are not yet in one group, and the sets decide again. Of rows with one id the one of
    the least text hash stays, of rows equal in both any one. A row with a null id stays only in a group without other ids.
    """
    if similar:
        return keep_lowest(docs, *near_copy_names(docs, id_col, text, NEAR_WORDS, near_pairs), "text_hash", id_col, text)
    return keep_lowest(docs, *near_duplicate_names(docs, id_col, text), "fp", id_col, text)


def keep_lowest(docs: DataFrame, rows: DataFrame, named: DataFrame, node: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of `docs` for each group of `named` (node, group); `rows` has id_col, text_hash and the node of each row.

    The lowest row of each node is found before the groups are joined, so a node with many copies meets them as one row.
    """
    own = rows.select(F.col(node).alias("_node"), F.col(id_col).alias("_id"), F.col("text_hash").alias("_hash"))
    each = own.groupBy("_node", "_id", "_hash").agg(F.count("*").alias("_rows"))
    lowest = each.groupBy("_node").agg(F.min(F.struct(F.col("_id").isNull().alias("_none"), "_id", "_hash", "_rows")).alias("r"))
    grouped = lowest.join(named.select(F.col(node).alias("_node"), "group"), "_node")
    stay = materialize(grouped.groupBy("group").agg(F.min("r").alias("r")).select("r._id", "r._hash", "r._rows"))
    keyed = F.xxhash64(F.coalesce(docs[text], F.lit("")))
    # always a sort-merge join, at every size: what stays grows with the corpus
    kept = docs.join(stay.hint("merge"), docs[id_col].eqNullSafe(stay["_id"]) & (keyed == stay["_hash"]))
    if stay.where("_rows > 1").isEmpty():
        return kept.select(*[docs[c] for c in docs.columns])
    columns = F.struct(*[docs[c] for c in docs.columns])
    once = kept.where("_rows = 1").select(columns.alias("r"))
    return once.unionByName(kept.where("_rows > 1").groupBy("_id", "_hash").agg(F.first(columns).alias("r")).select("r")).select("r.*")

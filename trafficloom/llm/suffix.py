"""Exact removal of repeated byte strings: threshold-bounded interval expansion on Burrows-Wheeler transforms."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, discard, documents, materialize, mix64, prefix_hash, span_hash, word_spans

#: Bytes of a string whose repeats are removed.
LENGTH = 400
#: Bytes of a string whose repeats are reported: of a passage of over PASSAGE_WORDS words, shorter ones included.
PASSAGE_BYTES = 256
PASSAGE_WORDS = 50
#: Bytes of a gram; the least gram hash of the first PASSAGE_BYTES of a string names it, so that equal strings meet.
GRAM = 96
#: Most starts of strings in one stretch of text.
STRETCH = 1024
#: Bytes of stretches that one transform takes, about; a name with more than half of that is counted by string hashes.
BLOCK_BYTES = 1 << 20
#: Ends a stretch in a transform; UTF-8 has no such byte.
END = 0xFF


# --- the transform ---------------------------------------------------------------------------------------------------


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions sorted by the `depth` or more bytes that follow, starts of the runs with equal first 8 bytes).

    The text is a circle, as the transform takes it to be. Prefix doubling: runs of equal suffixes are sorted by what
    follows them, twice as deep each time.
    """
    n = len(text)
    circle = np.resize(text, n + 8).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = key << np.uint64(8) | circle[k : n + k]
    order = np.argsort(key)
    sorted_key = key[order]
    new = np.ones(n, bool)
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    seeds = np.flatnonzero(new)
    rank = np.zeros(n, np.uint64)  # start of the suffix's run
    rank[order] = seeds[np.cumsum(new) - 1]
    at = 8
    slots = np.arange(n)
    while at < depth:
        tied = ~new
        tied[:-1] |= ~new[1:]
        slots = slots[tied]
        if not len(slots):
            break
        who = order[slots]
        pair = rank[who] << np.uint64(32) | rank[(who + at) % n]
        by = np.argsort(pair)
        who, pair = who[by], pair[by]
        order[slots] = who
        new = np.ones(len(slots), bool)
        new[1:] = pair[1:] != pair[:-1]
        first = np.flatnonzero(new)
        rank[who] = slots[first][np.cumsum(new) - 1]
        at *= 2
    return order, seeds


def common_prefix_bounds(text: np.ndarray, length: int, shorter: int | None = None) -> tuple[np.ndarray, ...]:
    """(suffix order, bound): bound[k] is whether suffixes k - 1 and k of the order share fewer than `length` bytes; with `shorter`, also the bounds at that length.

    Breadth-first backward extension. A string's suffixes are an interval of the order; those of the string with a
    character put before it follow from the transform's characters in the interval. The end of an interval of strings of
    l bytes bounds a common prefix of less than l bytes. Each end is found once, at increasing l, and only an interval
    whose end is new is extended; the search stops at `length`. It starts from the intervals of 8 bytes.
    """
    n = len(text)
    order, seeds = suffix_order(text, length)
    before = text[order - 1]  # the transform: the byte before each suffix, in their order
    back = np.empty(n, np.int64)
    back[np.argsort(before, kind="stable")] = np.arange(n)
    bound = np.zeros(n + 1, bool)
    bound[seeds] = True
    bound[n] = True
    low, high = seeds, np.append(seeds[1:], n)
    early = None
    for done in range(8, length):
        if done == shorter:
            early = bound[:n].copy()
        single = high - low == 1
        start = back[low[single]]
        end = start + 1
        fresh = ~bound[end]
        start, end = start[fresh], end[fresh]
        many_low, size = low[~single], (high - low)[~single]
        if len(size):
            stop = np.cumsum(size)
            rows = np.repeat(many_low - (stop - size), size) + np.arange(stop[-1])
            key = np.repeat(np.arange(len(size)) << 8, size) | before[rows]
            by = np.argsort(key, kind="stable")
            key = key[by]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            count = np.diff(np.append(first, len(key)))
            more = back[rows[by[first]]]
            fresh = ~bound[more + count]
            start, end = np.concatenate((start, more[fresh])), np.concatenate((end, (more + count)[fresh]))
        if not len(start):
            break
        bound[end] = True
        low, high = start, end
    if shorter is None:
        return order, bound[:n]
    return order, bound[:n], bound[:n] if early is None else early


def repeated_starts(stretches: list[bytes], starts: list[int], length: int, shorter: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Per stretch, for each of its first `starts` positions, whether the string of `length` (and of `shorter`) bytes there also starts at another of those positions."""
    text = np.frombuffer(b"".join(s + bytes([END]) for s in stretches), np.uint8)
    order, *bounds = common_prefix_bounds(text, length, shorter)
    size = np.array([len(s) for s in stretches])
    begin = np.cumsum(size + 1) - size - 1
    out = []
    for many, bound in zip((length, shorter), bounds):
        own = np.clip(size - many + 1, 0, starts)  # a start has its whole string in the stretch
        judged = np.zeros(len(text), bool)
        judged[np.repeat(begin - np.cumsum(own) + own, own) + np.arange(own.sum())] = True
        interval = np.cumsum(bound) - 1
        rows = np.flatnonzero(judged[order])
        twice = np.bincount(interval[rows], minlength=1) > 1
        marked = np.zeros(len(text), bool)
        marked[order[rows[twice[interval[rows]]]]] = True
        out.append([marked[a : a + n] for a, n in zip(begin.tolist(), own.tolist())])
    return out[0], out[1]


# --- stretches: parts of texts whose strings share the least gram hash ------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15


def _gram_hashes(data: np.ndarray, gram: int, block: int = 1 << 13) -> np.ndarray:
    """Hashes of the grams at each position, modulo 2^64: names that bring equal strings together. Unlike grams under one name only cost a comparison."""
    power = np.full(block + gram, _BASE, np.uint64)
    back = np.full(block + gram, pow(_BASE, -1, 1 << 64), np.uint64)
    power[0] = back[0] = 1
    power, back = np.multiply.accumulate(power), np.multiply.accumulate(back)
    out = np.empty(len(data) - gram + 1, np.uint64)
    for at in range(0, len(out), block):
        value = data[at : at + block + gram - 1].astype(np.uint64) + np.uint64(1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value * power[: len(value)])))
        n = len(value) - gram + 1
        out[at : at + n] = mix64((total[gram:] - total[:n]) * back[:n])
    return out


def stretches(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, shorter: int = PASSAGE_BYTES, gram: int = GRAM, most: int = STRETCH) -> tuple[np.ndarray, ...]:
    """(document, first start, number of starts, bytes, name, whether its name's gram stands in it twice) of every stretch.

    Each string of `shorter` bytes starts in one stretch: that of the neighbouring strings of its document with the same
    least gram hash, its name. Equal strings have equal names. A stretch reaches `length` bytes beyond its last start, or to the document's end.
    """
    empty = np.empty(0, np.int64)
    n, width = len(data), shorter - gram + 1
    m = n - shorter + 1
    if m <= 0:
        return empty, empty, empty, empty, empty.astype(np.uint64), empty.astype(bool)
    grams = _gram_hashes(data, gram)
    # minima of windows from minima of blocks, forth and back
    blocks = np.full(-(-len(grams) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[: len(grams)] = grams
    blocks = blocks.reshape(-1, width)
    forth = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    name = np.minimum(back[:m], forth[width - 1 : width - 1 + m])
    sizes = np.diff(offsets)
    inside = np.ones(m, bool)
    ends = offsets[1:]
    late = np.maximum(ends - shorter + 1, offsets[:-1])  # the first start whose string would leave its document
    many = ends - late
    leave = np.repeat(late - np.cumsum(many) + many, many) + np.arange(many.sum())
    inside[leave[leave < m]] = False
    new = inside.copy()
    new[1:] &= (name[1:] != name[:-1]) | ~inside[:-1]
    first_of = offsets[:-1][(sizes >= shorter)]
    new[first_of] = True
    first = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    size = np.bincount(run[inside], minlength=len(first))
    if len(size) and size.max() > most:  # as in long runs of one character
        parts = -(-size // most)
        skip = (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)) * most
        first, size = np.repeat(first, parts) + skip, np.minimum(np.repeat(size, parts) - skip, most)
    span = np.arange(width)
    left = first + (grams[first[:, None] + span] == name[first][:, None]).argmax(axis=1)
    last = first + size - 1
    right = last + width - 1 - (grams[last[:, None] + span[::-1]] == name[first][:, None]).argmax(axis=1)
    doc = np.searchsorted(offsets, first, "right") - 1
    return doc, first - offsets[doc], size, np.minimum(first + size + length - 1, offsets[doc + 1]) - first, name[first], left != right


def _keyed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(_id, _th, _t): a place in a text is known by the row's id and its text's hash; rows equal in both have the same places."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(id_col).alias("_id"), F.xxhash64(body).alias("_th"), body.alias("_t"))


def _kind(docs: DataFrame, id_col: str) -> str:
    return f"_id {docs.schema[id_col].dataType.simpleString()}, _th long"


def _taken(rows: pa.RecordBatch, index: np.ndarray) -> list[pa.Array]:
    take = pa.array(index, pa.int64())
    return [rows.column(0).take(take), rows.column(1).take(take)]


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, shorter: int = PASSAGE_BYTES) -> DataFrame:
    """(_id, _th, at, n, short): starts at, at + 1, ... of strings that also start elsewhere in `docs`: n of `length` bytes, `short` of `shorter` bytes.

    1. Names of stretches that stand once drop out, if their gram stands in them once. 2. Equal stretches (by 128-bit
    hashes of their bytes) are one, whatever the number of copies; all of their strings are repeated. 3. Names with
    several different stretches are dealt to blocks of a bounded size, one transform each. 4. A name with too many
    different stretches for a block is counted by hashes (122 bits) of its strings instead, spread over all tasks, so
    that no passage is too common.
    """
    kind = _kind(docs, id_col)
    keyed = _keyed(docs, id_col, text)
    body = ["name", "b1", "b2", "n", "size"]

    def find(batches):
        for rows, data, offsets in chunks(batches, "_t"):
            doc, at, n, size, name, own = stretches(data, offsets, length, shorter)
            raw = memoryview(data)
            begin = offsets[doc] + at
            bodies = np.frombuffer(b"".join(xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(begin.tolist(), (begin + size).tolist())), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [*_taken(rows, doc), pa.array(name.view(np.int64)), pa.array(bodies[:, 0]), pa.array(bodies[:, 1]), pa.array(at, pa.int64()), pa.array(n, pa.int32()), pa.array(size, pa.int32()), pa.array(own)],
                names=["_id", "_th", "name", "b1", "b2", "at", "n", "size", "own"],
            )

    every = materialize(keyed.mapInArrow(find, f"{kind}, name long, b1 long, b2 long, at long, n int, size int, own boolean"))
    often = materialize(every.groupBy("name").agg(F.count("*").alias("c"), F.max("own").alias("own")).where("c > 1 or own").select("name"))
    found = materialize(every.join(often, "name", "left_semi"))
    discard(every, often)
    bodies = materialize(found.groupBy(*body).agg(F.min(F.struct("_id", "_th", "at")).alias("p"), (F.count("*") > 1).alias("copied"), F.max("own").alias("own")))
    sizes = materialize(bodies.groupBy("name").agg(F.count("*").alias("k"), F.sum(F.col("size") + 1).alias("bytes"), F.max("own").alias("own")).where("k > 1 or own").drop("own"))
    whole = F.greatest(F.lit(0), F.least("n", F.col("size") - length + 1))
    copied = materialize(found.join(materialize(bodies.where("copied").select(*body)), body).select("_id", "_th", "at", whole.cast("int").alias("_n"), F.col("n").alias("short"))).withColumnRenamed("_n", "n")

    # the stretches that are compared, with their bytes: one of each content
    wanted = bodies.join(sizes, "name").select("p._id", "p._th", "p.at", "n", "size", "name", "copied", (F.col("bytes") > BLOCK_BYTES // 2).alias("large"))
    wanted = materialize(wanted.groupBy("_id", "_th").agg(F.collect_set(F.struct("at", "n", "size", "name", "copied", "large")).alias("parts"))).withColumnsRenamed({"_id": "_rid", "_th": "_rth"})
    discard(found, bodies, sizes)
    texts = keyed.join(wanted, keyed._id.eqNullSafe(wanted._rid) & (keyed._th == wanted._rth)).select("_id", "_th", "_t", "parts")

    def cut(batches):
        for rows, data, offsets in chunks(batches, "_t"):
            raw, doc, out = data.tobytes(), [], []
            for d, parts in enumerate(rows.column(3).to_pylist()):
                for p in parts:
                    a = int(offsets[d]) + p["at"]
                    doc.append(d)
                    out.append((p["at"], p["n"], p["name"], p["copied"], p["large"], raw[a : a + p["size"]]))
            cols = list(zip(*out)) or [[]] * 6
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([*_taken(rows, np.array(doc, np.int64)), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=["_id", "_th", "at", "n", "name", "copied", "large", "stretch"])

    parts = materialize(texts.mapInArrow(cut, f"{kind}, at long, n int, name long, copied boolean, large boolean, stretch binary"))
    discard(wanted)
    total = parts.where("not large").agg(F.sum(F.length("stretch"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    dealt = parts.where("not large").withColumn("block", F.pmod(F.xxhash64("name"), F.lit(blocks)).cast("int"))

    def compare(table: pa.Table) -> pa.Table:
        same = list(zip(*(table.column(c).to_pylist() for c in ("_id", "_th", "at"))))  # rows equal in id and text give one stretch
        table = table.take(pa.array(sorted({x: k for k, x in enumerate(same)}.values()), pa.int64()))
        marks = repeated_starts(table.column("stretch").to_pylist(), table.column("n").to_pylist(), length, shorter)
        rows, at, n, short = [], [], [], []
        begin, skip = table.column("at").to_pylist(), table.column("copied").to_pylist()
        for level, flags in enumerate(marks):
            for k, m in enumerate(flags):
                if not skip[k] and m.any():  # copied ones are known already
                    a, b = _runs(m)
                    rows += [k] * len(a)
                    at += (a + begin[k]).tolist()
                    n += ((b - a) * (level == 0)).tolist()
                    short += ((b - a) * (level == 1)).tolist()
        take = pa.array(rows, pa.int64())
        return pa.table([table.column("_id").take(take), table.column("_th").take(take), pa.array(at, pa.int64()), pa.array(n, pa.int32()), pa.array(short, pa.int32())], names=["_id", "_th", "at", "n", "short"])

    compared = dealt.select("_id", "_th", "at", "n", "copied", "stretch", "block").groupBy("block").applyInArrow(compare, f"{kind}, at long, n int, short int")
    return copied.select("_id", "_th", "at", "n", "short").unionByName(compared).unionByName(_counted(parts.where("large").drop("large", "name"), kind, length, shorter))


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true flags."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _counted(parts: DataFrame, kind: str, length: int, shorter: int) -> DataFrame:
    """Repeated starts of stretches by counting string hashes; counts are summed before they are shuffled."""

    def strings(batches):
        for rows in batches:
            column = lambda c: rows.column(rows.schema.get_field_index(c)).to_pylist()
            bodies, starts, begin = column("stretch"), column("n"), column("at")
            for at in range(0, len(bodies), 64):
                group = bodies[at : at + 64]
                data = np.frombuffer(b"".join(group), np.uint8)
                size = np.array([len(b) for b in group])
                prefix = [prefix_hash(data, lane) for lane in (0, 1)]
                for many in (length, shorter):
                    own = np.clip(size - many + 1, 0, starts[at : at + 64])
                    row = np.repeat(np.arange(len(group)), own)
                    inner = np.arange(len(row)) - np.repeat(np.cumsum(own) - own, own)
                    start = np.repeat(np.cumsum(size) - size, own) + inner
                    a, b = (span_hash(prefix[lane], start, start + many, lane).view(np.int64) for lane in (0, 1))
                    take = row + at
                    yield pa.RecordBatch.from_arrays([*_taken(rows, take), pa.array(np.array(begin, np.int64)[take] + inner), pa.array(np.full(len(row), int(many == length), np.int32)), pa.array(a), pa.array(b)], names=["_id", "_th", "at", "whole", "a", "b"])

    each = parts.select("_id", "_th", "at", "n", "stretch").mapInArrow(strings, f"{kind}, at long, whole int, a long, b long")
    place = F.struct("_id", "_th", "at")
    twice = materialize(each.groupBy("whole", "a", "b").agg(F.min(place).alias("p"), F.max(place).alias("q")).where("not (p <=> q)").select("whole", "a", "b"))
    return each.join(twice, ["whole", "a", "b"], "left_semi").select("_id", "_th", "at", F.col("whole").alias("n"), (1 - F.col("whole")).alias("short"))


def _covered(spans: list[dict], count: str, many: int, size: int) -> np.ndarray:
    """Which of `size` bytes lie in strings of `many` bytes that start as the spans say."""
    step = np.zeros(size + 1, np.int32)
    for s in spans:
        if s[count]:
            step[s["at"]] += 1
            step[s["at"] + s[count] + many - 1] -= 1
    return np.cumsum(step[:-1]) > 0


def _passage_words(body: np.ndarray, covered: np.ndarray, least: int) -> int:
    """Words that lie wholly in runs of covered bytes that hold more than `least` words."""
    low, high = _runs(covered)
    if not len(low):
        return 0
    start, end, _ = word_spans(body, np.array([0, len(body)]))
    run = np.searchsorted(low, start, "right") - 1
    words = np.bincount(run[(run >= 0) & (end <= high[run])], minlength=1)
    return int(words[words > least].sum())


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, with_text: bool = False, shorter: int = PASSAGE_BYTES, passage_words: int = PASSAGE_WORDS) -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, kept_sha256, n_passage_words, with_text: kept binary), one row per row of `docs`.

    Removes every byte of a string of `length` bytes that also starts anywhere else in `docs`, the same document included;
    strings are judged as they stand in the input and never cross documents. Null texts are empty. Every row is a
    document: rows equal in id and text repeat each other. n_spans counts the maximal removed runs.

    n_passage_words reports shared passages, removed or not: the words in maximal runs of bytes of strings of `shorter`
    bytes that also start elsewhere, of the runs that hold more than `passage_words` words. `shorter` is more than GRAM
    and at most `length`.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    spans = repeated_spans(docs, id_col, text, length, shorter).groupBy("_id", "_th").agg(F.collect_list(F.struct("at", "n", "short")).alias("runs")).withColumnsRenamed({"_id": "_rid", "_th": "_rth"})
    keyed = _keyed(docs, id_col, text)
    both = keyed.join(spans, keyed._id.eqNullSafe(spans._rid) & (keyed._th == spans._rth), "left").select("_id", "_t", "runs")

    def cut(batches):
        for rows, data, offsets in chunks(batches, "_t"):
            out = []
            for d, found in enumerate(rows.column(2).to_pylist()):
                body = data[int(offsets[d]) : int(offsets[d + 1])]
                kept, removed, count, words = body.tobytes(), 0, 0, 0
                if found:
                    gone = _covered(found, "n", length, len(body))
                    removed, count = int(gone.sum()), len(_runs(gone)[0])
                    kept = body[~gone].tobytes()
                    words = _passage_words(body, _covered(found, "short", shorter, len(body)), passage_words)
                out.append((len(body), removed, count, hashlib.sha256(kept).hexdigest(), words, kept))
            cols = list(zip(*out)) or [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.binary())
            take = 6 if with_text else 5
            yield pa.RecordBatch.from_arrays([rows.column(0), *(pa.array(c, k) for c, k in zip(cols[:take], kinds))], names=[id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_words", "kept"][: take + 1])

    return both.mapInArrow(cut, f"{id_col} {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passage_words long" + ", kept binary" * with_text)


def op1_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))

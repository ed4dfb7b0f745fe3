"""Best-fit packing by a linear grouping scheme: documents into sequences of a fixed number of tokens."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import chunks, documents, materialize
from .tokens import Encoder

CAPACITY = 2048
#: Lengths above this share of the capacity are packed by group configurations, the others by best fit.
LARGE_SHARE = 1 / 8
#: Numbers of groups that are tried; the plan with the fewest sequences wins.
GROUP_COUNTS = (16, 64, 256, None)
#: A length's pieces are ranked in shares of about so many, or of fewer.
SHARE_ROWS = 500_000
MIN_SALTS = 64
#: The plan's slots (some 50 bytes each) are broadcast up to so many; lengths are at most the capacity, so there are hardly more.
MAX_BROADCAST_SLOTS = 200_000


def pieces(docs: DataFrame, id_col: str = "doc_id", text: str = "text", ranks_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(id_col, piece, start, length, ids_crc32): each document's ids and a closing 0, cut where longer than the capacity.

    All pieces of a longer document but the first have the capacity. A null or empty text is the closing 0 alone.
    ids_crc32 is of the ids as little-endian unsigned 32-bit numbers.
    """
    import public_tokenizers

    path, pattern = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    own: dict[str, Encoder] = {}

    def run(batches):
        encoder = own.setdefault(path, Encoder(path, pattern, 50256))
        for rows, data, offsets in chunks(batches, text):
            ids, cut = encoder.encode(data, offsets)
            row, piece, start, length, crc = [], [], [], [], []
            for d in range(len(offsets) - 1):
                doc = np.append(ids[cut[d] : cut[d + 1]], np.uint32(0)).astype("<u4")
                at, size = 0, (len(doc) - 1) % capacity + 1
                for p in range(-(-len(doc) // capacity)):
                    row.append(d), piece.append(p), start.append(at), length.append(size)
                    crc.append(zlib.crc32(doc[at : at + size].tobytes()))
                    at, size = at + size, capacity
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=[id_col, "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(id_col, text).mapInArrow(run, f"{id_col} {docs.schema[id_col].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long")


# --- the plan: from the number of pieces of each length, a bounded table whatever the input's size ------------------------


class _Plan:
    """Sequences as classes (first id, how many, tokens used), and the slots that pieces of each length take in them."""

    def __init__(self):
        self.n = 0
        self.slots: list[tuple] = []  # length, first rank, first sequence, sequences, pieces in each, offset
        self.rank: dict[int, int] = defaultdict(int)
        self.room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free tokens -> (first id, how many)

    def place(self, length: int, base: int, many: int, each: int, offset: int) -> None:
        self.slots.append((length, self.rank[length], base, many, each, offset))
        self.rank[length] += many * each


def _groups(counts: dict[int, int], n_groups: int | None) -> list[list[list[int]]]:
    """The large lengths, descending, in groups of equal cardinality; each a list of [length, count], its size the first length.

    Without a number of groups each length is a group, and nothing is rounded up.
    """
    if n_groups is None:
        return [[[length, counts[length]]] for length in sorted(counts, reverse=True)]
    total = sum(counts.values())
    quota = max(1, -(-total // n_groups))
    groups: list[list[list[int]]] = [[]]
    left = quota
    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            take = min(n, left)
            groups[-1].append([length, take])
            n, left = n - take, left - take
            if not left:
                groups.append([])
                left = quota
    return [g for g in groups if g]


def _fill(sizes: list[int], counts: list[int], room: int) -> list[int]:
    """Indices of groups, repeats included, whose sizes fill the room best: a bounded subset sum over the few sizes."""
    mask, bits, steps = (1 << (room + 1)) - 1, 1, []  # bit t: t tokens can be filled exactly
    for g, (size, count) in enumerate(zip(sizes, counts)):
        for _ in range(min(count, room // size)):
            more = bits | (bits << size & mask)
            if more == bits:
                break
            steps.append((g, bits))
            bits = more
        if bits >> room:
            break
    at, out = bits.bit_length() - 1, []
    for g, before in reversed(steps):
        if not before >> at & 1:
            out.append(g)
            at -= sizes[g]
    return out


def _plan(histogram: dict[int, int], capacity: int, n_groups: int | None) -> _Plan:
    plan = _Plan()
    large = {k: v for k, v in histogram.items() if k > capacity * LARGE_SHARE}
    groups = _groups(large, n_groups)
    while groups:
        sizes, counts = [g[0][0] for g in groups], [sum(n for _, n in g) for g in groups]
        used = defaultdict(int, {0: 1})  # the largest size must go somewhere: it opens the configuration
        for g in _fill(sizes, [counts[0] - 1, *counts[1:]], capacity - sizes[0]):
            used[g] += 1
        times = min(counts[g] // m for g, m in used.items())
        classes = [(plan.n, times, 0)]
        plan.n += times
        for g, m in used.items():
            for _ in range(m):  # actual pieces take the place of the rounded ones
                split = []
                for base, many, fill in classes:
                    while many:
                        run = groups[g][0]
                        take = min(many, run[1])
                        plan.place(run[0], base, take, 1, fill)
                        split.append((base, take, fill + run[0]))
                        base, many, run[1] = base + take, many - take, run[1] - take
                        if not run[1]:
                            groups[g].pop(0)
                classes = split
        for base, many, fill in classes:
            plan.room[capacity - fill].append((base, many))
        groups = [g for g in groups if g]
    for length in sorted((k for k in histogram if k not in large), reverse=True):
        left = histogram[length]
        while left:
            free = min((r for r, c in plan.room.items() if r >= length and c), default=None)
            if free is None:
                each = capacity // length
                opened = -(-left // each)
                plan.room[capacity].append((plan.n, opened))
                plan.n += opened
                continue
            base, many = plan.room[free].pop()
            each = free // length
            full = min(many, left // each)
            if full:
                plan.place(length, base, full, each, capacity - free)
                plan.room[free - each * length].append((base, full))
                left -= full * each
            if full < many:
                rest = (base + full, many - full)
                if left and left < each:
                    plan.place(length, rest[0], 1, left, capacity - free)
                    plan.room[free - left * length].append((rest[0], 1))
                    rest, left = (rest[0] + 1, rest[1] - 1), 0
                if rest[1]:
                    plan.room[free].append(rest)
    return plan


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> _Plan:
    """The best of the plans for several numbers of groups. Its size follows the number of distinct lengths, not of pieces."""
    return min((_plan(histogram, capacity, k) for k in GROUP_COUNTS), key=lambda p: p.n)


def assign(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`found` (with a column length, and written somewhere: it is read more than once) with sequence_id and offset.

    A piece's slot is found from its rank among the pieces of its length. Ranks are made within salted shares of a
    length, plus the sizes of the shares before, so a length that most pieces have is not ranked in one task; there are
    as many shares as keep each of them small.
    """
    spark = found.sparkSession
    salts = max(MIN_SALTS, -(-found.count() // SHARE_ROWS))
    salted = found.withColumn("_salt", F.pmod(F.xxhash64(*found.columns), F.lit(salts)).cast("int"))
    shares = materialize(salted.groupBy("length", "_salt").agg(F.count("*").alias("_n")))
    histogram = {r.length: r.n for r in shares.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # at most `capacity` rows
    slots = plan(histogram, capacity).slots
    table = spark.createDataFrame(slots, "_length long, _first long, _base long, _many long, _each long, _at long")
    if len(slots) <= MAX_BROADCAST_SLOTS:
        table = F.broadcast(table)
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*[c for c in found.columns if c != "length"]))
    ranked = salted.withColumn("_rank", within - 1).join(shares, ["length", "_salt"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    fits = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_first") + F.col("_many") * F.col("_each"))
    step = F.col("_rank") - F.col("_first")
    return ranked.join(table, fits).select(
        *found.columns,
        (F.col("_base") + F.floor(step / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_at") + F.pmod(step, F.col("_each")) * F.col("length")).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, id_col: str = "doc_id", text: str = "text", ranks_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of every document: id_col, piece, start, length, ids_crc32, sequence_id, offset.

    Every row of `docs` is packed, repeated and null ids too. An empty table gives no rows.
    """
    return assign(materialize(pieces(docs, id_col, text, ranks_path, capacity)), capacity)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))

"""Rules that are sequential by their wording, without a sequential pass: time-to-live and rate limits as chains of successors.

Whether a row is accepted depends on which rows before it were. Two facts take that apart:

- A row with fewer than n rows of its key in the window before it is accepted whatever happened before: it is calm. After
  n calm rows in a row the last n accepted rows are known, so the stretches with other rows, busy ones, are independent.
- In a busy stretch the n places of a window are servers, each taken for one window by the row that it accepts; which of
  the free ones takes a row does not change how many are free. If the lowest free one does, the first server accepts its
  first row and then always the first row a window or more later; the second does the same with the rows left over; and
  so on. Each is a chain of successors from a known start, found by pointer doubling: rounds grow with the logarithm of
  the chain.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trafficloom.sources.scratch import Steps

from . import scan

#: A window is cut into so many cells for finding successors.
CELLS = 8


def _joined(left: DataFrame, right: DataFrame, names: list[str], how: str = "left", **pairs: str) -> DataFrame:
    """left with the other columns of right, where the columns `names` are equal, nulls too, and those of `pairs` (left's name, right's name)."""
    right = right.select(*[F.col(c).alias(f"_right{c}") if c in names else F.col(c) for c in right.columns])
    on = [F.col(c).eqNullSafe(F.col(f"_right{c}")) for c in names] + [F.col(a) == F.col(b) for a, b in pairs.items()]
    return left.join(right, reduce(lambda a, b: a & b, on), how).drop(*[f"_right{c}" for c in names])


def busy_times(df: DataFrame, key: str, ts: str, tiebreak: str, n: int, width: int, rows: int = scan.ROWS) -> DataFrame:
    """(_key, _period, _t, _busy, _before): the times of each key's busy stretches, with how many busy rows they have.

    _period: the time at which the stretch begins, which tells a key's stretches apart; one may begin at the time at which
    another ends. _before: at that time, an array of the times of the n rows before it, the latest first, null where there
    are none; they were all accepted. Keys with more than `rows` rows are cut into slices.
    """
    keys, order = ["_key"], ["_t", "_tie"]
    ids = df.select(F.col(key).alias("_key"), scan.micros(F.col(ts)).alias("_t"), F.col(tiebreak).alias("_tie")).withColumn("_at", F.timestamp_micros("_t"))
    around = scan.with_neighbours(scan.cut(ids, keys, "_at", rows), keys, order, back=2 * n)
    w = scan.slice_window(keys, order)
    earlier = F.array(*[F.lag("_t", k).over(w) for k in range(1, n + 1)])
    seen = around.withColumns({"_n": F.row_number().over(w), "_lags": earlier})
    seen = seen.withColumn("_is_calm", F.coalesce(F.col("_t") - F.element_at("_lags", n) >= width, F.lit(True)))
    quiet = F.col("_n") - F.max(F.when(~F.col("_is_calm"), F.col("_n"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    seen = seen.withColumn("_quiet", F.coalesce(quiet > n, F.lit(True)))  # the n rows before are calm
    seen = seen.withColumn("_start", F.when(~F.col("_is_calm") & F.col("_quiet"), F.col("_t"))).where("_own")
    carried = scan.with_carry(seen, keys, {"_start": "_open"})
    period = F.max(F.coalesce("_open", "_start")).over(w.rowsBetween(Window.unboundedPreceding, 0))
    own = carried.withColumn("_period", period).where(F.col("_own") & (~F.col("_is_calm") | ~F.col("_quiet")))
    return own.groupBy("_key", "_period", "_t").agg(F.count("*").alias("_busy"), F.max(F.when(F.col("_start").isNotNull(), F.col("_lags"))).alias("_before"))


def successors(nodes: DataFrame, keys: list[str], width: int, cell: int | None = None) -> DataFrame:
    """`nodes` (keys, _t) with _to: the first time of the keys at or after _t + width; null if there is none.

    Times are dealt to cells, so that one key is many tasks. A time is sought in the cell where it would be, and else is
    the first of the next cell that holds any; the cells of a key, in one task, are as many as its time has cells at most.
    """
    cell = cell or max(1, width // CELLS)
    place = lambda t: F.floor(t / F.lit(cell)).alias("_cell")
    own = nodes.select(*keys, F.col("_t").alias("_x"), F.lit(None).cast("long").alias("_from"), place(F.col("_t")))
    asked = nodes.select(*keys, (F.col("_t") + width).alias("_x"), F.col("_t").alias("_from"), place(F.col("_t") + width))
    both = own.unionByName(asked)
    is_node = F.when(F.col("_from").isNull(), F.col("_x"))
    down = Window.partitionBy(*keys, "_cell").orderBy(F.col("_x").desc(), F.col("_from").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_here", F.min(is_node).over(down)).where(F.col("_from").isNotNull())
    later = Window.partitionBy(*keys).orderBy(F.col("_cell").desc()).rowsBetween(Window.unboundedPreceding, -1)
    cells = both.groupBy(*keys, "_cell").agg(F.min(is_node).alias("_first")).withColumn("_next", F.min("_first").over(later))
    return _joined(found, cells, [*keys, "_cell"]).select(*keys, F.col("_from").alias("_t"), F.coalesce("_here", "_next").alias("_to"))


def reached(nodes: DataFrame, keys: list[str], steps: Steps) -> DataFrame:
    """(keys, _t, _mark): the times that the chain of successors meets from those whose _mark is set in `nodes` (keys, _t, _to, _mark).

    Each round marks what the marked times point to and doubles the pointers: after k rounds the first 2^k times of every
    chain are marked. Each round's table is written, and the one before it deleted.
    """
    at, more = steps.write_and_ask(nodes.select(*keys, "_t", "_to", "_mark"), F.col("_mark") & F.col("_to").isNotNull())
    while more:
        there = at.select(*keys, F.col("_t").alias("_t2"), F.col("_to").alias("_to2"))
        hop = _joined(at, there, keys, _to="_t2").select(*keys, "_t", F.col("_to2").alias("_to"), "_mark")
        met = at.where("_mark").select(*keys, F.col("_to").alias("_t"), F.lit(True).alias("_met")).where(F.col("_t").isNotNull()).distinct()
        marked = _joined(hop, met, [*keys, "_t"]).select(*keys, "_t", "_to", (F.col("_mark") | F.col("_met").isNotNull()).alias("_mark"))
        at, more = steps.write_and_ask(marked, F.col("_mark") & F.col("_to").isNotNull())
        steps.forget(steps.last - 1)
    return at.select(*keys, "_t", "_mark")


def rejected_times(df: DataFrame, key: str, ts: str, tiebreak: str, n: int, width: int, rows: int = scan.ROWS) -> DataFrame:
    """(_key, _t, _rejected): the times of each key at which rows are not accepted, and how many; a written table."""
    steps, keys = Steps(df.sparkSession), ["_key", "_period"]
    left = steps.write(busy_times(df, key, ts, tiebreak, n, width, rows))
    for k in range(n):
        before = left.where(F.col("_before").isNotNull()).select(*keys, F.get("_before", F.lit(k)).alias("_since"))
        open_ = left.where(F.col("_busy") > 0).select(*keys, "_t")
        timed = _joined(open_, before, keys)
        first = timed.where(F.col("_since").isNull() | (F.col("_t") - F.col("_since") >= width)).groupBy(*keys).agg(F.min("_t").alias("_first"))
        linked = _joined(successors(open_, keys, width), first, keys).withColumn("_mark", F.coalesce(F.col("_t") == F.col("_first"), F.lit(False)))
        first_step = steps.last
        took = reached(linked, keys, steps).where("_mark")
        one = F.coalesce(F.col("_mark"), F.lit(False)).cast("int")
        left = steps.write(_joined(left, took, [*keys, "_t"]).select(*keys, "_t", "_before", (F.col("_busy") - one).alias("_busy")))
        steps.forget(first_step, steps.last - 1)
    return left.where(F.col("_busy") > 0).groupBy("_key", "_t").agg(F.sum("_busy").alias("_rejected"))


def _judged(df: DataFrame, rejected: DataFrame, key: str, tiebreak: str) -> DataFrame:
    """`df` (with _at) and _accepted. Of the rows of one key and time the last are those not accepted: a rejected row leaves all as it was."""
    numbered = df.withColumn("_n", F.row_number().over(Window.partitionBy(key, "_at").orderBy(F.col(tiebreak).desc())))
    met = numbered.join(rejected, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_at") == F.col("_t")), "left")
    return met.withColumn("_accepted", F.col("_at").isNotNull() & (F.col("_n") > F.coalesce("_rejected", F.lit(0))))


def dedup_ttl(df: DataFrame, key: str = "id", ts: str = "reported_at", ttl_s: int = 1800, tiebreak: str = "event_id", rows: int = scan.ROWS) -> DataFrame:
    """Rows that do not come within the time to live of the last row kept of their key. Rows without a key or a time go.

    One place that is taken for the time to live: see the module. Of rows of one key and time the first by tiebreak may be kept.
    """
    known = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    rejected = rejected_times(known, key, ts, tiebreak, 1, ttl_s * 1_000_000, rows)
    return _judged(known.withColumn("_at", scan.micros(F.col(ts))), rejected, key, tiebreak).where("_accepted").select(*df.columns)


def rate_limit_chains(df: DataFrame, key: str, ts: str, n: int, window_s: float, tiebreak: str, rows: int = scan.ROWS) -> DataFrame:
    """`df` with accepted, by n chains; see the module. Rows without a time are not accepted; a null key is a key."""
    rejected = rejected_times(df.where(F.col(ts).isNotNull()), key, ts, tiebreak, n, int(window_s * 1_000_000), rows)
    return _judged(df.withColumn("_at", scan.micros(F.col(ts))), rejected, key, tiebreak).select(*df.columns, F.col("_accepted").alias("accepted"))

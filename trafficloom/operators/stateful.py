"""Batch twins of the stateful rules: dedup in buckets, dwelling, expiry, rate limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scan
from .chains import dedup_ttl, rate_limit_chains  # noqa: F401

#: A rate limit of more rows takes a pass over each busy key instead of a chain for each place.
CHAINS = 8
RESIDENT_AFTER = "15 minutes"


def dedup_bucketed(df: DataFrame, keys: list[str], ts: str = "event_time", bucket: str = "10 seconds", tiebreak: str = "event_id") -> DataFrame:
    """The first row of each key and time bucket, by a minimum that is aggregated before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys, F.window(ts, bucket)["start"].alias("_bucket")).agg(F.min_by(F.struct(*rest), F.struct(ts, tiebreak)).alias("_row"))
    return first.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def _stays(rows: DataFrame, keys: list[str], tower: str, ts: str, tiebreak: str) -> DataFrame:
    """`rows` with _new (another tower than the row before, within the slice) and _since (the first time of the stay)."""
    w = scan.slice_window(keys, [ts, tiebreak])
    rows = rows.withColumn("_new", (~F.lag(tower).over(w).eqNullSafe(F.col(tower)) | F.lag(F.lit(1)).over(w).isNull()).cast("int"))
    rows = rows.withColumn("_stay", F.sum("_new").over(w))
    return rows.withColumn("_since", F.min(ts).over(Window.partitionBy(*keys, "_slice", "_stay")))


def _open_stays(cut: DataFrame, keys: list[str], tower: str, ts: str, tiebreak: str) -> DataFrame:
    """(keys, _slice, tower, ts): at which tower a key is when a slice begins, and since when.

    A slice is summed up as its first and last tower, its number of stays and the start of its last one. A slice of one
    stay at the tower before it goes on with that stay, however many slices long.
    """
    at = F.struct(ts, tiebreak)
    own = _stays(cut.where(F.col("_slice") > 0), keys, tower, ts, tiebreak)
    sums = own.groupBy(*keys, "_slice").agg(F.min_by(tower, at).alias("_first"), F.max_by(tower, at).alias("_last"), F.max_by("_since", at).alias("_since"), F.sum("_new").alias("_stays"))
    along = Window.partitionBy(*keys).orderBy("_slice")
    before = F.lag("_slice").over(along).isNotNull()
    goes_on = before & (F.col("_stays") == 1) & F.lag("_last").over(along).eqNullSafe(F.col("_first"))
    sums = sums.withColumn("_block", F.count_if(~goes_on).over(along)).withColumn("_before", before)
    sums = sums.withColumn("_since", F.min("_since").over(Window.partitionBy(*keys, "_block").orderBy("_slice")))
    carry = sums.select(*keys, "_slice", "_before", F.lag("_last").over(along).alias(tower), F.lag("_since").over(along).alias(ts))
    return carry.where("_before").drop("_before")


def flag_residential(df: DataFrame, device: str = "device_id_hash", tower: str = "tower_id", ts: str = "timestamp", tiebreak: str = "event_id", where: Column | None = None, after: str = RESIDENT_AFTER, rows: int = scan.ROWS) -> DataFrame:
    """`df` with residential: the device has been at this tower, without another between, for `after` or longer.

    Rows that do not meet `where` neither count nor are flagged. A device with more than `rows` rows is cut into slices,
    to each of which the stay that is open before it is carried.
    """
    keys = [device, "_in"]
    cut = scan.cut(df.withColumn("_in", where if where is not None else F.lit(True)), keys, ts, rows)
    stays = _stays(scan.with_context(cut, _open_stays(cut, keys, tower, ts, tiebreak)), keys, tower, ts, tiebreak)
    flag = F.col("_in") & (F.col(ts) >= F.col("_since") + F.expr(f"INTERVAL {after}"))
    return stays.where("_own").select(*df.columns, flag.alias("residential"))


def dwell_anchor(df: DataFrame, step: str = "30 seconds", n: int = 3, threshold: float = 5.0, mode: str = "any", segment: str = "road_segment_id", ts: str = "event_time", speed: str = "avg_speed_kmh", out: str = "incident_flag", rows: int = scan.ROWS) -> DataFrame:
    """`df` with `out`: the row is one of n windows of its segment exactly a step apart, all slow; no speed counts as slow.

    mode "latest": only a segment's last n windows are looked at. A segment with more than `rows` rows is cut into slices,
    each given the rows on either side that it looks at.
    """
    around = scan.with_neighbours(scan.cut(df, [segment], ts, rows), [segment], [ts], back=n - 1, forward=n if mode == "latest" else n - 1)
    w = scan.slice_window([segment], [ts])
    width = F.expr(f"INTERVAL {step}")
    slow = F.coalesce(F.col(speed), F.lit(0.0)) < threshold
    marked = around.withColumn("_slow", slow).withColumn("_next", F.coalesce(F.col(ts) == F.lag(ts).over(w) + width, F.lit(False)))
    run = F.lit(True)
    for k in range(n):
        run = run & F.coalesce(F.lag("_slow", k).over(w), F.lit(False))
        if k < n - 1:
            run = run & F.coalesce(F.lag("_next", k).over(w), F.lit(False))
    marked = marked.withColumn("_run", run)  # a run ends here
    if mode == "latest":
        marked = marked.withColumn("_run", F.col("_run") & F.lead(ts).over(w).isNull())
    return marked.withColumn(out, F.max("_run").over(w.rowsBetween(0, n - 1))).where("_own").select(*df.columns, out)


def _fold(df: DataFrame, key: str, ts: str, tiebreak: str, schema, step) -> DataFrame:
    """Runs `step(state, key, micros) -> (state, flag)` over each key's rows in order of time and tiebreak; `df` with the flags of the rows.

    A task reads its keys sorted, batch by batch, and carries one key's state from batch to batch: however many rows a key
    has, a task holds one batch and that state.
    """
    import numpy as np
    import pyarrow as pa

    flag = schema[-1].name
    rows = df.select("*", F.col(key).alias("_k"), scan.micros(F.col(ts)).alias("_t")).repartition(key).sortWithinPartitions(F.col("_k"), F.col("_t").asc_nulls_last(), F.col(tiebreak))

    def run(batches):
        state, last = None, object()
        for b in batches:
            keys, times = b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist()
            out = np.zeros(len(keys), bool)
            for k, (own, t) in enumerate(zip(keys, times)):
                if own != last:
                    state, last = None, own
                state, out[k] = step(state, t)
            yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(out)], names=[*b.schema.names[:-2], flag])

    return rows.mapInArrow(run, schema)


def rate_limit(df: DataFrame, key: str, ts: str, n: int = 100, window_s: float = 60.0, tiebreak: str = "event_id", rows: int = scan.ROWS) -> DataFrame:
    """`df` with accepted: fewer than n accepted rows of the key came in the window before it. Rows without a time are not accepted.

    Up to CHAINS rows a window are found by chains of successors, without a sequential pass (see `chains`). For larger
    limits that would be too many rounds: rows are folded in order, with the times of at most n accepted rows as the state.
    """
    df = df.drop("accepted")
    if n <= CHAINS:
        return rate_limit_chains(df, key, ts, n, window_s, tiebreak, rows)
    from collections import deque

    from pyspark.sql import types as T

    width = int(window_s * 1_000_000)

    def step(taken, t):
        taken = deque() if taken is None else taken
        if t is None:
            return taken, False
        while taken and t - taken[0] >= width:
            taken.popleft()
        accepted = len(taken) < n
        if accepted:
            taken.append(t)
        return taken, accepted

    return _fold(df, key, ts, tiebreak, T.StructType([*df.schema, T.StructField("accepted", T.BooleanType())]), step)

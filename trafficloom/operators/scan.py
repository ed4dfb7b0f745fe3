"""Windows over keys of any size: a hot key's rows are cut into time slices, and a slice is given what it needs of the others.

A window by (key, `_slice`) over what `with_neighbours`, `with_carry` or `with_context` return sees the rows that the window by
key would need, so a key with very many rows is many tasks. Only summaries of slices, a few rows each, meet in one task by key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A key with more rows is cut.
ROWS = 1_000_000
UNIT_S = 3600


def micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def cut(df: DataFrame, keys: list[str], ts: str, rows: int = ROWS, unit_s: int = UNIT_S) -> DataFrame:
    """`df` with _slice: 0 for keys of up to `rows` rows; larger keys are cut between units of time into slices of about `rows`.

    Rows are counted by key and unit first; the slices of the large keys are joined to them. A slice has no more than
    `rows` rows and those of one unit. Rows without a time come first, as in a window's order.
    """
    unit = F.coalesce(F.floor(micros(F.col(ts)) / (unit_s * 1_000_000)), F.lit(-(1 << 62)))
    placed = df.withColumn("_unit", unit)
    counts = placed.groupBy(*keys, "_unit").agg(F.count("*").alias("_n"))
    own, before = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("_unit").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns({"_all": F.sum("_n").over(own), "_before": F.coalesce(F.sum("_n").over(before), F.lit(0))})
    names = [f"_key{i}" for i in range(len(keys))]
    large = counts.where(F.col("_all") > rows).select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("_unit").alias("_cut_at"), (F.floor(F.col("_before") / rows) + 1).alias("_slice"))
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)], F.col("_unit") == F.col("_cut_at"))
    return placed.join(large, on, "left").select(*df.columns, F.coalesce("_slice", F.lit(0)).cast("long").alias("_slice"))


def slice_window(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys, "_slice").orderBy(*order)


def with_neighbours(rows: DataFrame, keys: list[str], order: list[str], back: int = 1, forward: int = 0) -> DataFrame:
    """The rows of `cut` with _own, true, and as further rows for each slice, _own false, the `back` rows before and the `forward` rows after it.

    The rows at the edges of slices are found by a limit within groups, which Spark applies before the shuffle too.
    """
    out, own = rows.withColumn("_own", F.lit(True)), rows.where(F.col("_slice") > 0)
    given_cols = [c for c in rows.columns if c != "_slice"]
    along = Window.partitionBy(*keys).orderBy("_slice", *order)
    for n, sort, beyond, first, last in ((back, F.desc, F.lag, -back, -1), (forward, F.asc, F.lead, 1, forward)):
        if not n:
            continue
        edge = own.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(*map(sort, order)))).where(F.col("_n") <= n)
        given = edge.withColumns({"_given": F.collect_list(F.struct(*given_cols)).over(along.rowsBetween(first, last)), "_end": beyond("_slice").over(along)})
        given = given.where(F.col("_end").isNull() | (F.col("_end") != F.col("_slice"))).select("_slice", F.explode("_given").alias("_g"))
        out = out.unionByName(given.select(*[F.col("_g")[c].alias(c) for c in given_cols], "_slice", F.lit(False).alias("_own")))
    return out


def with_context(rows: DataFrame, context: DataFrame) -> DataFrame:
    """`rows` (with or without _own) and the rows of `context` (keys, _slice and any columns), _own false; columns that either lacks are null."""
    rows = rows if "_own" in rows.columns else rows.withColumn("_own", F.lit(True))
    return rows.unionByName(context.withColumn("_own", F.lit(False)), allowMissingColumns=True)


def with_carry(rows: DataFrame, keys: list[str], maxima: dict[str, str]) -> DataFrame:
    """`rows` and a row without a time for each slice: in column maxima[c] the greatest value of column c in the key's slices before it."""
    own = rows.where((F.col("_slice") > 0) & (F.col("_own") if "_own" in rows.columns else F.lit(True)))
    sums = own.groupBy(*keys, "_slice").agg(*[F.max(c).alias(to) for c, to in maxima.items()])
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select(*keys, "_slice", *[F.max(to).over(before).alias(to) for to in maxima.values()])
    return with_context(rows, carry.where(reduce(lambda a, b: a | b, [F.col(to).isNotNull() for to in maxima.values()])))

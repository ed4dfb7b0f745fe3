"""Cells that adapt to the points in them: a quadtree of counts, whose crowded cells are split and whose sparse ones stay joined.

A cell of level l is size / 2^l degrees wide and named by whole numbers, so a cell's parent is a shift. Points and boxes
are dealt to the same leaves by one join with the crowded cells, which are few by their definition; neither is shuffled
for it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from trafficloom.sources import scratch

#: A cell with more points than this is split, and at the last level cut into shares of about so many.
MOST = 2_000
#: There are at most so many crowded cells of a level: beyond, a leaf may hold this part of all points.
CROWDED = 100_000
#: Columns of the crowded cells.
CROWD = "_bx long, _by long, _in array<struct<_l: int, _x: long, _y: long, _n: long>>"


@dataclass(frozen=True)
class Cells:
    """crowded: (_bx, _by, _in) for every crowded cell of level 0, where _in is an array of the crowded cells in it, itself
    included: (_l, _x, _y, _n). At most CROWDED cells of each level, so small enough to broadcast."""

    crowded: DataFrame
    size: float
    levels: int
    most: int

    def finest(self, degrees: Column) -> Column:
        """Number of the last level's cell along one axis."""
        return F.floor(degrees / (self.size / 2**self.levels))

    def width(self) -> Column:
        """Width in degrees of the cell _l, _x, _y."""
        return F.lit(self.size) / F.pow(F.lit(2.0), F.col("_l"))

    def _beside(self, rows: DataFrame, x: Column, y: Column) -> DataFrame:
        return rows.join(F.broadcast(self.crowded), (x == F.col("_bx")) & (y == F.col("_by")), "left").drop("_bx", "_by")

    def _shares(self, n: Column) -> Column:
        return F.greatest(F.ceil(F.coalesce(n, F.lit(1)) / F.lit(self.most)).cast("int"), F.lit(1))

    def deal_points(self, points: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
        """`points` with the leaf _l, _x, _y they lie in and _share, one of the shares of a leaf that can't be split any more.

        Points without a place have null cells. Shares go by a hash of the row (but for maps), so a row that is computed
        again comes to the same share, and rows that are equal in everything meet in one.
        """
        hashed = [F.col(c) for c, t in points.dtypes if "map<" not in t]
        rows = points.withColumns({"_fx": self.finest(F.col(lon)), "_fy": self.finest(F.col(lat))})
        rows = self._beside(rows, F.shiftright("_fx", self.levels), F.shiftright("_fy", self.levels))
        at = lambda c: F.lit(self.levels) - c["_l"]
        own = lambda c: (F.call_function("shiftright", F.col("_fx"), at(c)) == c["_x"]) & (F.call_function("shiftright", F.col("_fy"), at(c)) == c["_y"])
        # the crowded cells around a point are one of each level down to the last
        rows = rows.withColumn("_on", F.when(F.col("_in").isNotNull(), F.filter("_in", own)))
        last = F.array_max(F.transform(F.filter("_on", lambda c: c["_l"] == self.levels), lambda c: c["_n"]))
        rows = rows.withColumns({"_l": F.when(F.col("_on").isNull(), F.lit(0)).otherwise(F.least(F.size("_on"), F.lit(self.levels))), "_share": F.when(F.col("_on").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(*hashed), self._shares(last)).cast("int"))})
        up = lambda c: F.expr(f"shiftright({c}, {self.levels} - _l)")
        return rows.withColumns({"_x": up("_fx"), "_y": up("_fy")}).drop("_fx", "_fy", "_in", "_on")

    def deal_boxes(self, rows: DataFrame, x0: Column, y0: Column, x1: Column, y1: Column) -> DataFrame:
        """`rows` once for every leaf that the box x0, y0, x1, y1 in degrees touches, with _l, _x, _y and the number of its _shares."""
        out = rows.withColumns(dict(zip(("_fx0", "_fy0", "_fx1", "_fy1"), map(self.finest, (x0, y0, x1, y1)))))
        base = lambda c: F.shiftright(c, self.levels)
        out = out.withColumn("_bx0", F.explode(F.sequence(base("_fx0"), base("_fx1")))).withColumn("_by0", F.explode(F.sequence(base("_fy0"), base("_fy1"))))
        out = self._beside(out, F.col("_bx0"), F.col("_by0"))
        cell = lambda level, x, y, shares: F.struct(level.alias("_l"), x.alias("_x"), y.alias("_y"), shares.alias("_shares"))

        def leaves(c):
            parts = F.array(*[cell(c["_l"] + 1, c["_x"] * 2 + dx, c["_y"] * 2 + dy, F.lit(1)) for dx in (0, 1) for dy in (0, 1)])
            open_ = F.filter(parts, lambda p: ~F.exists("_in", lambda o: (o["_l"] == p["_l"]) & (o["_x"] == p["_x"]) & (o["_y"] == p["_y"])))
            return F.when(c["_l"] < self.levels, open_).otherwise(F.array(cell(c["_l"], c["_x"], c["_y"], self._shares(c["_n"]))))

        def touched(c):
            up = lambda k: F.call_function("shiftright", F.col(k), F.lit(self.levels) - c["_l"])
            return c["_x"].between(up("_fx0"), up("_fx1")) & c["_y"].between(up("_fy0"), up("_fy1"))

        split = F.filter(F.flatten(F.transform("_in", leaves)), touched)
        whole = F.array(cell(F.lit(0), F.col("_bx0"), F.col("_by0"), F.lit(1)))
        return out.withColumn("_c", F.explode(F.when(F.col("_in").isNull(), whole).otherwise(split))).select(*rows.columns, "_c.*")

    def shared(self, rows: DataFrame) -> DataFrame:
        """`rows` of leaves, once for every share (_share)."""
        return rows.withColumn("_share", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1))).drop("_shares")


def adaptive(points: DataFrame, size: float, levels: int = 3, most: int = MOST, lon: str = "lon", lat: str = "lat") -> Cells:
    """The cells for `points`. They are counted by the last level's cells before anything is shuffled; the counts of the
    levels above are sums of these. With no points, or few in every cell, no cell is crowded and all leaves are of level 0.
    So they are for a stream, whose points cannot be counted before they come."""
    if not 0 <= levels <= 6:
        raise ValueError("levels must be 0 to 6")
    if points.isStreaming:
        return Cells(points.sparkSession.createDataFrame([], CROWD), size, levels, most)
    steps, seen = scratch.Steps(points.sparkSession), Observation()
    fine = size / 2**levels
    counts = points.groupBy(F.floor(F.col(lon) / fine).alias("_x"), F.floor(F.col(lat) / fine).alias("_y")).agg(F.count("*").alias("_n")).where("_x is not null and _y is not null")
    counts = steps.write(counts.observe(seen, F.coalesce(F.sum("_n"), F.lit(0)).alias("n")))
    most = max(most, -(-seen.get["n"] // CROWDED))
    above = counts.select(F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("_l"), "_x", "_y", "_n")
    up = lambda c, at: F.expr(f"shiftright({c}, {at})").alias(c)
    sums = above.groupBy("_l", up("_x", f"{levels} - _l"), up("_y", f"{levels} - _l")).agg(F.sum("_n").alias("_n")).where(F.col("_n") > most)
    crowded = steps.write(sums.groupBy(F.expr("shiftright(_x, _l)").alias("_bx"), F.expr("shiftright(_y, _l)").alias("_by")).agg(F.collect_list(F.struct("_l", "_x", "_y", "_n")).alias("_in")))
    steps.forget(1)
    return Cells(crowded, size, levels, most)

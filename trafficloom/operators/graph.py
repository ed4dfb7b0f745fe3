"""Road adjacency and the speeds of neighbouring segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENT = "road_segment_id"


def adjacency(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((road_segment_id, upstream_id), (road_segment_id, downstream_id)); a road without neighbours has one row with null."""
    own = edges.select(F.col("id").cast("long").alias(SEGMENT), "from_node_id", "to_node_id")
    up = edges.select(F.col("id").cast("long").alias("upstream_id"), F.col("to_node_id").alias("_node"))
    down = edges.select(F.col("id").cast("long").alias("downstream_id"), F.col("from_node_id").alias("_node"))
    return (
        own.join(up, own.from_node_id == up._node, "left").select(SEGMENT, "upstream_id"),
        own.join(down, own.to_node_id == down._node, "left").select(SEGMENT, "downstream_id"),
    )


def neighbour_speeds(df: DataFrame, edges: DataFrame, mode: str = "aligned", ts: str = "event_time", speed: str = "avg_speed_kmh") -> DataFrame:
    """`df` with upstream_speed_kmh and downstream_speed_kmh.

    "aligned": the mean over the neighbours at the row's time, one row per input row. "raw": every pair of an upstream
    and a downstream observation of any time. Observations are as many as the events, so they are never broadcast.
    """
    if mode not in ("aligned", "raw"):
        raise ValueError(f"unknown mode: {mode}")
    out = df
    for side, near in zip(("upstream", "downstream"), adjacency(edges)):
        near = near.where(F.col(f"{side}_id").isNotNull())
        seen = df.select(F.col(SEGMENT).alias("_seen"), F.col(ts).alias("_at"), F.col(speed).alias("_speed"))
        pairs = near.withColumnRenamed(SEGMENT, "_own").join(seen, F.col(f"{side}_id") == F.col("_seen"), "inner" if mode == "aligned" else "left")
        if mode == "aligned":
            means = pairs.groupBy("_own", "_at").agg(F.avg("_speed").alias(f"{side}_speed_kmh"))
            out = out.join(means, (F.col(SEGMENT) == F.col("_own")) & (F.col(ts) == F.col("_at")), "left").drop("_own", "_at")
        else:
            rows = pairs.select("_own", F.col("_speed").alias(f"{side}_speed_kmh"))
            out = out.join(rows, F.col(SEGMENT) == F.col("_own"), "left").drop("_own")
    return out


def neighbour_summary(df: DataFrame, edges: DataFrame, speed: str = "avg_speed_kmh") -> DataFrame:
    """`df` with n_pairs, upstream_speed_kmh and downstream_speed_kmh: what `neighbour_speeds` in mode "raw" makes of each row, summed up.

    n_pairs is the number of its rows (a side without observations counts as one), the speeds are their means. Each
    side is summed per segment before it meets the rows, so nothing is multiplied out.
    """
    seen = df.groupBy(F.col(SEGMENT).alias("_seen")).agg(F.count("*").alias("_n"), F.count(speed).alias("_m"), F.sum(speed).alias("_s"))
    out, pairs = df, F.lit(1)
    for side, near in zip(("upstream", "downstream"), adjacency(edges)):
        near = near.where(F.col(f"{side}_id").isNotNull()).join(seen, F.col(f"{side}_id") == F.col("_seen"), "left")
        sums = near.groupBy(F.col(SEGMENT).alias("_own")).agg(F.sum(F.coalesce("_n", F.lit(1))).alias(f"_n_{side}"), (F.sum("_s") / F.nullif(F.sum("_m"), F.lit(0))).alias(f"{side}_speed_kmh"))
        out = out.join(sums, F.col(SEGMENT) == F.col("_own"), "left").drop("_own")
        pairs = pairs * F.coalesce(f"_n_{side}", F.lit(1))
    return out.withColumn("n_pairs", pairs).drop("_n_upstream", "_n_downstream")

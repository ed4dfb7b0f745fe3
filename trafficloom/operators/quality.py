"""Checks of tables: one report row per check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficloom import schemas as S
from trafficloom.sources.scratch import Steps

from .windows import segment_congestion_daily, segment_traffic_5min

MIN_EDGES = 1000
REPORT = "check_name string, n_failed long"


def check_rows(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check_name, n_failed): rows that do not meet each condition, null counting as not; one pass for all checks."""
    counts = df.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(f"c{k}") for k, c in enumerate(checks.values())])
    pairs = ", ".join(f"'{name}', c{k}" for k, name in enumerate(checks))
    return counts.selectExpr(f"stack({len(checks)}, {pairs}) as (check_name, n_failed)")


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return check_rows(df, {f"not_null_{c}": F.col(c).isNotNull() for c in cols})


def check_expression(df: DataFrame, name: str, expr: str) -> DataFrame:
    return check_rows(df, {name: F.expr(expr)})


def check_accepted(df: DataFrame, col: str, values: tuple) -> DataFrame:
    return check_rows(df, {f"accepted_{col}": F.col(col).isin(*values)})


def check_relationship(df: DataFrame, col: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose value is not a key of the parent; null values are left to check_not_null."""
    orphans = df.where(F.col(col).isNotNull()).join(parent.select(F.col(key).alias("_key")), F.col(col) == F.col("_key"), "left_anti")
    return orphans.agg(F.count("*").alias("n_failed")).select(F.lit(f"relationship_{col}").alias("check_name"), "n_failed")


def check_min_rows(df: DataFrame, n: int = MIN_EDGES, name: str = "min_rows") -> DataFrame:
    return df.agg(F.when(F.count("*") < n, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("n_failed")).select(F.lit(name).alias("check_name"), "n_failed")


def quality_report(silver: DataFrame, edges: DataFrame) -> DataFrame:
    """All checks of the five-minute table and the road table."""
    rows = {f"not_null_{c}": F.col(c).isNotNull() for c in ("road_segment_id", "event_time", "congestion_score", "congestion_level")}
    rows |= {"score_in_range": F.col("congestion_score").between(0, 1), "accepted_congestion_level": F.col("congestion_level").isin(*S.CONGESTION_LEVELS)}
    parts = [check_rows(silver, rows), check_relationship(silver, "road_segment_id", edges, "id"), check_min_rows(edges, name="min_edges")]
    return reduce(DataFrame.unionByName, parts)


def with_limits(report: DataFrame, limits: dict[str, tuple[int | None, int | None]] | None = None) -> DataFrame:
    """`report` with status: "error" or "warn" if more rows fail than the check's limits allow, else "pass".

    limits: by check, the failures above which it warns and above which it is an error (None: never). A check without
    limits is an error from its first failure.
    """
    warn, error = F.lit(0), F.lit(0)
    for name, (low, high) in (limits or {}).items():
        warn = F.when(F.col("check_name") == name, F.lit(low)).otherwise(warn)
        error = F.when(F.col("check_name") == name, F.lit(high)).otherwise(error)
    status = F.when(F.col("n_failed") > error, "error").when(F.col("n_failed") > warn, "warn").otherwise("pass")
    return report.withColumn("status", status)


def refresh(events: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(silver, gold, report): the models, then their checks. The five-minute table is written once and read by the others; `operators.refresh` publishes tables."""
    silver = Steps(events.sparkSession).write(segment_traffic_5min(events, edges))
    return silver, segment_congestion_daily(silver), quality_report(silver, edges)

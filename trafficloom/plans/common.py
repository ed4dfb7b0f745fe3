"""What the query modules share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def registry():
    """(queries, SQL twins, decorator that registers a function under its name with its SQL)."""
    queries, oracles = {}, {}

    def query(sql: str | None = None):
        def add(fn):
            queries[fn.__name__] = fn
            if sql is not None:
                oracles[fn.__name__] = sql
            return fn

        return add

    return queries, oracles, query


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to some places: sums of the two engines differ in the last digits."""
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])

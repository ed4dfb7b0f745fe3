"""Counters of streams: how many rows of each outcome a micro-batch had, written by a listener; and what a stream's state holds."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

_PREFIX = "outcomes:"
_OTHER = "other"
SCHEMA = "query string, batch long, source string, outcome string, n_rows long"


def counted(df: DataFrame, source: str, outcomes: tuple[str, ...], column: str = "outcome") -> DataFrame:
    """`df`, whose rows are counted by outcome as they pass, without a pass of their own. Outcomes besides those given count as "other"."""
    known = F.col(column).isin(*outcomes)
    counts = [F.count_if(F.col(column) == o).alias(o) for o in outcomes] + [F.count_if(~F.coalesce(known, F.lit(False))).alias(_OTHER)]
    return df.observe(f"{_PREFIX}{source}", *counts)


class CounterLog(StreamingQueryListener):
    """Writes the counts of each micro-batch of the streams that are `counted` as one file below a folder; a batch that runs again replaces its file."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__()
        self._spark, self._root = spark, root.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        lines = [
            json.dumps({"query": str(p.id), "batch": p.batchId, "source": name.removeprefix(_PREFIX), "outcome": outcome, "n_rows": n})
            for name, row in p.observedMetrics.items() if name.startswith(_PREFIX)
            for outcome, n in row.asDict().items() if n
        ]
        if lines:
            where = self._spark._jvm.org.apache.hadoop.fs.Path(f"{self._root}/{p.id}-{p.batchId}.json")
            out = where.getFileSystem(self._spark._jsc.hadoopConfiguration()).create(where, True)
            out.write("\n".join(lines).encode())
            out.close()

    def __enter__(self) -> CounterLog:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self._spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)  # the last batches' events
        self._spark.streams.removeListener(self)


def read_counters(spark: SparkSession, root: str) -> DataFrame:
    """(query, batch, source, outcome, n_rows) of all micro-batches."""
    return spark.read.schema(SCHEMA).json(root)


def state_left(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """What a stateful operator of a stream still holds as of its last batch: the columns of its keys, then those of its values."""
    rows = spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator).load()
    return rows.select("key.*", *[F.col(f"value.{c}").alias(f"value_{c}") for c in rows.schema["value"].dataType.names])

"""Tables that cut lineage, in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_own: dict[int, str] = {}


def root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where none is named, a temporary one in local mode. A cluster must name one."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or _own.get(0)
    if not shared:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        shared = _own[0] = tempfile.mkdtemp(prefix="spark-")
    return shared


def folder(spark: SparkSession, kind: str) -> str:
    return f"{root(spark)}/{kind}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class Steps:
    """Writes the tables of an iteration and deletes those that are no longer read."""

    def __init__(self, spark: SparkSession):
        self._spark, self._at = spark, folder(spark, "steps")
        self._n = 0

    def write(self, df: DataFrame) -> DataFrame:
        self._n += 1
        df.write.parquet(f"{self._at}/{self._n}")
        return self._spark.read.schema(df.schema).parquet(f"{self._at}/{self._n}")

    def write_and_ask(self, df: DataFrame, condition: Column) -> tuple[DataFrame, bool]:
        """The written table, and whether any of its rows meets the condition, which the write itself finds out."""
        seen = Observation()
        out = self.write(df.observe(seen, F.count_if(condition).alias("n")))
        return out, seen.get["n"] > 0

    def forget(self, *numbers: int) -> None:
        for k in numbers:
            delete(self._spark, f"{self._at}/{k}")

    @property
    def last(self) -> int:
        return self._n

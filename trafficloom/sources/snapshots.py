"""Published tables: data folders that never change, and versions that name them. A reader sees one version, whole."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sinks import merge_latest

_PART = "_part"


class Conflict(RuntimeError):
    """Another writer has published since the version that a change was made from."""


class SnapshotStore:
    """Tables below one folder, published together.

    data/<id>/_part=<value>/ holds the files of a table's part and is never rewritten; versions/<number>.json names the
    folder of every part of every table, and which batches are in. A version appears by one rename of a finished file, and
    only if no other has its number; the newest number is the current version. The parts of a table are its dates, say, so
    that versions stay small.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self._root, self._jvm = spark, root.rstrip("/"), spark._jvm
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, under: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self._root}/{under}" if under else self._root)

    def _names(self, under: str) -> list[str]:
        where = self._path(under)
        return [x.getPath().getName() for x in self._fs.listStatus(where)] if self._fs.exists(where) else []

    def versions(self) -> list[int]:
        return sorted(int(x.removesuffix(".json")) for x in self._names("versions") if x[0].isdigit())

    def current(self, version: int | None = None) -> dict:
        """The newest version, or the one asked for: its number, tables, and the newest batch of each stream."""
        known = self.versions()
        if not known:
            return {"version": 0, "tables": {}, "batches": {}}
        source = self._fs.open(self._path(f"versions/{version or known[-1]:012d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
        finally:
            source.close()

    def stage(self, df: DataFrame, part: str | None = None) -> dict:
        """Writes rows that no version names yet: their schema, and the folder of each value of the column `part`."""
        at = f"data/{uuid.uuid4().hex}"
        if part is None:
            df.write.parquet(f"{self._root}/{at}")
            return {"schema": df.schema.jsonValue(), "parts": {"": at}}
        rows = df.where(F.col(part).isNotNull()).withColumn(_PART, F.col(part).cast("string"))
        rows.repartition(_PART).write.partitionBy(_PART).parquet(f"{self._root}/{at}")
        return {"schema": df.schema.jsonValue(), "parts": {x.split("=", 1)[1]: f"{at}/{x}" for x in self._names(at) if "=" in x}}

    def publish(self, base: dict, staged: dict[str, dict], replace: Iterable[str] = (), batch: tuple[str, int] | None = None) -> int:
        """Makes a version of `base` with the parts of `staged` in place of those of the same name, or of all for the tables in `replace`."""
        tables = dict(base["tables"])
        for name, new in staged.items():
            old = tables.get(name, {"parts": {}})["parts"] if name not in replace else {}
            tables[name] = {"schema": new["schema"], "parts": {**old, **new["parts"]}}
        batches = {**base["batches"], **({batch[0]: batch[1]} if batch else {})}
        number = base["version"] + 1
        draft, final = self._path(f"versions/_{uuid.uuid4().hex}"), self._path(f"versions/{number:012d}.json")
        out = self._fs.create(draft, False)
        out.write(json.dumps({"version": number, "tables": tables, "batches": batches}).encode())
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(draft, final, none)
        except Exception as refused:
            self._fs.delete(draft, False)
            if self._fs.exists(final):
                raise Conflict(f"version {number} has been published meanwhile") from refused
            raise
        return number

    def read(self, name: str, version: int | None = None, parts: Iterable[str] | None = None) -> DataFrame | None:
        """A table as of a version (the current one by default), only the named parts if any are; None if there is no such table."""
        table = self.current(version)["tables"].get(name)
        if table is None:
            return None
        schema, wanted = T.StructType.fromJson(table["schema"]), None if parts is None else set(parts)
        paths = [f"{self._root}/{at}" for value, at in table["parts"].items() if wanted is None or value in wanted]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def replace(self, name: str, df: DataFrame, part: str | None = None, whole: bool = True) -> int:
        """Publishes df as the table, or (whole false) as its parts that df has rows of."""
        staged = self.stage(df, part)
        return self._again(lambda base: self.publish(base, {name: staged}, [name] if whole else []))

    def merge(self, name: str, batch_df: DataFrame, keys: list[str], part: str, batch: tuple[str, int] | None = None) -> int | None:
        """Publishes the table with the batch's rows in place of rows of equal keys; None if the batch is in already.

        part: a date that the keys determine; only the parts of the batch's dates are written anew. Of several rows of a
        key the greatest counts; rows without a key or date go. batch: stream and number; numbers grow. If another writer
        publishes first, the merge is made again from that version.
        """
        rest = [c for c in batch_df.columns if c not in keys]
        rows = batch_df.dropna(subset=list(dict.fromkeys([*keys, part])))
        if rest:
            rows = rows.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_r")).select(*[F.col(c) if c in keys else F.col("_r")[c].alias(c) for c in batch_df.columns])
        else:
            rows = rows.distinct()
        fresh = self.stage(rows, part)
        new = self.spark.read.schema(rows.schema).parquet(*[f"{self._root}/{at}" for at in fresh["parts"].values()]) if fresh["parts"] else None

        def once(base: dict) -> int | None:
            if batch and base["batches"].get(batch[0], -1) >= batch[1]:
                return None
            old = self.read(name, base["version"], fresh["parts"]) if new is not None and base["version"] else None
            if old is None:
                return self.publish(base, {name: fresh}, batch=batch)
            return self.publish(base, {name: self.stage(merge_latest(old.select(*rows.columns), new, keys), part)}, batch=batch)

        return self._again(once)

    def _again(self, change: Callable[[dict], int | None], tries: int = 20) -> int | None:
        for left in reversed(range(tries)):
            try:
                return change(self.current())
            except Conflict:
                if not left:
                    raise
        return None

    def expire(self, keep: int = 2, grace_s: float = 3600.0) -> int:
        """Deletes all versions but the newest `keep`, and the data folders that no kept version names and that are older than `grace_s`; how many folders went.

        The grace is for readers of old versions and for writers that have not published yet.
        """
        known = self.versions()
        gone, kept = known[:-keep], known[-keep:]
        named = {at.split("/")[1] for v in kept for t in self.current(v)["tables"].values() for at in t["parts"].values()}
        for v in gone:
            self._fs.delete(self._path(f"versions/{v:012d}.json"), False)
        before, n = (time.time() - grace_s) * 1000, 0
        for name in self._names("data"):
            where = self._path(f"data/{name}")
            if name not in named and self._fs.getFileStatus(where).getModificationTime() <= before:
                self._fs.delete(where, True)
                n += 1
        return n


def snapshot_sink(store: SnapshotStore, name: str, keys: list[str], part: str = "event_date", ts: str = "event_time", stream: str = "silver") -> Callable[[DataFrame, int], None]:
    """A sink for micro-batches that publishes each by date; a batch that is sent again changes nothing."""

    def write(batch_df: DataFrame, batch_id: int) -> None:
        store.merge(name, batch_df.withColumn(part, F.to_date(ts)), keys, part, (stream, batch_id))

    return write

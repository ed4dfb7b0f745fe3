"""Column expressions that read message texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_kv_text(c: Column) -> Column:
    """map<string,string> of `k=v` (or, without an equals sign, `k:v`) parts between ; , and line feeds; null if there are none.

    Parts and both sides are trimmed; of equal keys the last one wins.
    """
    parts = F.transform(F.split(F.trim(c), r"[;,\n]+"), lambda p: F.trim(p))
    parts = F.filter(parts, lambda p: p.contains("=") | p.contains(":"))

    def pair(p):
        equals = F.locate("=", p)
        at = F.when(equals > 0, equals).otherwise(F.locate(":", p))
        return F.struct(F.trim(F.substring(p, F.lit(1), at - 1)).alias("key"), F.trim(F.substring(p, at + 1, F.length(p))).alias("value"))

    pairs = F.transform(parts, pair)
    size = F.size(pairs)
    # a key's last pair only: no pair further on has the key
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, size), lambda q: q["key"] == p["key"]))
    return F.when(size > 0, F.map_from_entries(F.transform(last, lambda p: F.struct(p["key"], p["value"]))))

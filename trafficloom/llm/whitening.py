"""Whitening of embeddings: exact sums of squares of every dimension and of every sum of two, whose differences are the covariances."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, materialize

SCALE = 256
COMPONENTS = 4
#: Rows that one vectorised step takes.
ROWS = 1024
#: Bits of a limb: sums of ROWS products of two limbs fit 63 bits.
_LIMB = 26
#: Bits and number of the parts in which a task hands on its sums.
_PART, _PARTS = 32, 8
#: Numbers of more bits than this are handled as Python integers.
_WIDE = 62


def integers(vector: Column, scale: int = SCALE) -> Column:
    """Entries times `scale`, rounded down, as an array of longs. Null where the vector is null or holds a null, a non-finite entry or one that no long holds."""
    limit = float(1 << 62) / scale
    fit = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < limit, F.lit(False)))  # NaN counts as greater than any
    return F.when(fit, F.transform(vector, lambda c: F.floor(c.cast("double") * float(scale)).cast("long")))


@dataclass
class Fit:
    """What is known of the distinct vectors: the table of them, their number, sums, greatest entry, unit components (columns), their eigenvalues and the trace."""

    distinct: DataFrame

    n: int
    sums: list[int]
    most: int
    components: np.ndarray
    values: np.ndarray
    trace: float


def _matrix(batch: pa.RecordBatch, column: int, d: int) -> np.ndarray:
    values = batch.column(column)
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), d)


def _deviations(x: np.ndarray, n: int, sums: list[int], most: int) -> np.ndarray:
    """n x - S, in longs where they surely fit."""
    wide = 4 * n * max(most, 1) >= 1 << _WIDE
    return n * x.astype(object) - np.array(sums, object) if wide else n * x - np.array(sums, np.int64)


def _square_sums(z: np.ndarray) -> list[int]:
    """Exact sums of z's squares down the columns."""
    if z.dtype == object:
        return (z * z).sum(0).tolist() if len(z) else [0] * z.shape[1]
    most = int(np.abs(z).max(initial=0))
    limbs, total = [], [0] * z.shape[1]
    while most:  # z is the sum of limb k times 2^(26 k); the sign stays in the highest one
        last = most < 1 << (_LIMB - 1)
        low = z if last else z & ((1 << _LIMB) - 1)
        limbs.append(low)
        z, most = (z - low) >> _LIMB, 0 if last else (most >> _LIMB) + 1
    for a, low in enumerate(limbs):
        for b in range(a, len(limbs)):
            part = (low * limbs[b]).sum(0).tolist()
            total = [t + ((v if a == b else 2 * v) << (_LIMB * (a + b))) for t, v in zip(total, part)]
    return total


def _sums(fit: DataFrame, of, d: int) -> dict[int, int]:
    """Sums over all rows of the exact integers that `of` gives for up to ROWS rows, by their place in its list.

    A task hands on a row for each sum, in parts of 32 bits; they are added by place, so the driver gets one row a place.
    """

    def run(batches):
        total: list[int] | None = None
        for b in batches:
            x = _matrix(b, 0, d)
            for at in range(0, len(x), ROWS):
                some = of(x[at : at + ROWS])
                total = some if total is None else [a + s for a, s in zip(total, some)]
        if total is not None:
            low = [pa.array([(t >> (_PART * k)) & ((1 << _PART) - 1) if k < _PARTS - 1 else t >> (_PART * k) for t in total], pa.int64()) for k in range(_PARTS)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), *low], names=["place", *[f"p{k}" for k in range(_PARTS)]])

    parts = fit.select("x").mapInArrow(run, "place int, " + ", ".join(f"p{k} long" for k in range(_PARTS)))
    rows = parts.groupBy("place").agg(*[F.sum(f"p{k}").alias(f"p{k}") for k in range(_PARTS)]).collect()
    return {r.place: sum(r[f"p{k}"] << (_PART * k) for k in range(_PARTS)) for r in rows}


def covariances(fit: DataFrame, d: int, n: int, sums: list[int], most: int) -> np.ndarray:
    """The covariance matrix (divisor n) of the distinct vectors `x` of `fit`, each entry the nearest double.

    With z = n x - S: sums of z_i^2 and of (z_i + z_j)^2, all exact; half of what the second has over both of the first is
    the sum of z_i z_j, n^3 times the covariance.
    """

    def squares(x: np.ndarray) -> list[int]:
        z = _deviations(x, n, sums, most)
        out = _square_sums(z)
        for i in range(d - 1):
            out += _square_sums(z[:, i : i + 1] + z[:, i + 1 :])
        return out

    total = _sums(fit, squares, d)
    v, place = np.zeros((d, d)), d
    for i in range(d):
        v[i, i] = total[i] / n**3
        for j in range(i + 1, d):
            v[i, j] = v[j, i] = (total[place] - total[i] - total[j]) / (2 * n**3)
            place += 1
    return v


def whitening(rows: DataFrame) -> Fit | None:
    """The fit of vectors `x` (arrays of longs of one length), each distinct one counted once. None without any.

    The distinct vectors are written once to the shared folder and read for the sums and for the squares; who asks for the
    fit deletes them. The driver gets a number for each pair of dimensions.
    """
    fit = materialize(rows.select("x").distinct())
    size = fit.agg(F.count("*").alias("n"), F.first(F.size("x")).alias("d"), F.max(F.array_max(F.transform("x", F.abs))).alias("most")).first()
    if not size.n:
        discard(fit)
        return None
    n, d, most = size.n, size.d, int(size.most)

    def plain(x: np.ndarray) -> list[int]:
        return (x.sum(0) if most < 1 << 50 else x.astype(object).sum(0)).tolist()

    total = _sums(fit, plain, d)
    sums = [total[i] for i in range(d)]
    v = covariances(fit, d, n, sums, most)
    values, vectors = np.linalg.eigh(v)
    return Fit(fit, n, sums, most, vectors[:, ::-1], values[::-1], float(np.trace(v)))


def same_length(rows: DataFrame) -> DataFrame:
    """The rows whose vector `x` is as long as most are (of equal counts the longer); empty ones go."""
    rows = rows.where(F.size("x") > 0)
    usual = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == usual.d) if usual else rows


def _projected(rows: DataFrame, fit: Fit, use: list[int]) -> DataFrame:
    """`rows` with deviation (null where no long holds it) and w, the values of the components `use`."""
    from pyspark.sql import types as T

    d, names = len(fit.sums), rows.columns
    basis = fit.components[:, use] / np.sqrt(fit.values[use])
    n, sums, most = fit.n, fit.sums, fit.most

    def run(batches):
        for b in batches:
            deviation, w = [], []
            x = _matrix(b, names.index("x"), d)
            for at in range(0, len(x), ROWS):
                z = _deviations(x[at : at + ROWS], n, sums, most)
                deviation += _square_sums(z.T) if z.dtype == object or len(z) == 0 else _square_sums(np.ascontiguousarray(z.T))
                # z / n in two parts, as longs above 2^53 are no doubles
                whole, rest = (z // n).astype(np.float64), (z % n).astype(np.float64) / n
                w.append((whole + rest) @ basis)
            w = np.concatenate(w) if w else np.empty((0, len(use)))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(w.reshape(-1)), len(use)).cast(pa.list_(pa.float64())) if len(use) else pa.array([[]] * len(x), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([t if t < 1 << 63 else None for t in deviation], pa.int64()), lists], names=[*names, "deviation", "w"])

    return rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField("deviation", T.LongType()), T.StructField("w", T.ArrayType(T.DoubleType()))]))


def whiten(table: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(id_col, component, n, deviation, whitened, explained, identity_error): each vector's first components, scaled to variance 1.

    Entries are taken as longs, `scale` times as large and rounded down. Vectors that are null, hold a null, a non-finite
    entry or one beyond a long, have no entries, or are not as long as most, go. Mean and covariance are those of the
    distinct vectors; every row that remains is returned, repeated ones and those without an id too, `components` times
    (or once for each dimension, if there are fewer). deviation: the exact sum of (n x - S)^2, null if no long holds it.
    A component without variance has null values. identity_error: how far the covariance of the values returned, over
    the distinct vectors, is from the identity; null if there are none. Other columns do not matter. An empty table, or
    one without such vectors, gives an empty one.
    """
    rows = same_length(table.select(F.col(id_col).alias("_id"), integers(F.col(vector), scale).alias("x")).where(F.col("x").isNotNull()))
    fit = whitening(rows)
    kind = table.schema[id_col].dataType.simpleString()
    if fit is None:
        empty = f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return table.sparkSession.createDataFrame([], empty)
    d = len(fit.sums)
    use = [k for k in range(min(components, d)) if fit.values[k] > d * np.finfo(float).eps * fit.trace]
    error = _identity_error(_projected(fit.distinct, fit, use), len(use))
    discard(fit.distinct)
    values = [F.struct(F.lit(k + 1).alias("component"), (F.get("w", F.lit(use.index(k))) if k in use else F.lit(None).cast("double")).alias("whitened"), F.lit(float(fit.values[k] / fit.trace) if fit.trace else None).cast("double").alias("explained")) for k in range(min(components, d))]
    out = _projected(rows, fit, use).select("_id", "deviation", F.explode(F.array(*values)).alias("_v"))
    return out.select(F.col("_id").alias(id_col), "_v.component", F.lit(fit.n).cast("long").alias("n"), "deviation", "_v.whitened", "_v.explained", F.lit(error).cast("double").alias("identity_error"))


def _identity_error(projected: DataFrame, k: int) -> float | None:
    """The greatest absolute entry of the covariance of the k values `w`, less the identity; centred sums that Spark merges."""
    if not k:
        return None
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    got = projected.agg(*[F.covar_pop(F.get("w", F.lit(i)), F.get("w", F.lit(j))).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(got[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))

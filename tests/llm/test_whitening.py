import math
import random
from fractions import Fraction

import numpy as np
import pytest

from trafficloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n int, component string, x string, w int"


def table(spark, vectors, kind="float"):
    return spark.createDataFrame([(i, v, 1, "a", "b", 2) for i, v in vectors], SCHEMA.replace("float", kind))


def numbers(v):
    return tuple(math.floor(256 * float(np.float32(c))) for c in v)


def vectors(n=300, d=7, seed=2):
    r = random.Random(seed)
    out = []
    for i in range(n):
        a, b = r.gauss(0, 1), r.gauss(0, 1)
        out.append((i, [a + r.gauss(0, 0.2 + k / 9) + (b if k % 2 else 0) + 40 * (k == 3) for k in range(d)]))
    out += [(1000 + i, out[i % 3][1]) for i in range(90)]  # copies count once
    return out + [(2000, None), (2001, [1.0, None] + [0.0] * (d - 2)), (2002, [float("nan")] * d), (2003, [float("inf")] + [0.0] * (d - 1)), (2004, [1.0]), (2005, []), (2006, [3e38] * d), (None, out[5][1])]


def exact(rows):
    """(n, sums, covariance matrix) of the distinct vectors, by fractions."""
    fit = sorted({numbers(v) for v in rows})
    n, d = len(fit), len(fit[0])
    s = [sum(x[k] for x in fit) for k in range(d)]
    cov = [[Fraction(sum((n * x[i] - s[i]) * (n * x[j] - s[j]) for x in fit), n**3) for j in range(d)] for i in range(d)]
    return fit, n, s, np.array([[float(c) for c in row] for row in cov])


def test_equals_brute_force(spark):
    rows = vectors()
    good = {i: v for i, v in rows if v and len(v) == 7 and all(c is not None and math.isfinite(c) and abs(c) < 1e30 for c in v)}
    fit, n, s, cov = exact(good.values())
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1], vecs[:, ::-1]
    got = whitening.whiten(table(spark, rows).repartition(5)).collect()
    assert sorted((str(r.vec_id), r.component) for r in got) == sorted((str(i), k) for i in good for k in (1, 2, 3, 4))
    flip = {}
    for r in got:
        x, k = numbers(good[r.vec_id]), r.component - 1
        assert r.n == n and r.deviation == sum((n * a - b) ** 2 for a, b in zip(x, s))
        assert r.explained == pytest.approx(values[k] / np.trace(cov), rel=1e-9)
        want = sum((Fraction(n * a - b, n) * Fraction(float(c)) for a, b, c in zip(x, s, vecs[:, k])), Fraction(0)) / Fraction(math.sqrt(values[k]))
        sign = flip.setdefault(k, 1 if abs(r.whitened - want) <= abs(r.whitened + want) else -1)
        assert r.whitened == pytest.approx(sign * float(want), abs=1e-7)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_covariances_are_the_nearest_doubles(spark):
    rows = [v for _, v in vectors(80, 5) if v and len(v) == 5][:80]
    fit, n, s, cov = exact(rows)
    df = spark.createDataFrame([(list(x),) for x in fit], "x array<long>").repartition(3)
    assert whitening.covariances(df, 5, n, s, 1 << 20).tolist() == cov.tolist()


@pytest.mark.parametrize("size", [0, 3, 20, 30, 40, 60, 90])
def test_square_sums_are_exact(size):
    r = random.Random(size)
    z = [[r.randint(-(1 << size), 1 << size) for _ in range(4)] for _ in range(whitening.ROWS)]
    z[0] = [-(1 << size), 1 << size, 0, 1]
    kind = np.int64 if size < 62 else object
    assert whitening._square_sums(np.array(z, kind)) == [sum(row[k] ** 2 for row in z) for k in range(4)]


def test_very_large_entries_and_numbers(spark):
    rows = [(i, [1e15 * (i % 7) + i, -1e14 * i, 3.0 * i * i]) for i in range(40)]
    got = whitening.whiten(table(spark, rows, "double")).collect()
    assert len(got) == 120 and got[0].identity_error < 1e-4
    fit = sorted({tuple(math.floor(256 * c) for c in v) for _, v in rows})
    s = [sum(x[k] for x in fit) for k in range(3)]
    for r in got:  # beyond a long
        assert r.deviation is None and sum((40 * math.floor(256 * c) - t) ** 2 for c, t in zip(rows[r.vec_id][1], s)) >= 1 << 63


def test_no_variance_empty_tables_and_few_dimensions(spark):
    same = whitening.whiten(table(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same) == [(i, k, 1, 0, None, None, None) for i in (1, 2) for k in (1, 2)]
    flat = whitening.whiten(table(spark, [(i, [float(i), 2.0, float(2 * i)]) for i in range(9)])).collect()
    assert {r.component: r.whitened is None for r in flat} == {1: False, 2: True, 3: True}
    for rows in ([], [(1, None), (2, [None])]):
        got = whitening.whiten(table(spark, rows))
        assert got.count() == 0 and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_query(spark, tmp_path):
    table(spark, vectors(60, 6)).select("vec_id", "embedding").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = whitening.op13_whitening(spark, str(tmp_path))
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    assert got.count() == 4 * (60 + 90 + 1)

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np

from trafficloom.llm import periodic

from .util import corpus, frame


def plain_runs(words):
    """All runs by definition: for every period the maximal stretches, less those whose smallest period is another."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(6, 4 * q):
                own = words[start : start + length]
                if not any(own[p:] == own[:-p] for p in range(1, q)):
                    out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_words(text):
    return [w.decode() for w in re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode())]


def plain_collapse(words, runs):
    return " ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs))


def texts(seed=11):
    r = random.Random(seed)
    out = ["a " * 5, "a " * 6, "a b " * 3, "a b " * 4 + "a", "x " + "a b c " * 9 + "y", "a " * 400, ("a " * 7 + "b ") * 9, "", " \n", "a\x0ba\x0ca a a a\ta a", "ab abab"]
    for _ in range(60):
        words = [r.choice("ab" if r.random() < 0.5 else "abcdefgh") for _ in range(r.randint(0, 60))]
        for _ in range(r.randint(0, 3)):  # nested and neighbouring repeats
            unit = [r.choice("abc") for _ in range(r.randint(1, 40))]
            words += unit * r.randint(1, 9) + unit[: r.randrange(len(unit))] + [r.choice("abcz") for _ in range(r.randint(0, 3))]
        out.append(r.choice((" ", "\n", "  ")).join(words))
    return out


def check(got, rows):
    assert len(got) == len(rows)
    want = sorted((str(i), len(w := plain_words(t)), (q := plain_runs(w)), plain_collapse(w, q)) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_words, [(x.start, x.length, x.period) for x in r.runs], r.collapsed) for r in got) == want


def test_runs_equal_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(1000 + i, t) for i, t in corpus()]
    got = periodic.periodic_runs(frame(spark, rows))
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    check(got.collect(), rows)


def test_small_tiles_give_the_same_runs(spark):
    rows = [(i, t) for i, t in enumerate(texts(12))]
    for tile in (1, 8, 64):
        check(periodic.periodic_runs(frame(spark, rows), tile=tile).collect(), rows)


def test_fragments_of_neighbouring_tiles_touch():
    words = np.array([1, 2, 3] * 100, np.int64)
    found = periodic.fragments(words, np.array([0]), np.array([300]), tile=16)
    own = sorted((a, b) for _, q, a, b in found.tolist() if q == 3)
    assert len(own) > 10 and own[0][0] == 0 and max(b for _, b in own) == 297
    assert all(b >= a for (_, b), (a, _) in zip(own, own[1:]))
    assert {q for _, q, _, _ in found.tolist()} == {3}  # its multiples are no periods of their own


def test_a_long_repeat_takes_few_steps():
    words = np.zeros(300_000, np.int64)
    assert periodic.fragments(words, np.array([0]), np.array([300_000])).tolist() == [[0, 1, 0, 299_999]]


def test_repeated_and_null_ids_and_empty_tables(spark):
    rows = [(1, "a " * 9), (1, "a " * 9), (1, "b c " * 9), (1, None), (None, "a " * 9), (None, "a " * 9), (None, None), (2, "one")]
    check(periodic.periodic_runs(frame(spark, rows).repartition(3)).collect(), rows)
    check(periodic.periodic_runs(frame(spark, rows).coalesce(1)).collect(), rows)
    assert periodic.periodic_runs(frame(spark, [])).count() == 0
    clash = spark.createDataFrame([("k", "a " * 9, 3, "y")], "period string, text string, runs int, _words string")
    assert [r.period for r in periodic.periodic_runs(clash, "period").collect()] == ["k"]


def test_query_equals_the_contract(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(texts(3) + [t for _, t in corpus()])] + [(7, "a a a a a a a b"), (None, "x " * 8)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    want, hit = [], 0
    for i, t in rows:
        words, n = plain_words(t), len(plain_words(t))
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
            hit += 1
        runs = plain_runs(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.append((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(plain_collapse(words, runs))))
    got = [tuple(r) for r in periodic.op11_periodic(spark, str(tmp_path)).collect()]
    assert hit > 3 and sorted(map(repr, got)) == sorted(map(repr, want))

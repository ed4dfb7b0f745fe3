import hashlib

from trafficloom.llm import fingerprint as fp

from .util import corpus, frame, thue_morse


def shingles(t):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def like(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_with_next(spark):
    rows = corpus()
    got = {r.doc_id: r for r in fp.with_next(frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(rows):
        t, n, r = t or "", rows[(k + 1) % len(rows)][1] or "", got[i]
        edited = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert abs(r.near_edited - like(shingles(t), shingles(edited))) < 0.15
        assert abs(r.near_next - like(shingles(t), shingles(n))) < 0.1
    assert got[0].fingerprint == got[60].fingerprint and got[63].fingerprint == ""


def test_lone_repeated_null_and_empty(spark):
    [r] = fp.with_next(frame(spark, [(5, "a b c d e f")])).collect()
    assert r.near_next == 1.0
    got = fp.with_next(frame(spark, [(1, "a"), (1, "a"), (None, None), (2, "b")])).collect()
    assert sorted((r.doc_id or -1, r.n_chars) for r in got) == [(-1, 0), (1, 1), (1, 1), (2, 1)]
    assert fp.with_next(frame(spark, [])).count() == 0


def test_merge_and_estimates(spark):
    import numpy as np

    a = " ".join(f"w{i}" for i in range(4000))
    b = " ".join(f"w{i}" for i in range(2000, 6000))
    rows = [(1, a), (2, b), (3, "")]
    df = fp.fingerprints(frame(spark, rows))
    one, two = (fp.decode(r.fingerprint) for r in df.where("doc_id < 3").orderBy("doc_id").collect())
    assert abs(fp.resemblance(one, two) - 1 / 3) < 0.12 and abs(fp.containment(one, two) - 0.5) < 0.15
    assert abs(fp.distinct_count(one) / 3996 - 1) < 0.3
    [m] = fp.merge_fingerprints(df.selectExpr("1 as k", "fingerprint"), "k").collect()
    assert np.array_equal(fp.decode(m.fingerprint), fp.merge([one, two]))


def test_unlike_words_whose_polynomials_agree(spark):
    rows = [(i, t) for i, t in enumerate(f"one two {w} four five" for k in (10, 11, 12) for w in thue_morse(k))]
    got = fp.with_next(frame(spark, rows)).collect()
    assert len({r.fingerprint for r in got}) == len(rows) and all(r.near_next == 0.0 for r in got)

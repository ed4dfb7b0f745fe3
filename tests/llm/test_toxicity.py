import itertools
import random
import zlib

import numpy as np

from trafficloom.llm import toxicity

from .util import frame

NICE = "river stone window garden letter morning winter kitchen market bridge candle forest".split()
BAD = "blockhead dimwit nitwit".split()


def rows(n=900):
    r = random.Random(7)
    out, labels = [], []
    for i in range(n):
        words = [r.choice(NICE) + r.choice(("", "s", "ly")) for _ in range(40)]
        if i % 5 == 0:
            for _ in range(4):
                words[r.randrange(40)] = r.choice(BAD)
        out.append((i, " ".join(words)))
        labels.append((i, int(i % 5 == 0)))
    return out, labels


def test_learns_and_sees_through_disguise(spark):
    docs, labels = rows()
    extra = [(10_000, "the bl0ckhe@d and the d1mwit by the n!tw1t"), (10_001, "b l o c k h e a d and d i m w i t"), (10_002, "blooockheaaad dimmmwit"), (10_003, "b.l.o.c.k.h.e.a.d d-i-m-w-i-t"), (10_004, "a calm river"), (10_005, ""), (10_006, None)]
    df = frame(spark, docs + extra)
    y = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(df, y).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _ in docs)
    assert all(got[i].predicted == t for i, t in labels)
    assert [got[k].predicted for k in range(10_000, 10_007)] == [1, 1, 1, 1, 0, 0, 0]
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = toxicity.keep_clean(df, y)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}


def test_held_out_labels_are_not_used(spark):
    docs, labels = rows(300)
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, t in labels]
    score = lambda ls: {r.doc_id: r.score for r in toxicity.toxicity(frame(spark, docs), spark.createDataFrame(ls, "doc_id long, toxic int")).collect()}
    assert score(labels) == score(flipped)


def test_counts_cover_whole_texts(spark):
    counts = toxicity.trigram_counts(frame(spark, [(1, "ab"), (2, "ab"), (3, None), (4, "é")])).reshape(64, 64, 64)
    assert counts[0, 1, 2] == 2
    assert np.isfinite(toxicity.language_model(counts)).all()


def test_no_labels_and_empty(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(abs(r.score - toxicity.QUIET) < 1e-9 for r in toxicity.toxicity(frame(spark, rows(5)[0]), none).collect())
    assert toxicity.toxicity(frame(spark, []), none).count() == 0


def brute_restore(word, model, apart):
    """The best score over every path of the lattice, by all combinations."""
    def paths():
        for parts in itertools.product(*toxicity.lattice(word)):
            letters = [p for p, _ in parts]
            full = [k for k, p in enumerate(letters) if p]
            for cut in itertools.product((False, True), repeat=len(full) - 1 if apart and full else 0):
                text = list(letters)
                for k, at in zip(full[1:], cut):
                    text[k] = " " * at + text[k]
                yield "".join(text), sum(c for _, c in parts)

    def score(text, cost):
        n = [0, 0, *(int(toxicity._NUMBER[ord(c)]) for c in text), 0]
        return cost + sum(float(model[n[k], n[k + 1], n[k + 2]]) for k in range(len(n) - 2))

    return max((score(t, c), t) for t, c in paths())


def test_restores_the_best_path():
    r = random.Random(5)
    model = toxicity.language_model(np.random.default_rng(1).integers(0, 9, 64**3))
    words = ["d1mw!t", "n!!tw1t", "b.l-0ck", "7007", "a", "...", "é1é"] + ["".join(r.choice("ab1!7@.é") for _ in range(r.randint(1, 7))) for _ in range(60)]
    for w in words:
        for apart in (False, True):
            best, _ = brute_restore(w, model, apart)
            found = toxicity.restore(w, model, apart)
            # the path that was found has the best score: its cost is that of a reading of the same letters
            scores = [c for t, c in _readings(w, apart) if t == found]
            n = [0, 0, *(int(toxicity._NUMBER[ord(c)]) for c in found), 0]
            got = max(scores) + sum(float(model[n[k], n[k + 1], n[k + 2]]) for k in range(len(n) - 2))
            assert abs(got - best) < 1e-4, (w, apart, found)


def _readings(word, apart):
    for parts in itertools.product(*toxicity.lattice(word)):
        letters = [p for p, _ in parts if p]
        for cut in itertools.product((False, True) if apart else (False,), repeat=max(0, len(letters) - 1)):
            yield "".join(letters[:1] + [" " * at + p for p, at in zip(letters[1:], cut)]), sum(c for _, c in parts)


def test_words_apart_long_words_and_odd_rows(spark):
    docs, labels = rows()
    apart = lambda t: " ".join(t.replace(" ", ""))
    extra = [
        (10_000, apart("river stone dimwit window garden letter morning winter kitchen market")),
        (10_001, "a é i " + apart("nitwit") + " é"),
        (10_002, "bl0ck" + "h" * 60 + "ead"),
        (10_003, apart("river stone window garden letter morning winter kitchen market bridge candle forest")),
        (10_004, "x7" * 40_000),
        (None, "the d1mwit"),
        (None, None),
        (10_005, "d1mwit"),
        (10_005, "d1mwit"),
    ]
    df = spark.createDataFrame([(i, t, "a", 0.5, True) for i, t in docs + extra], "doc_id long, text string, predicted string, score double, held_out boolean")
    got = toxicity.toxicity(df, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(got) == len(docs + extra)
    of = lambda i: [r.predicted for r in got if r.doc_id == i]
    assert [of(k) for k in (10_000, 10_001, 10_002, 10_003, 10_004, 10_005)] == [[1], [1], [1], [0], [0], [1, 1]] and sorted(of(None)) == [0, 1]
    assert not any(r.held_out for r in got if r.doc_id is None)


def test_restoring_finds_what_words_as_written_miss(spark):
    """With the same labels, and without restoring: disguised words are seen only by the first."""
    docs, labels = rows()
    r = random.Random(3)
    hidden = [(20_000 + k, " ".join(r.choice(NICE) for _ in range(20)) + " " + r.choice(("d1mw1t", "n.i.t.w.i.t", "bl0ckh3ad", "d i m w i t"))) for k in range(40)]
    y = spark.createDataFrame(labels, "doc_id long, toxic int")
    found = {}
    for restoring in (True, False):
        found[restoring] = sum(x.predicted for x in toxicity.toxicity(frame(spark, docs + hidden), y, restoring=restoring).collect() if x.doc_id >= 20_000)
    assert found[True] == 40 and found[False] == 0

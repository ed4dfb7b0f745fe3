import hashlib
import random
import re
from collections import Counter

import pytest

from trafficloom.llm import suffix

from .util import frame, thue_morse


def brute(rows, length):
    bodies = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + length] for _, b in bodies for k in range(len(b) - length + 1))
    out = {}
    for i, b in bodies:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def brute_passages(rows, length, least):
    """Words in runs of over `least` words of bytes covered by strings of `length` bytes that also start elsewhere."""
    bodies = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + length] for _, b in bodies for k in range(len(b) - length + 1))
    out = {}
    for i, b in bodies:
        gone = [False] * (len(b) + 1)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = [True] * length
        out[i], at = 0, 0
        while at < len(b):
            to = at
            while gone[to]:
                to += 1
            if to > at:
                words = sum(1 for m in re.finditer(rb"[^\x20\x09-\x0D]+", b) if at <= m.start() and m.end() <= to)
                out[i] += words * (words > least)
            at = max(to, at + 1)
    return out


def texts(seed=1):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 9)))
    some = lambda n: " ".join(word() for _ in range(n))
    passage = some(150)
    rows = [some(r.randint(1, 200)) for _ in range(40)]
    rows += [f"{some(20)} {passage} {some(25)}" for _ in range(30)]  # one passage in many surroundings
    rows += [f"{some(9)} {passage[500 * k : 500 * k + 300]} {some(30)}" for k in (0, 1, 0)] + [passage[700:956], passage[700:955]]
    rows += [rows[0], rows[3][:-30] + "x", "a" * 3000, "ab" * 900, passage[:400], passage[1:401], passage[:399], some(40) * 12, "", None]
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("block", [1 << 20, 1 << 13])
def test_against_brute_force(spark, monkeypatch, block):
    """The smaller block sends the common passage to the counted path and spreads the others."""
    monkeypatch.setattr(suffix, "BLOCK_BYTES", block)
    rows = texts()
    found = suffix.remove_repeats(frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == brute(rows, 400)
    assert {r.doc_id: r.n_passage_words for r in found} == brute_passages(rows, 256, 50)


def test_bounds_equal_common_prefixes():
    import numpy as np

    r = random.Random(3)
    for _ in range(30):
        t = bytes(r.choice(b"ab") for _ in range(r.randint(1, 300))) * r.randint(1, 3)
        n = r.choice((9, 16, 50))
        order, bound = suffix.common_prefix_bounds(np.frombuffer(t, np.uint8), n)
        cut = [(t * n)[k : k + n] for k in order.tolist()]  # the text is a circle
        assert cut == sorted(cut) and bound.tolist() == [True] + [a != b for a, b in zip(cut, cut[1:])]


def test_empty_repeated_and_null_ids(spark):
    assert suffix.remove_repeats(frame(spark, [])).count() == 0
    long = "word " * 7 + "".join(f"{k:x}q" for k in range(400))
    got = [(r.doc_id, r.n_removed) for r in suffix.remove_repeats(frame(spark, [(1, long), (1, long)])).collect()]
    assert got == [(1, len(long)), (1, len(long))]  # each row is a document: they repeat each other
    got = {(r.doc_id, r.n_removed == r.n_bytes) for r in suffix.remove_repeats(frame(spark, [(1, long), (None, long)])).collect()}
    assert got == {(1, True), (None, True)}


def test_unlike_texts_whose_polynomials_agree(spark):
    """Words of two letters that collide under any polynomial modulo a power of two stay apart."""
    for k in (10, 11, 12):
        a, b = thue_morse(k)
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.remove_repeats(frame(spark, [(1, a), (2, b)])).collect()}
        assert got == brute([(1, a), (2, b)], 400)


def test_passages_at_other_lengths(spark):
    rows = texts(4)
    found = suffix.remove_repeats(frame(spark, rows), length=700, shorter=300, passage_words=20).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == brute(rows, 700)
    assert {r.doc_id: r.n_passage_words for r in found} == brute_passages(rows, 300, 20)

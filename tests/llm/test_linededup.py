import random

import numpy as np

from trafficloom.llm import linededup

from .util import frame, thue_morse


def brute(rows):
    """Every run of lines that is deletable and stands earlier, by all pairs of windows of any length."""
    docs = sorted({(i is not None, i or 0, i, t) for i, t in rows if t is not None}, key=lambda x: x[:2])
    lines = {d[2]: [(k, x) for k, x in enumerate(d[3].split("\n")) if x.split()] for d in docs}
    first, gone = {}, {d[2]: set() for d in docs}
    for d in docs:
        own = lines[d[2]]
        for a in range(len(own)):
            for b in range(a, len(own)):
                run = tuple(x for _, x in own[a : b + 1])
                if len(run) >= linededup.MIN_LINES or sum(len(x.split()) for x in run) >= linededup.MIN_WORDS:
                    if run in first:
                        gone[d[2]].update(k for k, _ in own[a : b + 1])
                    else:
                        first[run] = d[2]
    return {d[2]: ("\n".join(x for k, x in enumerate(d[3].split("\n")) if k not in gone[d[2]]), len(gone[d[2]])) for d in docs}


def test_against_brute_force(spark):
    r = random.Random(2)
    lines = [f"line {k} " + "w " * r.randint(0, 25) for k in range(25)] + ["", "  ", "x " * 45]
    rows = [(i, "\n".join(r.choice(lines) for _ in range(r.randint(1, 14)))) for i in range(60)]
    rows += [(100, rows[0][1]), (101, rows[5][1] + "\nnew"), (102, "a\n" * 9), (103, ""), (104, "x " * 45)]
    got = {r.doc_id: (r.text, r.n_removed) for r in linededup.dedup_lines(frame(spark, rows)).collect()}
    assert got == brute(rows)


def test_null_empty_repeated_and_columns(spark):
    assert linededup.dedup_lines(frame(spark, [])).count() == 0
    text = "a b\nc d\ne f"
    got = linededup.dedup_lines(frame(spark, [(1, text), (1, text), (None, text), (2, None)]))
    assert got.columns == [*frame(spark, []).columns, "n_lines", "n_removed"]
    # a null id comes first, so it keeps the lines
    assert sorted((r.doc_id or 0, r.text) for r in got.collect() if r.text is not None) == [(0, text), (1, ""), (1, "")]


def test_fewer_positions_than_lines():
    """One line is the fingerprint of several windows, and every least window has one."""
    text = "\n".join(f"line {k} of a list" for k in range(1000)).encode()
    doc, i, fp, begin, o, n, hashes = linededup._positions(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert len(i) < 700 and begin[-1] == len(n) == len(hashes) == 998
    assert sorted(np.repeat(i, np.diff(begin)) + o) == list(range(998))


def test_unlike_lines_whose_polynomials_agree(spark):
    for k in (10, 11, 12):
        a, b = thue_morse(k)
        rows = [(1, " ".join(a)), (2, " ".join(b)), (3, f"{a}\n{b}\n{a}"), (4, f"{b}\n{a}\n{b}"), (5, f"{b}\n{a}\n{b}")]
        assert {r.doc_id: (r.text, r.n_removed) for r in linededup.dedup_lines(frame(spark, rows)).collect()} == brute(rows)

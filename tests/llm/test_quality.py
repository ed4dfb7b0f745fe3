import re

from trafficloom.llm import quality

from .util import corpus, frame, thue_morse

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    words = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            covered.update(range(i, i + 8))
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered), n < 20 or 100 * len(covered) > 30 * n


def rows():
    good = "This is a calm sentence of several words. It says little, but says it well enough for anyone here to follow along."
    more = "Another line tells of rivers, stones and winter mornings, and it never once repeats what came before it today."
    odd = [
        good + "\n" + more,
        "HOME | NEWS | SPORT | ABOUT | HELP\n" * 3 + good,
        " ".join(f"word{k}$$$" for k in range(40)),
        " ".join(f"LOUD{k}!!" for k in range(40)),
        " ".join(w for k in range(6) for w in [f"again{k}"] * 9),
        good + "\nAll rights reserved. Privacy policy.\nRead more",
        "one two three four five six seven eight " * 4,
        "\n\n \n",
        "ÄÖÜ ÉÈ " * 30,
    ]
    return [(k, t) for k, t in enumerate(odd)] + [(100 + k, t) for k, t in corpus()]


def test_base_counts(spark):
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.line_quality(frame(spark, rows())).collect()}
    assert got == {i: brute(t) for i, t in rows()}


def test_verdicts_and_text(spark):
    got = {r.doc_id: r for r in quality.line_quality(frame(spark, rows()), with_text=True).collect()}
    assert [got[k].kept for k in range(9)] == [True, False, False, False, False, True, False, False, False]
    assert got[5].clean_text == rows()[5][1].split("\n")[0] and got[5].n_boilerplate_lines == 2
    assert got[1].n_navigation_lines == 3
    assert quality.line_quality(frame(spark, [])).count() == 0


def test_unlike_words_and_lines_whose_polynomials_agree(spark):
    texts = []
    for k in (10, 11, 12):
        a, b = thue_morse(k)
        seven = "one two three four five six seven"
        texts += [f"{seven} {a}\n{seven} {b}", f"{a}\n{b}\n{a}", f"{seven} {a} {seven} {a}"]
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.line_quality(frame(spark, rows)).collect()}
    assert got == {i: brute(t) for i, t in rows}

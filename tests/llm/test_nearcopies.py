import random

import corpus_pipeline

from trafficloom.llm import nearcopies

from .util import corpus, frame


def shingles(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_groups(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}


def edited(n=30, seed=5):
    """Texts and their copies with a few edited words, some of them under and some over the bound, and one text with many."""
    r = random.Random(seed)
    texts = []
    for k in range(n):
        words = [f"w{r.randrange(5000)}" for _ in range(r.randint(60, 200))]
        texts.append(" ".join(words))
        for _ in range(40 if k == 0 else 2):
            other = list(words)
            for at in r.sample(range(len(words)), r.randint(1, max(2, len(words) // 40))):
                other[at] = "edited"
            texts.append(" ".join(other))
    return list(enumerate(texts))


def test_against_brute_force(spark):
    for rows in (corpus(), edited()):
        want = brute_groups(rows)
        got = {r.doc_id: r.component_id for r in nearcopies.near_copy_groups(frame(spark, rows)).collect()}
        assert got == want
    assert nearcopies.near_copy_groups(frame(spark, [])).count() == 0


def drifting(n=40, seed=9):
    """One text whose words change one by one: each is a near copy of the next, the first and the last are unlike. And texts of one frame, unlike each other."""
    r = random.Random(seed)
    words = [f"w{r.randrange(5000)}" for _ in range(150)]
    texts = []
    for k in range(n):
        texts.append(" ".join(words))
        words[(37 * k) % len(words)] = f"new{k}"
        words[(37 * k + 70) % len(words)] = f"other{k}"
    frame_words = [f"f{r.randrange(500)}" for _ in range(110)]
    texts += [" ".join(frame_words + [f"x{r.randrange(10**6)}" for _ in range(30)]) for _ in range(20)]
    return list(enumerate(texts))


def test_chains_past_leaders(spark, monkeypatch):
    """Under a key with many texts no link is lost: here all texts share the only key, and the blocks are small."""
    rows = drifting()
    want = brute_groups(rows)
    assert 3 < len(set(want.values())) < len(rows)
    monkeypatch.setattr(nearcopies, "FEW", 4)
    monkeypatch.setattr(nearcopies, "BLOCK", 16)
    monkeypatch.setattr(nearcopies, "BANDS", 1)
    monkeypatch.setattr(nearcopies, "ROWS", 1)
    monkeypatch.setattr(nearcopies, "_FACTORS", nearcopies._FACTORS[:1] * 0)  # every text has the same key
    got = {r.doc_id: r.component_id for r in nearcopies.near_copy_groups(frame(spark, rows)).collect()}
    assert got == want


def test_stage_drops_copies_with_edited_words(spark):
    rows = edited()
    kept = corpus_pipeline.drop_near_duplicates(spark, frame(spark, rows), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, c in brute_groups(rows).items() if i == c)
    assert kept.columns == frame(spark, rows).columns

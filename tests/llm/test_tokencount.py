import random

import public_tokenizers
from tokenizers import Tokenizer, models

from trafficloom.llm import tokencount

from .util import corpus, frame, thue_morse


def unigram(pieces):
    vocab = [("<unk>", 0.0), *[(f"<0x{b:02X}>", -1e6) for b in range(256)], *pieces]
    low = min(s for _, s in pieces)
    vocab = [(p, s if s > -1e6 else low) for p, s in vocab]  # the worst piece sets the score of unknown characters
    return Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=True))


def texts():
    r = random.Random(4)
    odd = ["a  b", "  lead", "tail  ", "line\nfeed\tand", "日本語 テスト", "🙂🙂 x", "aaaaaaaaaaaaaaaaaaaaaa", " ", "ñandú Größe été"]
    return odd + ["".join(r.choice("etaoin srhé ß\n語") for _ in range(r.randint(1, 60))) for _ in range(400)]


def test_counts_equal_the_tokenizer(spark):
    pieces = tokencount.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    want = unigram(pieces)
    rows = [(i, t) for i, t in enumerate(texts())] + [(10_000 + i, t) for i, t in corpus()]
    got = {r.doc_id: r.n_tokens for r in tokencount.token_counts(frame(spark, rows)).collect()}
    for i, t in rows:
        n = len(want.encode("▁" + t.replace(" ", "▁"), add_special_tokens=False).ids) if t else 0
        assert got[i] == n, repr(t)


def test_ties_go_to_the_piece_that_starts_first():
    pieces = [("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("aaa", -3.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0)]
    want, own = unigram(pieces), tokencount.Counter(pieces)
    r = random.Random(1)
    for _ in range(500):
        t = "".join(r.choice("aabc") for _ in range(r.randint(1, 14)))
        assert own.word("▁" + t)[0] == len(want.encode("▁" + t, add_special_tokens=False).ids), t


def test_empty(spark):
    assert tokencount.token_counts(frame(spark, [])).count() == 0
    assert [r.n_tokens for r in tokencount.token_counts(frame(spark, [(1, None), (1, "")])).collect()] == [0, 0]


def test_unlike_words_whose_polynomials_agree(spark):
    pieces = tokencount.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    want = unigram(pieces)
    rows = [(10 * k + j, w + tail) for k in (10, 11, 12) for j, (w, tail) in enumerate((w, t) for t in ("", " b") for w in thue_morse(k))]
    got = {r.doc_id: r.n_tokens for r in tokencount.token_counts(frame(spark, rows).coalesce(1)).collect()}
    assert got == {i: len(want.encode("▁" + t.replace(" ", "▁"), add_special_tokens=False).ids) for i, t in rows}

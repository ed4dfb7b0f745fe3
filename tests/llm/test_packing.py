import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from trafficloom.llm import packing
from trafficloom.llm.tokens import Encoder

from .util import corpus, frame, thue_morse

ODD = ["it's John's 'save they've I'll 'RE  x", "a  b   c\n\n d\t\te \n", "  lead", "tail  ", "٣٤ 12³ x²", "a  b", "<|endoftext|> a<|endoftext|>", "''s 's's don't", "日本語 テスト🙂🙂 ok", "'", "x'", " 's", "\n's 're\t've"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(texts, tokenizer):
    own = Encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, 50256)
    raw = [t.encode() for t in texts]
    ids, cut = own.encode(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in raw]))))
    for k, t in enumerate(texts):
        assert ids[cut[k] : cut[k + 1]].tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


def test_ids_equal_the_tokenizer(tokenizer):
    check([t for _, t in corpus() if t is not None], tokenizer)
    for t in ODD:
        check([t], tokenizer)
    check([t for t in ODD if "<|" not in t], tokenizer)
    check(["", "", "a", ""], tokenizer)
    r = random.Random(5)
    check(["".join(r.choice("ab's're tlvmd  \n\t.,!'9é 語") for _ in range(r.randint(0, 40))) for _ in range(3000)], tokenizer)


def test_unlike_words_whose_polynomials_agree(tokenizer):
    words = [w for k in (10, 11, 12) for w in thue_morse(k)]
    check(words, tokenizer)
    check([f"{a} {b} {a}" for a, b in zip(words, words[1:])], tokenizer)


def test_plan_is_whole_and_tight():
    r = random.Random(2)
    for n in (1, 7, 400):
        lengths = [r.choice((1, 5, 300, 700, 1024, 1025, 2047, 2048, r.randint(1, 2048))) for _ in range(n)]
        hist = {k: lengths.count(k) for k in set(lengths)}
        plan = packing.plan(hist)
        used = {}
        for length, _, base, many, each, at in plan.slots:
            for s in range(base, base + many):
                used.setdefault(s, []).extend((at + k * length, length) for k in range(each))
        assert dict(plan.rank) == hist and set(used) == set(range(plan.n))
        for parts in used.values():
            end = 0
            for at, length in sorted(parts):
                assert at == end
                end += length
            assert end <= 2048
        assert plan.n <= -(-sum(lengths) // 2048) * 1.25 + 1


def test_pack(spark, tokenizer):
    rows = corpus() + [(500, " ".join(f"word{i}" for i in range(3000))), (501, "same"), (501, "same"), (None, "same")]
    got = packing.pack(frame(spark, rows)).collect()
    assert len(got) == sum(max(1, -(-(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1) // 2048)) for _, t in rows)
    texts = {i: t for i, t in rows}
    for r in got:
        ids = tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [0]
        assert zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
        assert r.length == 2048 or r.piece == 0
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        end = 0
        for at, length in sorted(parts):
            assert at == end
            end += length
        assert end <= 2048
    assert packing.pack(frame(spark, [])).count() == 0

import hashlib
import json
import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from trafficloom.llm import bpe

from .util import corpus, frame, thue_morse

PATH = public_tokenizers.path("word_bpe_49k.json")


def texts():
    r = random.Random(5)
    odd = ["a  b", "  lead", "tail  ", "line\nfeed\x0b\x0c\x85\xa0 and", "日本語 テスト", "🙂🙂 x", "a" * 70 + "b", " ", "ñandú Größe été été Å", "ΑΣ ΣΑΣ İstanbul ẞ", "don't WE'LL they've 12345 1'd"]
    odd += ["x<|endoftext|>y", "<|startoftext|><|endoftext|>", "<|END", "a<|startoftext|> <|endoftext|>É", "</w> a</w>b </w", "!!!...,,;; --==>> ​­", "﻿bom", " x", "a\x1cb\x1fc", "²³½ Ⅷ", "ﬁﬀ ǅ", "x" * 3000]
    return odd + ["".join(r.choice("etaoin srhé ß\n語'sm.,!AÉ1") for _ in range(r.randint(1, 90))) for _ in range(400)]


def test_encodes_and_decodes_as_the_library(spark):
    want = Tokenizer.from_file(PATH)
    rows = [(i, t) for i, t in enumerate(texts())] + [(10_000 + i, t) for i, t in corpus()]
    rows += [(20_000 + i, w) for i, w in enumerate(thue_morse(12))]
    got = bpe.bpe_decode(bpe.bpe_encode(frame(spark, rows)))
    both = bpe.bpe_encode(frame(spark, rows), decoded=True)
    assert got.columns == both.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    assert sorted(map(repr, got.collect())) == sorted(map(repr, both.collect()))
    got = {r.doc_id: r for r in got.collect()}
    for i, t in rows:
        ids = want.encode(t or "", add_special_tokens=False).ids
        assert bpe.unpacked(bytes(got[i].ids)) == ids and got[i].n_tokens == len(ids), repr(t)
        assert got[i].decoded == want.decode(ids, skip_special_tokens=False), repr(t)


def plain(merges, vocab, word):
    """Merges as they are defined: the lowest rank, the leftmost of its places, until none is left."""
    parts = [*word[:-1], word[-1] + "</w>"]
    rank = {tuple(m): k for k, m in enumerate(merges)}
    while True:
        pairs = [(rank[p], k) for k, p in enumerate(zip(parts, parts[1:])) if p in rank]
        if not pairs:
            return [vocab[p] for p in parts]
        _, k = min(pairs)
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_small_vocabularies_against_the_plain_rule(tmp_path):
    r = random.Random(7)
    for trial in range(30):
        base = ["a", "b", "c", "a</w>", "b</w>", "c</w>"]
        tokens, merges = list(base), []
        while len(merges) < 25:  # many ties and stolen tokens: any two tokens may merge
            a, b = r.choice([t for t in tokens if not t.endswith("</w>")]), r.choice(tokens)
            if a + b not in tokens and len(a + b) < 12:
                merges.append([a, b])
                tokens.append(a + b)
        vocab = {t: i for i, t in enumerate(tokens)}
        file = {"version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": {"type": "Lowercase"}, "pre_tokenizer": {"type": "Whitespace"}, "post_processor": None, "decoder": None,
                "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "fuse_unk": False, "byte_fallback": False, "ignore_merges": False, "vocab": vocab, "merges": merges}}
        at = tmp_path / f"{trial}.json"
        at.write_text(json.dumps(file))
        coder = bpe.WordBpe(str(at))
        words = {"".join(r.choice("aabc") for _ in range(r.randint(1, 14))) for _ in range(200)}
        got = coder.encode_words(list(words))
        assert got == {w: plain(merges, vocab, w) for w in words}


def test_a_shared_prefix_is_encoded_once():
    coder, asked = bpe.WordBpe(PATH), []
    coder._trie = type("Seen", (dict,), {"get": lambda self, x: asked.append(x) or dict.get(self, x)})(coder._trie)
    coder.encode_words(["internation" + x for x in ("al", "ale", "als", "alism")])
    last = [chr(bpe._LAST + ord(c)) for c in "lesm"]
    assert sorted(asked) == sorted([*"international", *"is", *last])  # a token may begin at each node, which is asked once


def test_bounded_caches_change_nothing():
    coder, small = bpe.WordBpe(PATH), bpe.WordBpe(PATH)
    small.CACHE, small.PAIRS = 3, 5
    for t in texts():
        data = np.frombuffer(t.encode(), np.uint8)
        offsets = np.array([0, len(data)])
        assert coder.encode(data, offsets)[0].tolist() == small.encode(data, offsets)[0].tolist()


def test_empty_null_and_repeated_rows(spark):
    assert bpe.bpe_decode(bpe.bpe_encode(frame(spark, []))).count() == 0
    rows = bpe.bpe_decode(bpe.bpe_encode(frame(spark, [(1, None), (1, ""), (None, "a b"), (None, "a b"), (2, " \n")]))).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.decoded) for r in rows) == [(0, 2, "a</w> b</w>")] * 2 + [(1, 0, "")] * 2 + [(2, 0, "")]
    clash = spark.createDataFrame([("x", "a", b"1")], "n_tokens string, text string, ids binary")
    assert [tuple(r)[:2] for r in bpe.bpe_encode(clash.withColumnRenamed("n_tokens", "id"), "id").collect()] == [("x", 1)]
    none = spark.createDataFrame([(None, "k")], "ids binary, decoded string")
    assert bpe.bpe_decode(none).collect()[0].decoded is None


def test_query(spark, tmp_path):
    frame(spark, [(1, "Hello WORLD"), (2, None)]).write.parquet(f"{tmp_path}/documents.parquet")
    want = Tokenizer.from_file(PATH)
    for r in bpe.op12_bpe(spark, str(tmp_path)).collect():
        ids = want.encode("Hello WORLD" if r.doc_id == 1 else "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(want.decode(ids, skip_special_tokens=False).encode()).hexdigest()

"""BPE with word ends: distinct words go into a trie, whose prefixes are encoded once each, and ids go back to text."""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, chunks, distinct_spans, documents, word_spans

END = "</w>"
#: What the given vocabulary file does before merging. Printable ASCII then has a shorter way with the same result.
_NORMAL = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_ASCII = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
#: Bytes of text whose distinct words share a trie.
CHUNK = 1 << 21
#: Added to a word's last symbol, so that a symbol is one character whether it ends a word or not.
_LAST = 0x100000


def _last(symbol: str) -> str:
    return chr(_LAST + ord(symbol))


class Recent:
    """What was put in or asked for lately: two tables, of which the older one goes when the newer one is full."""

    def __init__(self):
        self._new, self._old = {}, {}

    def get(self, key, limit: int):
        found = self._new.get(key)
        if found is None:
            found = self._old.get(key)
            if found is not None:
                self.put(key, found, limit)
        return found

    def put(self, key, value, limit: int) -> None:
        if len(self._new) >= limit:
            self._old, self._new = self._new, {}
        self._new[key] = value


class WordBpe:
    """Ids of texts under a tokenizers file of BPE merges with word ends; kept for a worker's life, its caches bounded.

    The file's own normalizer and pre-tokenizer say what the words of a text are, once for each distinct stretch without
    ASCII white space; merging is done here.
    """

    CACHE = 200_000  # in each of two tables
    REMEMBERED = 64  # bytes of the longest stretch, or characters of the longest word, that is remembered
    PAIRS = 200_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        file = _read(path)
        vocab, merges = file["model"]["vocab"], [m if isinstance(m, list) else m.split(" ") for m in file["model"]["merges"]]
        if file["model"].get("end_of_word_suffix") != END or file["decoder"] is not None:
            raise ValueError("a BPE file with word ends and without a decoder is asked for")
        tokenizer = Tokenizer.from_str(json.dumps(file | {"model": file["model"] | {"vocab": {}, "merges": []}, "added_tokens": []}))  # its merges aren't used
        self._normal, self._pre = tokenizer.normalizer, tokenizer.pre_tokenizer
        written = {t: t if len(t) == 1 else _last(t[0]) for t in vocab if len(t) == 1 or len(t) == 1 + len(END) and t.endswith(END)}
        self._rank: dict[tuple[int, int], int] = {}
        self._parts: dict[int, tuple[int, int]] = {}
        self._made: dict[int, int] = {}  # rank of the merge that makes a token
        for rank, (a, b) in enumerate(merges):
            made = a + b
            written[made] = written[a] + written[b]
            left, right, both = vocab[a], vocab[b], vocab[made]
            if both in self._made or max(self._made.get(left, -1), self._made.get(right, -1)) >= rank:
                raise ValueError("each token must come from one merge of tokens that are made before it")
            self._rank[left, right], self._parts[both], self._made[both] = rank, (left, right), rank
        self._alone: dict[int, bool] = {}
        self._next_to: dict[int, bool] = {}
        # the trie of the tokens that stand alone: by symbol, the token that ends there (or -1) and the symbols after it
        self._trie: dict[str, list] = {}
        for token, symbols in written.items():
            if self._stands(vocab[token]):
                node = self._trie
                for c in symbols[:-1]:
                    node = node.setdefault(c, [-1, {}])[1]
                node.setdefault(symbols[-1], [-1, {}])[0] = vocab[token]
        self._special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self._split = re.compile("(" + "|".join(map(re.escape, sorted(self._special, key=len, reverse=True))) + ")") if self._special else None
        split = (file["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        self._usual = file["normalizer"] == _NORMAL and split.get("pattern") == {"Regex": _PATTERN} and split.get("invert") and split.get("behavior") == "Removed"
        self._words, self._stretches = Recent(), Recent()  # ids as bytes

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens that stand at a token's left (0) or right (1) end while it is being merged, each with the rank of the merge that takes it up."""
        out, up = [], float("inf")
        while True:
            out.append((token, up))
            if token not in self._parts:
                return out
            token, up = self._parts[token][side], self._made[token]

    def _merges_across(self, a: int, b: int, before: float) -> bool:
        """Whether a merge of a rank below `before` joins the end of a to the start of b while the two are being merged.

        A merge needs both of its tokens to stand at the border when its turn comes. Of equal merges the leftmost is
        done first: one inside a goes before the one across, which goes before one inside b.
        """
        for x, taken in self._edge(a, 1):
            for y, used in self._edge(b, 0):
                rank = self._rank.get((x, y))
                if rank is not None and rank < before and rank < taken and rank <= used:
                    return True
        return False

    def _stands(self, token: int) -> bool:
        """Whether a token's own symbols are encoded as that token."""
        known = self._alone.get(token)
        if known is None:
            known = True
            if token in self._parts:
                a, b = self._parts[token]
                known = self._stands(a) and self._stands(b) and not self._merges_across(a, b, self._made[token])
            self._alone[token] = known
        return known

    def _fit(self, a: int, b: int) -> bool:
        """Whether two tokens can follow each other in an encoding."""
        pair = a << 32 | b
        known = self._next_to.get(pair)
        if known is None:
            if len(self._next_to) > self.PAIRS:
                self._next_to.clear()
            known = self._next_to[pair] = not self._merges_across(a, b, float("inf"))
        return known

    def encode_words(self, words: list[str]) -> dict[str, list[int]]:
        """Ids of distinct words (of the pre-tokenizer's characters).

        A prefix's encoding is that of a shorter prefix and one token more: the only token that ends the prefix, stands
        alone and fits the last token of the shorter one. So a node of the words' trie has its last token and where that
        begins as its state, and which parts of the path to it may still grow to a token. Words in sorted order visit the
        trie depth first; the states of the path to the present word are kept, those of a prefix that the next word
        shares are used again.
        """
        out: dict[str, list[int]] = {}
        first, pairs, fit = self._trie, self._next_to, self._fit
        token, start, growing = [-1], [0], [[]]  # by depth; growing: where a part begins, and what may follow it in a token
        path = ""
        for word, w in sorted((x[:-1] + _last(x[-1]), x) for x in words):
            shared, most = 0, min(len(path), len(word))
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del token[shared + 1 :], start[shared + 1 :], growing[shared + 1 :]
            for depth in range(shared, len(word)):
                symbol, now, best = word[depth], [], -1
                for at, after in (*growing[depth], (depth, first)):
                    found = after.get(symbol)
                    if found is not None:
                        t, after = found
                        if after:
                            now.append((at, after))
                        if best < 0 <= t:
                            if at:
                                fits = pairs.get(token[at] << 32 | t)
                                if not (fit(token[at], t) if fits is None else fits):
                                    continue
                            best = t
                            start.append(at)
                if best < 0:
                    raise ValueError(f"no token for the end of {w!r}")
                token.append(best)
                growing.append(now)
            path, depth, ids = word, len(word), []
            while depth:
                ids.append(token[depth])
                depth = start[depth]
            out[w] = ids[::-1]
        return out

    def _pieces(self, stretch: str) -> list[str | int]:
        """Words, and ids of special tokens, of a stretch of text."""
        out: list[str | int] = []
        for k, part in enumerate(self._split.split(stretch) if self._split else [stretch]):
            if k % 2:
                out.append(self._special[part])
            elif self._usual and part.isascii() and part.isprintable():
                out += _ASCII.findall(part.lower())
            elif part:
                out += [w for w, _ in self._pre.pre_tokenize_str(self._normal.normalize_str(part))]
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents one after the other, where each document starts and the end)."""
        at, to, doc = word_spans(data, offsets)
        if not len(at):
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        solid, size = data[~WHITE[data]], to - at
        to = np.cumsum(size)
        at = to - size
        sample, which = distinct_spans(solid, at, to)
        raw, recent, words, limit = solid.tobytes(), self._stretches, self._words, self.CACHE
        found, new = [], {}
        for k, (a, b) in enumerate(zip(at[sample].tolist(), to[sample].tolist())):
            ids = recent.get(x := raw[a:b], limit)
            found.append(ids)
            if ids is None:
                new[k] = (x, self._pieces(x.decode()))
        asked = {w for _, pieces in new.values() for w in pieces if isinstance(w, str)}
        have = {w: ids for w in asked if (ids := words.get(w, limit)) is not None}
        for w, ids in self.encode_words([w for w in asked if w not in have]).items():
            have[w] = array("I", ids).tobytes()
            if len(w) <= self.REMEMBERED:
                words.put(w, have[w], limit)
        for k, (x, pieces) in new.items():
            found[k] = b"".join(have[p] if isinstance(p, str) else array("I", (p,)).tobytes() for p in pieces)
            if len(x) <= self.REMEMBERED:
                recent.put(x, found[k], limit)
        length = np.array([len(x) >> 2 for x in found], np.int64)
        pool, base, many = np.frombuffer(b"".join(found), np.uint32), np.cumsum(length) - length, length[which]
        ends = np.cumsum(many)
        ids = pool[np.repeat(base[which] - (ends - many), many) + np.arange(ends[-1])]
        return ids, np.concatenate(([0], ends))[np.searchsorted(doc, np.arange(len(offsets)))]


class Spellings:
    """The tokens of a tokenizers file as its vocabulary writes them."""

    #: Ids that one vectorised step takes; a longer single document is one step.
    STEP = 1 << 17

    def __init__(self, path: str):
        file = _read(path)
        names = {**{i: t for t, i in file["model"]["vocab"].items()}, **{t["id"]: t["content"] for t in file["added_tokens"]}}
        spelled = [names.get(i, "").encode() for i in range(max(names) + 1)]
        self._size = np.array([len(x) + 1 for x in spelled], np.int64)
        self._at = np.cumsum(self._size) - self._size
        self._spelled = np.frombuffer(b" ".join(spelled) + b" ", np.uint8)

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> list[bytes]:
        """Each document's tokens joined by spaces. starts: where each document starts among the ids, and the end."""
        if not len(ids):
            return [b""] * (len(starts) - 1)
        size = self._size[ids]
        ends = np.cumsum(size)
        raw = self._spelled[np.repeat(self._at[ids] - (ends - size), size) + np.arange(ends[-1])].tobytes()
        edge = np.concatenate(([0], ends))[starts].tolist()
        return [raw[a : max(a, b - 1)] for a, b in zip(edge[:-1], edge[1:])]


def _read(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


_made: dict[tuple[type, str], object] = {}


def _once(kind: type, path: str):
    """The coder of a file, made once in a worker's life."""
    return _made.get((kind, path)) or _made.setdefault((kind, path), kind(path))


def _file(path: str | None) -> str:
    import public_tokenizers

    return path or public_tokenizers.path("word_bpe_49k.json")


def bpe_encode(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str | None = None, decoded: bool = False) -> DataFrame:
    """(id_col, n_tokens, ids), one row per row of `docs`, from whole texts; no shuffle. ids: little-endian 32-bit numbers, as `unpacked` lists them.

    Equal to the tokenizers library with the same file, without added special tokens, truncation and padding; the
    strings of special tokens in a text are those tokens. decoded: with the column decoded, what `bpe_decode` makes of the
    ids, in the same pass. Null, empty and blank texts have no ids. Rows of an id that is repeated or null, and other columns
    of whatever name, do not matter.
    """
    file = _file(path)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        coder, spelling = _once(WordBpe, file), _once(Spellings, file) if decoded else None
        for rows, data, offsets in chunks(batches, "_text", CHUNK):
            ids, starts = coder.encode(data, offsets)
            raw, edge = ids.astype("<u4").tobytes(), (starts * 4).tolist()
            columns = [rows.column(0), pa.array(np.diff(starts)), pa.array([raw[a:b] for a, b in zip(edge[:-1], edge[1:])], pa.binary())]
            if spelling:
                columns.append(_texts(spelling.decode(np.frombuffer(raw, "<u4"), starts)))
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n_tokens", "ids", "decoded"][: len(columns)])

    return docs.select(id_col, F.col(text).alias("_text")).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids binary" + ", decoded string" * decoded)


def _texts(values: list[bytes | None]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def bpe_decode(encoded: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """`encoded` with `out`, the tokens of `ids` as the library's decode writes them (special tokens too); no shuffle. Null ids: null."""
    from pyspark.sql import types as T

    file = _file(path)
    rest = [c for c in encoded.columns if c != out]
    schema = T.StructType([*[encoded.schema[c] for c in rest], T.StructField(out, T.StringType())])

    def run(batches):
        coder = _once(Spellings, file)
        for whole in batches:
            edge = np.cumsum([0, *[len(x or b"") >> 2 for x in whole.column(rest.index(ids)).to_pylist()]])
            at = 0
            while at < whole.num_rows:
                to = max(at + 1, int(np.searchsorted(edge, edge[at] + coder.STEP, "right")) - 1)
                b = whole.slice(at, to - at)
                packed = b.column(rest.index(ids)).to_pylist()
                text = coder.decode(np.frombuffer(b"".join(x or b"" for x in packed), "<u4"), edge[at : to + 1] - edge[at])
                text = _texts([None if x is None else t for x, t in zip(packed, text)])
                yield pa.RecordBatch.from_arrays([*b.columns, text], names=[*rest, out])
                at = to

    return encoded.select(*rest).mapInArrow(run, schema)


def unpacked(ids: bytes) -> list[int]:
    """The numbers in a value of `ids`."""
    return np.frombuffer(ids, "<u4").tolist()


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe_encode(documents(spark, sf_dir), decoded=True)
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))

"""Byte-level BPE ids of whole texts, with each distinct pre-token of a batch encoded once."""

from __future__ import annotations

import base64
import unicodedata
from functools import lru_cache

import numpy as np

from .common import distinct_spans

#: Special token whose string in a text is one id.
SPECIAL = "<|endoftext|>"
_OTHER, _LETTER, _NUMBER, _SPACE = 0, 1, 2, 3
#: White space of the pattern's \\s.
_SPACES = [0x20, *range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(1)
def _classes() -> np.ndarray:
    kind = {"L": _LETTER, "N": _NUMBER}
    table = np.fromiter((kind.get(unicodedata.category(chr(c))[0], _OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    table[_SPACES] = _SPACE
    return table


def pretoken_starts(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Marks the first code point of each match of the byte-level BPE pattern

        's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

    points: code points of several documents; starts: where each document starts.
    """
    n = len(points)
    kind = _classes()[points]
    doc = np.zeros(n + 1, bool)
    doc[starts] = True
    doc[n] = True
    cut = doc.copy()
    cut[1:n] |= kind[1:] != kind[:-1]
    # the last white space before a word: a space joins the word, another one stands alone
    at = np.flatnonzero(cut[:n] & ~doc[:n] & (kind != _SPACE))
    at = at[kind[at - 1] == _SPACE]
    cut[at - 1] = True
    cut[at[points[at - 1] == 0x20]] = False
    # contractions: a lone apostrophe takes the letters that follow it
    q = np.flatnonzero(cut[:n] & (points == 0x27))
    q = q[~doc[q + 1]]
    q = q[(kind[q + 1] == _LETTER)]
    if len(q):
        a = points[q + 1]
        b = np.where(doc[q + 2], 0, points[np.minimum(q + 2, n - 1)])
        short = np.isin(a, [ord(c) for c in "stmd"])
        long = np.zeros(len(q), bool)
        for x, y in ("re", "ve", "ll"):
            long |= (a == ord(x)) & (b == ord(y))
        for rows, size in ((q[short], 2), (q[long], 3)):
            cut[rows + 1] = False
            cut[rows + size] = True
    return cut[:n]


class Encoder:
    """Ids of a vocabulary of ranks (base64 token, rank per line); kept for a worker's life. Its cache is bounded."""

    CACHE = 200_000
    REMEMBERED = 64  # bytes of the longest pre-token that is remembered

    def __init__(self, ranks_path: str, pattern: str, special_id: int | None = None):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._bpe = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={} if special_id is None else {SPECIAL: special_id})
        self._special = None if special_id is None else SPECIAL.encode()
        self._ids: dict[bytes, bytes] = {}

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self._bpe.encode(text, allowed_special="all", disallowed_special=()), np.uint32)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all documents one after the other, where each document starts and the end)."""
        n_docs = len(offsets) - 1
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(n_docs + 1, np.int64)
        raw = data.tobytes()
        if self._special is not None and self._special in raw:  # rare: its string may be split by the pattern
            each = [self._whole(raw[a:b].decode()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            return np.concatenate(each), np.concatenate(([0], np.cumsum([len(x) for x in each])))
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        at = lead[pretoken_starts(points, np.searchsorted(lead, offsets[:-1][offsets[:-1] < len(data)]))]
        to = np.append(at[1:], len(data))
        sample, which = distinct_spans(data, at, to)
        if len(self._ids) > self.CACHE:
            self._ids.clear()
        have, encode, found = self._ids, self._bpe.encode_ordinary, []
        for a, b in zip(at[sample].tolist(), to[sample].tolist()):
            word = raw[a:b]
            ids = have.get(word)
            if ids is None:
                ids = np.array(encode(word.decode()), np.uint32).tobytes()
                if b - a <= self.REMEMBERED:
                    have[word] = ids
            found.append(ids)
        size = np.array([len(x) >> 2 for x in found], np.int64)
        pool, base = np.frombuffer(b"".join(found), np.uint32), np.cumsum(size) - size
        many = size[which]
        ends = np.cumsum(many)
        ids = pool[np.repeat(base[which] - (ends - many), many) + np.arange(ends[-1])]
        return ids, np.concatenate(([0], ends))[np.searchsorted(at, offsets)]

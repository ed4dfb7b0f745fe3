"""Token counts without tokens: Viterbi over the pieces of a unigram vocabulary, carrying score and piece count only."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import chunks, distinct_spans, documents

SPACE = "▁"
#: How far an unknown character scores below the worst piece.
UNKNOWN_PENALTY = 10.0


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, less control, byte, unknown and placeholder pieces (scored -1e9)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return [(model.id_to_piece(i), model.get_score(i)) for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)) and model.get_score(i) > -1e8]


class Counter:
    """Best segmentations of words under a unigram vocabulary. Words are remembered up to a bound."""

    CACHE = 300_000
    REMEMBERED = 64  # characters of the longest word that is remembered

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self._find = ahocorasick.Automaton()
        for piece, score in pieces:
            if SPACE in piece.lstrip(SPACE):
                raise ValueError("a piece may hold the word sign at its start only: words are counted apart")
            self._find.add_word(piece, (len(piece), score))
        self._find.make_automaton()
        self._single = {p for p, _ in pieces if len(p) == 1}
        self._unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self._known: dict[tuple[bytes, bool], tuple[int, float, int]] = {}

    def word(self, text: str) -> tuple[int, float, int]:
        """(pieces, score, unknown characters' bytes) of the best path.

        The automaton gives the matches that end at a character, longest first. A later candidate must score more to
        win, so of equal paths the one whose last piece starts first stays; an unknown character is tried last. Its
        bytes count as a piece each.
        """
        n = len(text)
        best: list[float | None] = [0.0] + [None] * n
        count, odd = [0] * (n + 1), [0] * (n + 1)
        done = 0

        def unknown(at: int) -> None:
            c = text[at]
            if c not in self._single:
                score = best[at] + self._unknown
                if best[at + 1] is None or score > best[at + 1]:
                    size = len(c.encode())
                    best[at + 1], count[at + 1], odd[at + 1] = score, count[at] + size, odd[at] + size

        for end, (size, score) in self._find.iter(text):
            end += 1
            while done < end - 1:
                unknown(done)
                done += 1
            start = end - size
            total = best[start] + score
            if best[end] is None or total > best[end]:
                best[end], count[end], odd[end] = total, count[start] + 1, odd[start]
        while done < n:
            unknown(done)
            done += 1
        return count[n], best[n], odd[n]

    def count(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Pieces, scores and unknown bytes of documents. A word goes from the first space before it to the next space after it."""
        n_docs, n = len(offsets) - 1, len(data)
        out = [np.zeros(n_docs, np.int64), np.zeros(n_docs), np.zeros(n_docs, np.int64)]
        if not n:
            return out
        space = data == 0x20
        first = space.copy()
        first[1:] &= ~space[:-1]
        starts = np.unique(offsets[:-1][np.diff(offsets) > 0])
        lead = np.zeros(n, bool)
        lead[starts] = True  # takes the word sign that stands before every text
        at = np.flatnonzero(first | lead)
        to = np.append(at[1:], n)
        head = lead[at]
        # at a text's start a word without a space has the sign all the same
        sample, which = distinct_spans(data, at, to, head.astype(np.uint64))
        raw, known = data.tobytes(), self._known
        if len(known) > self.CACHE:
            known.clear()
        found = []
        for a, b, h in zip(at[sample].tolist(), to[sample].tolist(), head[sample].tolist()):
            key = (raw[a:b], h)
            got = known.get(key)
            if got is None:
                got = self.word((SPACE if h else "") + key[0].decode().replace(" ", SPACE))
                if b - a <= self.REMEMBERED:
                    known[key] = got
            found.append(got)
        doc = np.searchsorted(offsets, at, "right") - 1
        for k, values in enumerate(zip(*found)):
            out[k] = np.bincount(doc, np.array(values, float)[which], minlength=n_docs)
        return [out[0].astype(np.int64), out[1], out[2].astype(np.int64)]


def token_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", model_path: str | None = None) -> DataFrame:
    """(id_col, n_tokens, score, n_unknown_bytes), one row per row of `docs`, from whole texts; no shuffle.

    A text begins with the word sign, and a space is a word sign. score is the best path's sum of piece scores; bytes of
    characters outside the vocabulary count as a token each. Null and empty texts have no tokens and score 0.
    """
    import public_tokenizers

    path = model_path or public_tokenizers.path("piece_bpe_32k.model")
    kind = docs.schema[id_col].dataType.simpleString()
    state: dict[str, Counter] = {}

    def run(batches):
        counter = state.get(path) or state.setdefault(path, Counter(vocabulary(path)))
        for rows, data, offsets in chunks(batches, text):
            n, score, odd = counter.count(data, offsets)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(n), pa.array(score), pa.array(odd)], names=[id_col, "n_tokens", "score", "n_unknown_bytes"])

    return docs.select(id_col, text).mapInArrow(run, f"{id_col} {kind}, n_tokens long, score double, n_unknown_bytes long")


def op3_tokencount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))

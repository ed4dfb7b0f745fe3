"""Toxicity by noisy-channel deobfuscation: disguised words are restored under a character model, then scored."""

from __future__ import annotations

import math
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, documents, materialize, word_spans
from .fingerprint import sketches

#: The classifier is fitted on at most so many labelled rows of either class, those of the least hash.
MAX_ROWS_PER_CLASS = 10_000
#: Least log-odds ratio of a feature.
MIN_WEIGHT = 2.5
PREFIXES = (4, 5, 6)
#: Score of every text where there is nothing to learn from.
QUIET = 0.02
#: What a sign may stand for, and the log-probability of writing it so.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e"}
SUBSTITUTED, REPEATED, DROPPED = -1.5, -0.7, -0.5
FILLERS = ".-_*~^"
_STRIP = ".,;:?!\"'()[]{}<>«»“”‘’%&#*~^"
#: One-letter words in a row that may be a word written apart.
MIN_SPACED = 4

# --- the character model ----------------------------------------------------------------------------------------------

SIZE = 64
#: a-z and the small letters of Latin-1 have a number each; everything else is a boundary.
_NUMBER = np.zeros(0x110000, np.int32)
_NUMBER[97:123] = np.arange(1, 27)
_NUMBER[65:91] = np.arange(1, 27)
_NUMBER[0xDF:0x100] = np.arange(27, 60)
_NUMBER[0xC0:0xDF] = _NUMBER[0xE0:0xFF]
_NUMBER[0xF7] = _NUMBER[0xD7] = 0


def trigram_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of letter trigrams (boundaries included) over every whole text. The alphabet bounds the table at 64^3."""

    def run(batches):
        total = np.zeros(SIZE**3, np.int64)
        for _, data, offsets in chunks(batches, text):
            starts = np.unique(offsets[:-1])
            spaced = np.insert(data, starts, 32)
            n = _NUMBER[np.frombuffer(spaced.tobytes().decode().encode("utf-32-le"), np.uint32)]
            total += np.bincount((n[:-2] * SIZE + n[1:-1]) * SIZE + n[2:], minlength=SIZE**3) if len(n) > 2 else 0
        have = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(have), pa.array(total[have])], names=["g", "n"])

    out = np.zeros(SIZE**3, np.int64)
    for r in docs.select(text).mapInArrow(run, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).collect():
        out[r.g] = r.n
    return out


def language_model(counts: np.ndarray) -> np.ndarray:
    """log P(c | a, b), smoothed by P(c | b) and the uniform distribution."""
    tri = counts.reshape(SIZE, SIZE, SIZE).astype(np.float64)
    bi = tri.sum(axis=0)
    p2 = (bi + 0.5) / (bi.sum(axis=1, keepdims=True) + 0.5 * SIZE)
    return np.log((tri + 5 * p2[None]) / (tri.sum(axis=2, keepdims=True) + 5)).astype(np.float32)


def lattice(word: str) -> list[list[tuple[str, float]]]:
    """What each sign of a disguised word, with its repetitions, may stand for, and the log-probability of writing it so.

    A letter repeated stands for one or two of it, a sign of LEET for its letters, any other sign for nothing.
    """
    out = []
    for sign, run in groupby(word):
        times = sum(1 for _ in run)
        if _NUMBER[ord(sign)]:
            out.append([(sign * k, 0.0 if k == times else REPEATED) for k in (1, 2) if k <= times])
        elif sign in LEET:
            out.append([(c * k, SUBSTITUTED * k) for c in LEET[sign] for k in (1, 2) if k <= times])
        else:
            out.append([("", DROPPED)])
    return out


def restore(word: str, model: np.ndarray, apart: bool = False) -> str:
    """The likeliest plain word behind a disguised one, or words (apart): Viterbi over the lattice; with `apart` a boundary may stand before any of its letters.

    A state is the last two letters. The best paths are linked backwards, so a word of any length costs its length.
    """
    best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    for options in lattice(word):
        after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (score, path) in best.items():
            for letters, cost in options:
                for written in (letters, " " + letters) if apart and letters and b else (letters,):
                    x, y, s = a, b, score + cost
                    for c in written:
                        z = int(_NUMBER[ord(c)])
                        s += float(model[x, y, z])
                        x, y = y, z
                    if (x, y) not in after or s > after[x, y][0]:
                        after[x, y] = (s, (path, written) if written else path)
        best = after
    path = max(((s + float(model[a, b, 0]), p) for (a, b), (s, p) in best.items()), key=lambda x: x[0])[1]
    parts = []
    while path is not None:
        path, letters = path
        parts.append(letters)
    return "".join(reversed(parts))


# --- features -----------------------------------------------------------------------------------------------------------


def suspicious(word: str) -> bool:
    """Whether a word (folded, outer punctuation gone) may be a disguised one."""
    if len(word) < 3 or word.isalpha() and not any(a == b == c for a, b, c in zip(word, word[1:], word[2:])):
        return False
    return any(c.isalpha() for c in word)


def features(word: str) -> list[str]:
    return ["=" + word, *("^" + word[:k] for k in PREFIXES if len(word) > k)]


class Reader:
    """What a model sees in words; it remembers words it has seen, up to a bound."""

    CACHE = 300_000

    def __init__(self, model: np.ndarray | None, known: dict[str, float] | None = None):
        self.model, self.known, self._seen = model, known, {}

    def _read(self, token: str) -> tuple[str, ...]:
        word = token.strip(_STRIP)
        found = features(word) if word else []
        if self.model is not None:
            disguised = token.strip(".,;:?\"'()[]{}<>")
            if suspicious(disguised):
                found = [*found, *features(restore(disguised, self.model))]
        return self._signs(found)

    def _signs(self, found: list[str]) -> tuple[str, ...]:
        """All features while fitting; then the strongest known one, so that a word counts once."""
        if self.known is None:
            return tuple(found)
        return tuple(sorted((f for f in found if f in self.known), key=lambda f: (-self.known[f], f))[:1])

    def words(self, text: str) -> set[str]:
        """Features of a text's words; only known ones, if features are known."""
        if len(self._seen) > self.CACHE:
            self._seen.clear()
        seen, out = self._seen, set()
        for token in set(text.lower().split()):
            found = seen.get(token)
            if found is None:
                found = seen[token] = self._read(token)
            if found:
                out.update(found)
        return out

    def spaced(self, letters: str) -> set[str]:
        """Features of the words whose letters stand apart: of each likeliest word, and of the whole as one word."""
        if self.model is None:
            return set()
        words = {restore(letters, self.model), *restore(letters, self.model, apart=True).split()}
        return {f for w in words if len(w) > 2 for f in self._signs(features(w))}


def _spaced_words(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, str]]:
    """(document, letters) of every MIN_SPACED or more words of one code point that follow each other."""
    start, end, doc = word_spans(data, offsets)
    lead = data[start] if len(start) else data[:0]
    size = 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)
    one = np.concatenate(([False], end - start == size, [False]))
    rise, fall = np.flatnonzero(one[1:] & ~one[:-1]), np.flatnonzero(one[:-1] & ~one[1:])
    out = []
    for a, b in zip(rise.tolist(), fall.tolist()):
        if b - a < MIN_SPACED:
            continue
        for d in np.unique(doc[a:b]).tolist():
            own = np.flatnonzero(doc[a:b] == d) + a
            if len(own) >= MIN_SPACED:
                text = data[start[own[0]] : end[own[-1]]].tobytes().decode()
                out.append((d, "".join(text.split()).lower()))
    return out


def _read_all(reader: Reader, data: np.ndarray, offsets: np.ndarray) -> list[set[str]]:
    raw = data.tobytes()
    found = [reader.words(raw[a:b].decode()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    for d, letters in _spaced_words(data, offsets):
        found[d].update(reader.spaced(letters))
    return found


# --- fitting and scoring ------------------------------------------------------------------------------------------------


def held_out(id_column: Column) -> Column:
    return F.coalesce(F.crc32(id_column.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, model: np.ndarray | None, id_col: str = "doc_id", text: str = "text") -> tuple[dict[str, float], tuple[float, float]]:
    """Features with their log-odds ratios, and the logistic curve of their sum, from the labelled rows that are not held out.

    At most MAX_ROWS_PER_CLASS rows of either class are used, chosen by hash, so the sample is small enough to broadcast.
    A feature must be a better sign than chance over as many features as there are would give (likelihood ratio).
    """
    train = labels.where(~held_out(F.col(id_col)) & F.col("toxic").isin(0, 1)).select(F.col(id_col).alias("_id"), F.col("toxic").cast("int").alias("_toxic"))
    prior = {r["_toxic"]: r["count"] for r in train.groupBy("_toxic").count().collect()}
    picked = [train.where(f"_toxic = {k}").orderBy(F.xxhash64("_id"), "_id").limit(MAX_ROWS_PER_CLASS) for k in (0, 1)]
    sample = docs.join(F.broadcast(picked[0].unionByName(picked[1])), F.col(id_col) == F.col("_id")).select("_toxic", F.col(text).alias("_text"))
    sample = materialize(_unlike(sample))

    def run(batches):
        reader, counts = Reader(model), {}
        for rows, data, offsets in chunks(batches, "_text"):
            for toxic, found in zip(rows.column(0).to_pylist(), _read_all(reader, data, offsets)):
                for f in [*found, ""]:  # "": the rows themselves
                    counts.setdefault(f, [0, 0])[toxic] += 1
            if len(counts) > 200_000:
                yield _batch(counts)
                counts = {}
        yield _batch(counts)

    def _batch(counts):
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([v[1] for v in counts.values()], pa.int64()), pa.array([v[0] for v in counts.values()], pa.int64())], names=["f", "t", "c"])

    sums = sample.mapInArrow(run, "f string, t long, c long").groupBy("f").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    sums = materialize(sums)
    rows = sums.where("f = ''").first()
    if rows is None or not rows.t or not rows.c:
        return {}, (math.log(QUIET / (1 - QUIET)), 0.0)
    n = sums.count()
    share = rows.t / (rows.t + rows.c)
    part = lambda x, p: F.when(x > 0, x * F.log(x / ((F.col("t") + F.col("c")) * p))).otherwise(F.lit(0.0))
    gain = 2 * (part(F.col("t").cast("double"), share) + part(F.col("c").cast("double"), 1 - share))
    odds = (F.col("t") + 0.5) / (rows.t + 1) / ((F.col("c") + 0.5) / (rows.c + 1))
    best = sums.where("f <> ''").select("f", gain.alias("gain"), F.log(odds).alias("w")).where((F.log(odds) >= MIN_WEIGHT) & (F.col("gain") >= 2 * math.log(n)))
    # every sign that passes: they are signs of a sample of at most 2 * MAX_ROWS_PER_CLASS rows, whatever the corpus holds
    known = {r.f: r.w for r in best.orderBy("f").collect()}

    def weigh(batches):
        reader = Reader(model, known)
        for rows, data, offsets in chunks(batches, "_text"):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([sum(known[f] for f in found) for found in _read_all(reader, data, offsets)], pa.float64())], names=["y", "s"])

    seen = sample.mapInArrow(weigh, "y int, s double").groupBy("y", F.round("s", 1).alias("s")).count().orderBy("y", "s").collect()  # sums of at most 2 * MAX_ROWS_PER_CLASS rows
    y, x, m = (np.array([r[k] for r in seen], float) for k in ("y", "s", "count"))
    m *= np.where(y == 1, prior[1] / rows.t, prior[0] / rows.c)  # classes as frequent as among all labels
    return known, _logistic(x, y, m)


def _logistic(x: np.ndarray, y: np.ndarray, m: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of P(y = 1 | x) for rows of weight m, slightly held to 0; Newton's steps."""
    a = np.zeros(2)
    z = np.stack((np.ones_like(x), x), axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ a, -30, 30)))
        grad = z.T @ (m * (y - p)) - np.array([0, 1e-2]) * a
        a += np.linalg.solve((z * (m * p * (1 - p))[:, None]).T @ z + np.diag([1e-6, 1e-2]), grad)
    return float(a[0]), float(a[1])


def _unlike(sample: DataFrame) -> DataFrame:
    """The labelled sample without rows that share one of their four least shingle hashes at the same place: near copies are no more evidence than one."""

    def run(batches):
        for rows, data, offsets in chunks(batches, "_text"):
            low = [(s.view(np.int64).tolist() + [-1 - k for k in range(len(s), 4)])[:4] for s in sketches(data, offsets, k=4)]
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), *(pa.array([x[k] for x in low], pa.int64()) for k in range(4))], names=["_toxic", "_text", "h0", "h1", "h2", "h3"])

    sample = sample.mapInArrow(run, "_toxic int, _text string, h0 long, h1 long, h2 long, h3 long")
    for k in range(4):  # least rows are found before the shuffle, so copies do not meet in one task
        key = F.when(F.col(f"h{k}").between(-4, -1), F.xxhash64("_text")).otherwise(F.col(f"h{k}"))
        sample = sample.groupBy(key.alias("key")).agg(F.min_by(F.struct("*"), F.struct(F.xxhash64("_text"), "_toxic")).alias("r")).select("r.*")
    return sample.select("_toxic", "_text")


def _score(found: set[str], known: dict[str, float], curve: tuple[float, float]) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, curve[0] + curve[1] * sum(sorted(known[f] for f in found))))))


def scores(docs: DataFrame, fitted: tuple[dict[str, float], tuple[float, float]], model: np.ndarray | None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id_col, score): the curve at the summed weights of the signs in the text. Null and empty texts have no signs."""
    known, curve = fitted
    kind = docs.schema[id_col].dataType.simpleString()
    state: list[Reader] = []

    def run(batches):
        if not state:
            state.append(Reader(model, known))
        for rows, data, offsets in chunks(batches, text):
            out = [_score(found, known, curve) for found in _read_all(state[0], data, offsets)]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(out, pa.float64())], names=[id_col, "score"])

    return docs.select(id_col, text).mapInArrow(run, f"{id_col} {kind}, score double")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", restoring: bool = True) -> DataFrame:
    """(id_col, held_out, score, predicted), one row per row of `docs`.

    The character model is counted over all of `docs`; the features are fitted on `labels` (id_col, toxic). Without
    labels of both classes every score is QUIET. Rows with null ids are scored; they are not held out. Without `restoring`
    words are read as they are written.
    """
    model = language_model(trigram_counts(docs, text)) if restoring else None
    found = scores(docs, fit(docs, labels, model, id_col, text), model, id_col, text)
    return found.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` without the rows whose text is predicted to be toxic."""
    model = language_model(trigram_counts(docs, text))
    known, curve = fit(docs, labels, model, id_col, text)
    state: list[Reader] = []

    def run(batches):
        if not state:
            state.append(Reader(model, known))
        for rows, data, offsets in chunks(batches, text):
            keep = [_score(found, known, curve) < 0.5 for found in _read_all(state[0], data, offsets)]
            yield rows.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))

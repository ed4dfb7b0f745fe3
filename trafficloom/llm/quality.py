"""Line-first quality rules: lines that fail a rule go, then documents that lose too much of their text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import WHITE, chunks, documents, fold_ascii, mix64, prefix_hash, span_hash, word_spans

#: Base rules.
MIN_WORDS = 20
MAX_REPEATED_SHARE = 30  # percent of the words
REPEAT_WINDOW = 8
SYMBOLS = b"#*$%&|<>"
#: Line rules.
MAX_SYMBOLS_PER_WORD = 0.3  # punctuation: symbol characters a word
MAX_SHOUTS_PER_WORD = 0.5  # punctuation: '!' and '?' a word
MAX_UPPER_SHARE = 0.7  # punctuation: capitals among the letters of a line of several words
MIN_SHOUT_WORDS = 3
MAX_SEPARATORS_PER_WORD = 0.3  # navigation: menu separators a word
SEPARATORS = b"|>"
#: Boilerplate phrases of page frames.
BOILERPLATE = (
    b"all rights reserved",
    b"privacy policy",
    b"terms of use",
    b"terms of service",
    b"cookie policy",
    b"we use cookies",
    b"accept cookies",
    b"enable javascript",
    b"sign up for our newsletter",
    b"subscribe to our newsletter",
    b"click here to",
    b"read more",
    b"share this",
    b"back to top",
    b"skip to content",
    b"log in to",
    b"lorem ipsum",
)
MAX_STUTTER_SHARE = 0.3  # boilerplate: words equal to the one before, among a line's words
#: A document that keeps less than this share of its words is rejected.
MIN_KEPT_SHARE = 0.6

_IS_SYMBOL, _IS_SEPARATOR, _IS_SHOUT = (np.isin(np.arange(256), list(x)) for x in (SYMBOLS, SEPARATORS, b"!?"))
_IS_UPPER = np.isin(np.arange(256), list(range(65, 91)))
_IS_LETTER = _IS_UPPER | np.isin(np.arange(256), list(range(97, 123)))


def _sums(flags: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[to] - total[at]


def _measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    n_docs, n = len(offsets) - 1, len(data)
    start, end, doc = word_spans(data, offsets)
    prefix = prefix_hash(data)
    per_doc = np.bincount(doc, minlength=n_docs)
    out = {"n_words": per_doc}
    point = (data & 0xC0) != 0x80
    out["word_chars"] = _sums(point & ~WHITE[data], offsets[:-1], offsets[1:])
    out["n_symbols"] = _sums(_IS_SYMBOL[data], offsets[:-1], offsets[1:])

    # lines: every document has one more than it has line feeds
    feeds = np.flatnonzero(data == 10)
    feed_doc = np.searchsorted(offsets, feeds, "right") - 1
    line_at = np.concatenate((offsets[:-1], feeds + 1))
    line_doc = np.concatenate((np.arange(n_docs), feed_doc))
    order = np.lexsort((line_at, line_doc))
    line_at, line_doc = line_at[order], line_doc[order]
    line_to = np.append(line_at[1:] - 1, n)
    last = np.append(line_doc[1:] != line_doc[:-1], True)
    line_to[last] = offsets[line_doc[last] + 1]
    line_words = np.searchsorted(start, line_to) - np.searchsorted(start, line_at)
    full = np.flatnonzero(line_words)
    key = mix64(span_hash(prefix, line_at[full], line_to[full]) + mix64(line_doc[full].astype(np.uint64)))
    _, first = np.unique(key, return_index=True)
    again = np.ones(len(full), bool)
    again[first] = False
    repeated = np.zeros(len(line_at), bool)
    repeated[full[again]] = True
    out["n_dup_lines"] = np.bincount(line_doc[repeated], minlength=n_docs)

    # words in windows that the document has twice or more
    words = span_hash(prefix, start, end)
    m = len(words)
    covered = np.zeros(m + 1, np.int64)
    if m >= REPEAT_WINDOW:
        acc = np.zeros(m - REPEAT_WINDOW + 1, np.uint64)
        for k in range(REPEAT_WINDOW):
            acc = acc * np.uint64(0xD6E8FEB86659FD93) + words[k : m - REPEAT_WINDOW + 1 + k]
        at = np.flatnonzero(doc[: len(acc)] == doc[REPEAT_WINDOW - 1 :])
        _, which, count = np.unique(mix64(acc[at] + mix64(doc[at].astype(np.uint64))), return_inverse=True, return_counts=True)
        at = at[count[which] > 1]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + REPEAT_WINDOW, -1)
    out["n_repeat_words"] = np.bincount(doc[np.cumsum(covered)[:m] > 0], minlength=n_docs)
    out["base_failed"] = (per_doc < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEATED_SHARE * per_doc)

    # line rules
    share = lambda flags: _sums(flags, line_at, line_to) / np.maximum(line_words, 1)
    upper = _IS_UPPER[data]
    letters = _IS_LETTER[data]
    two = np.zeros(n, bool)  # capitals and letters of the Latin-1 supplement
    if n > 1:
        two[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80)
        upper = upper | (two & (data <= 0x9E))
        letters = letters | two
    capitals, letters = _sums(upper, line_at, line_to), _sums(letters, line_at, line_to)
    punctuation = (share(_IS_SYMBOL[data] & ~_IS_SEPARATOR[data]) > MAX_SYMBOLS_PER_WORD) | (share(_IS_SHOUT[data]) > MAX_SHOUTS_PER_WORD)
    punctuation |= (capitals > MAX_UPPER_SHARE * letters) & (line_words >= MIN_SHOUT_WORDS)
    navigation = share(_IS_SEPARATOR[data]) > MAX_SEPARATORS_PER_WORD
    boilerplate = repeated.copy()
    folded = fold_ascii(data).tobytes()
    for phrase in BOILERPLATE:
        at = folded.find(phrase)
        while at >= 0:
            boilerplate[np.searchsorted(line_at, at, "right") - 1] = True
            at = folded.find(phrase, at + 1)
    word_line = np.searchsorted(line_at, start, "right") - 1
    stutter = np.zeros(m, bool)
    stutter[1:] = (words[1:] == words[:-1]) & (word_line[1:] == word_line[:-1])
    boilerplate |= np.bincount(word_line[stutter], minlength=len(line_at)) > MAX_STUTTER_SHARE * line_words
    fails = (punctuation | navigation | boilerplate) & (line_words > 0)
    for name, rule in (("n_punctuation_lines", punctuation), ("n_navigation_lines", navigation), ("n_boilerplate_lines", boilerplate)):
        out[name] = np.bincount(line_doc[rule & (line_words > 0)], minlength=n_docs)
    out["kept_words"] = np.bincount(line_doc, np.where(fails, 0, line_words), minlength=n_docs).astype(np.int64)
    out["kept"] = ~out["base_failed"] & (out["kept_words"] >= MIN_KEPT_SHARE * per_doc)
    out["_fails"], out["_line_at"], out["_line_to"], out["_line_doc"] = fails, line_at, line_to, line_doc
    return out


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_punctuation_lines", "n_navigation_lines", "n_boilerplate_lines", "kept_words")


def line_quality(docs: DataFrame, id_col: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """One row per row of `docs`: id_col, the counts, base_failed, kept and (with_text) clean_text, the text without failing lines.

    A line that breaks a rule of punctuation (symbols, shouting), navigation (menu separators) or boilerplate (page-frame
    phrases, stuttered words, lines equal to an earlier one of the text) is removed. A text is rejected if a base rule fails (too few
    words, too many repeated ones) or if less than MIN_KEPT_SHARE of its words stay. Lines without words never fail.
    Null and blank texts have no words: base_failed.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for rows, data, offsets in chunks(batches, text):
            found = _measure(data, offsets)
            cols = [rows.column(0), *(pa.array(found[c].astype(np.int64)) for c in COUNTS), pa.array(found["base_failed"]), pa.array(found["kept"])]
            names = [id_col, *COUNTS, "base_failed", "kept"]
            if with_text:
                raw, lines = data.tobytes(), [[] for _ in range(len(offsets) - 1)]
                for d, a, b in zip(*(found[k][~found["_fails"]].tolist() for k in ("_line_doc", "_line_at", "_line_to"))):
                    lines[d].append(raw[a:b])
                cols.append(pa.array([b"\n".join(x).decode() for x in lines]))
                names.append("clean_text")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    extra = ", clean_text string" * with_text
    return docs.select(id_col, text).mapInArrow(run, f"{id_col} {kind}, {', '.join(c + ' long' for c in COUNTS)}, base_failed boolean, kept boolean{extra}")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality(documents(spark, sf_dir))


_PHRASES = " OR ".join(f"contains(lower(line), '{p.decode()}')" for p in BOILERPLATE)
_W = r"[^\x20\x09-\x0D]+"
_SYM = r"[#*$%&|<>]"
_LEADS = " || ' ' || ".join(["w", *(f"lead(w, {k}) OVER o" for k in range(1, REPEAT_WINDOW))])
ORACLE_SQL = rf"""
WITH raw AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL),
lines AS (SELECT *, regexp_extract_all(line, '{_W}') AS ws FROM raw),
full_lines AS (SELECT *, len(ws) AS words, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) > 1 AS again,
  len(regexp_extract_all(line, '[#*$%&<]')) AS sym, len(regexp_extract_all(line, '[!?]')) AS shout, len(regexp_extract_all(line, '[|>]')) AS sep,
  len(regexp_extract_all(line, '[A-ZÀ-Þ]')) AS capitals, len(regexp_extract_all(line, '[A-Za-zÀ-ÿ]')) AS letters,
  len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS stutter FROM lines WHERE len(ws) > 0),
ruled AS (SELECT *, sym::DOUBLE / words > {MAX_SYMBOLS_PER_WORD}::DOUBLE OR shout::DOUBLE / words > {MAX_SHOUTS_PER_WORD}::DOUBLE OR (capitals > {MAX_UPPER_SHARE}::DOUBLE * letters AND words >= {MIN_SHOUT_WORDS}) AS punctuation,
  sep::DOUBLE / words > {MAX_SEPARATORS_PER_WORD}::DOUBLE AS navigation, again OR stutter > {MAX_STUTTER_SHARE}::DOUBLE * words OR {_PHRASES} AS boilerplate FROM full_lines),
per_doc AS (SELECT doc_id, sum(words)::BIGINT AS n_words, count_if(again) AS n_dup_lines, count_if(punctuation) AS n_punctuation_lines, count_if(navigation) AS n_navigation_lines, count_if(boilerplate) AS n_boilerplate_lines,
  sum(CASE WHEN punctuation OR navigation OR boilerplate THEN 0 ELSE words END)::BIGINT AS kept_words FROM ruled GROUP BY doc_id),
words AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (SELECT doc_id, regexp_extract_all(text, '{_W}') AS ws FROM documents)),
windows AS (SELECT doc_id, i, {_LEADS} AS body FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, i FROM windows WHERE body IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, body) > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n FROM twice, range({REPEAT_WINDOW}) r(k) GROUP BY doc_id),
counts AS (SELECT d.doc_id, coalesce(p.n_words, 0) AS n_words, coalesce(length(array_to_string(regexp_extract_all(text, '{_W}'), '')), 0) AS word_chars, coalesce(len(regexp_extract_all(text, '{_SYM}')), 0) AS n_symbols,
  coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, coalesce(n_punctuation_lines, 0)::BIGINT AS n_punctuation_lines, coalesce(n_navigation_lines, 0)::BIGINT AS n_navigation_lines, coalesce(n_boilerplate_lines, 0)::BIGINT AS n_boilerplate_lines, coalesce(kept_words, 0) AS kept_words
  FROM documents d LEFT JOIN per_doc p ON p.doc_id = d.doc_id LEFT JOIN repeats r ON r.doc_id = d.doc_id)
SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_SHARE} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_SHARE} * n_words) AND kept_words >= {MIN_KEPT_SHARE}::DOUBLE * n_words AS kept FROM counts
"""

"""Secret scans in DataFrame functions: known shapes, and windows of high entropy in candidate strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents

#: Base kinds, in their order: pattern, group whose length counts, least length.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
)
#: A cheap test that every text with a match of the kind passes.
MAY_HOLD = {
    "assign": lambda t: F.lower(t).rlike("passw|secret|token|api_?key"),
    "access": lambda t: t.contains("AKIA"),
    "hex": lambda t: t.rlike("[0-9a-f]{32}"),
}
#: Entropy: candidate strings, window in characters, least bits a character by class of the candidate.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
CLASSES = (("hex", r"^[0-9A-Fa-f]+$", 3.0), ("base64", r"^[A-Za-z0-9+/_=-]+$", 3.6))
BLOCK = 256  # characters of a candidate that are walked at once
#: Allow-list: candidates that are not random: no digit or no letter, UUIDs, words joined by one sign, paths, dates.
ALLOW = (
    r"^[^0-9]*$",
    r"^[^A-Za-z]*$",
    r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
    r"^[A-Za-z]*([-_/=+][A-Za-z]+|[-_/=+][0-9]{1,4})*[-_/=+]*$",
    r"^/?([a-z0-9_-]{1,16}/){2,}[a-z0-9_-]{0,16}$",
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[A-Za-z0-9_-]{0,12}$",
)


def _spans(text: Column, pattern: str, kind: str, rank: int, group: int, least: int, may: Column) -> Column:
    """array<struct<start, rank, kind, end>> of the matches whose group is long enough; offsets in code points, end exclusive.

    A match starts after the texts between matches and the matches before it.
    """
    empty = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = hits if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    rows = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), hits.alias("hit"), values.alias("value"))
    start = F.struct(F.lit(0).alias("at"), empty.alias("found"))

    def step(acc, row):
        at = acc["at"] + F.length(row["gap"])
        to = at + F.coalesce(F.length(row["hit"]), F.lit(0))
        span = F.struct(at.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), to.alias("end"))
        return F.struct(to.alias("at"), F.when(F.length(row["value"]) >= least, F.array_append(acc["found"], span)).otherwise(acc["found"]).alias("found"))

    return F.when(may, F.aggregate(rows, start, step, lambda acc: acc["found"])).otherwise(empty)


def _count(text: Column, char: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, char, F.lit("")))


def _xlogx(n: Column) -> Column:
    return F.when(n > 0, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))


def entropy_range(text: Column, least: Column, window: int = WINDOW) -> Column:
    """struct<low, high>: where the windows of at least `least` bits a character begin and end in the string; nulls if there are none.

    With counts c of the characters of a window of w, entropy is log2 w - sum(c log2 c) / w. A step takes the first
    character's count down by one and the next one's up by one, and changes only their two terms of the sum. A string is
    walked in blocks that overlap by a window, so a long one costs no more a character than a short one.
    """
    log_w = F.log2(F.lit(float(window)))
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.length(text) - window, F.lit(0)), F.lit(BLOCK)), lambda b: F.struct(b.alias("b"), F.substring(text, b + 1, F.lit(BLOCK + window - 1)).alias("x")))

    def walk(block):
        x, b = block["x"], block["b"]
        first = F.substring(x, F.lit(1), F.lit(window))
        chars = F.array_distinct(F.split(first, ""))
        s0 = F.aggregate(chars, F.lit(0.0), lambda s, c: s + F.when(c == "", F.lit(0.0)).otherwise(_xlogx(_count(first, c))))
        none = F.lit(None).cast("int")
        hit0 = F.round(log_w - s0 / window, 9) >= least
        state = F.struct(s0.alias("s"), F.when(hit0, b).otherwise(none).alias("low"), F.when(hit0, b + window).otherwise(none).alias("high"))

        def step(acc, k):  # the window that begins at k (from 1) of the block
            rest = F.substring(x, k + 1, F.lit(window - 1))
            out, into = F.substring(x, k, F.lit(1)), F.substring(x, k + window, F.lit(1))
            c_out, c_in = _count(rest, out), _count(rest, into)
            s = acc["s"] - _xlogx(c_out + 1) + _xlogx(c_out) + _xlogx(c_in + 1) - _xlogx(c_in)
            hit = F.round(log_w - s / window, 9) >= least
            return F.struct(s.alias("s"), F.coalesce(acc["low"], F.when(hit, b + k)).alias("low"), F.when(hit, b + k + window).otherwise(acc["high"]).alias("high"))

        steps = F.when(F.length(x) > window, F.sequence(F.lit(1), F.length(x) - window)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, state, step)

    found = F.transform(blocks, walk)
    return F.struct(F.array_min(F.transform(found, lambda f: f["low"])).alias("low"), F.array_max(F.transform(found, lambda f: f["high"])).alias("high"))


def _pieces(c: Column, base: Column) -> Column:
    """array<struct<start, end>> of the parts of a candidate, of a window's length at least, that no base span covers."""
    empty = F.array().cast("array<struct<start:int,end:int>>")
    piece = lambda at, to: F.struct(at.alias("start"), to.alias("end"))
    added = lambda found, at, to: F.when(to - at >= WINDOW, F.array_append(found, piece(at, to))).otherwise(found)
    covering = F.filter(base, lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"]))
    start = F.struct(c["start"].alias("at"), empty.alias("found"))
    step = lambda acc, s: F.struct(F.greatest(acc["at"], s["end"]).alias("at"), added(acc["found"], acc["at"], s["start"]).alias("found"))
    return F.aggregate(covering, start, step, lambda acc: added(acc["found"], acc["at"], c["end"]))


def _entropy_spans(text: Column, base: Column) -> Column:
    """Spans of kind entropy, where what base spans leave of a candidate is not on the allow-list and holds random windows."""
    candidates = _spans(text, CANDIDATE, "entropy", len(BASE), 0, WINDOW, text.rlike(CANDIDATE))

    def judge(c):
        x = F.substring(text, c["start"] + 1, c["end"] - c["start"])
        listed = F.lit(False)
        for rule in ALLOW:
            listed = listed | x.rlike(rule)
        least = F.lit(CLASSES[-1][2])
        for _, rule, bits in reversed(CLASSES[:-1]):
            least = F.when(x.rlike(rule), F.lit(bits)).otherwise(least)
        return F.when(~listed, F.struct(c["start"].alias("start"), entropy_range(x, least).alias("r")))

    pieces = F.flatten(F.transform(candidates, lambda c: _pieces(c, base)))
    judged = F.filter(F.transform(pieces, judge), lambda j: j["r"]["low"].isNotNull())
    return F.transform(judged, lambda j: F.struct((j["start"] + j["r"]["low"]).alias("start"), F.lit(len(BASE)).alias("rank"), F.lit("entropy").alias("kind"), (j["start"] + j["r"]["high"]).alias("end")))


def secrets(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id_col, base, found): arrays of struct<start, rank, kind, end> in order; `found` has the base spans and the entropy spans.

    Base spans of a kind are leftmost and do not overlap; a match that is too short is dropped after it is found. Null and
    empty texts have no spans. One row per row of `docs`, repeated rows and null ids too; no shuffle. Columns of `docs` other than id_col and text are not read.
    """
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    t = F.col("_t")
    base = [_spans(t, pattern, kind, rank, group, least, MAY_HOLD[kind](t)) for rank, (kind, pattern, group, least) in enumerate(BASE)]
    rows = rows.withColumn("base", F.array_sort(F.concat(*base)))
    return rows.select(id_col, "base", F.array_sort(F.concat("base", _entropy_spans(F.col("_t"), F.col("base")))).alias("found"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(kind).alias(f"n_{kind}") for kind, *_ in BASE], F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def oracle_sql() -> str:
    """The same in DuckDB SQL: matches by extraction and splitting, entropies of all windows of a candidate."""
    quote = lambda p: p.replace("'", "''")
    kinds = [(rank, kind, pattern, group, least) for rank, (kind, pattern, group, least) in enumerate(BASE)] + [(len(BASE), "entropy", CANDIDATE, 0, WINDOW)]
    parts = [f"SELECT doc_id, {rank} AS rank, '{kind}' AS kind, {least} AS least, regexp_extract_all(t, '{quote(p)}') AS hits, regexp_extract_all(t, '{quote(p)}', {group}) AS vals, string_split_regex(t, '{quote(p)}') AS gaps FROM docs" for rank, kind, p, group, least in kinds]
    listed = " OR ".join(f"regexp_matches(x, '{quote(rule)}')" for rule in ALLOW)
    least = "CASE " + " ".join(f"WHEN regexp_matches(x, '{quote(rule)}') THEN {bits}" for _, rule, bits in CLASSES) + " END"
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
cut AS ({' UNION ALL '.join(parts)}),
each AS (SELECT doc_id, rank, kind, least, unnest(hits) AS hit, unnest(vals) AS val, unnest(gaps[1:len(hits)]) AS gap, generate_subscripts(hits, 1) AS i FROM cut WHERE len(hits) > 0),
placed AS (SELECT *, (sum(length(gap)) OVER w + sum(length(hit)) OVER w - length(hit))::BIGINT AS a, (sum(length(gap)) OVER w + sum(length(hit)) OVER w)::BIGINT AS b FROM each WINDOW w AS (PARTITION BY doc_id, rank ORDER BY i)),
base AS (SELECT doc_id, rank, kind, a, b FROM placed WHERE rank < {len(BASE)} AND length(val) >= least),
candidates AS (SELECT doc_id, a, b, hit FROM placed WHERE rank = {len(BASE)}),
begins AS (SELECT doc_id, a, b, hit, a AS s FROM candidates UNION SELECT c.doc_id, c.a, c.b, c.hit, x.b AS s FROM candidates c JOIN base x ON x.doc_id = c.doc_id AND x.a < c.b AND c.a < x.b WHERE x.b < c.b),
pieces AS (SELECT *, least(b, coalesce((SELECT min(x.a) FROM base x WHERE x.doc_id = p.doc_id AND x.a >= p.s), b)) AS e FROM begins p WHERE NOT EXISTS (SELECT 1 FROM base x WHERE x.doc_id = p.doc_id AND x.a <= p.s AND p.s < x.b)),
free AS (SELECT doc_id, s AS a, substr(hit, (s - a + 1)::BIGINT, (e - s)::BIGINT) AS x FROM pieces WHERE e - s >= {WINDOW}),
windows AS (SELECT doc_id, a, k, x, string_split(substr(x, k::BIGINT, {WINDOW}), '') AS cs FROM free, unnest(range(1, length(x) - {WINDOW} + 2)) r(k) WHERE NOT ({listed})),
bits AS (SELECT doc_id, a, k, round(log2({WINDOW}) - list_sum(list_transform(list_distinct(cs), lambda c: len(list_filter(cs, lambda y: y = c)) * log2(len(list_filter(cs, lambda y: y = c))))) / {WINDOW}, 9) >= ({least})::DOUBLE AS hit FROM windows),
found AS (SELECT doc_id, {len(BASE)} AS rank, 'entropy' AS kind, (a + min(k) - 1)::BIGINT AS a, (a + max(k) - 1 + {WINDOW})::BIGINT AS b FROM bits WHERE hit GROUP BY doc_id, a),
spans AS (SELECT * FROM base UNION ALL SELECT * FROM found)
SELECT d.doc_id, {', '.join(f"(SELECT count(*) FROM base s WHERE s.doc_id = d.doc_id AND s.kind = '{kind}') AS n_{kind}" for kind, *_ in BASE)},
 sha256(coalesce((SELECT string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) FROM base s WHERE s.doc_id = d.doc_id), '')) AS base_sha256,
 coalesce((SELECT string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) FROM spans s WHERE s.doc_id = d.doc_id), '') AS spans FROM docs d"""

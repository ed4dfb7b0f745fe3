"""Mixing sources to target weights: iterative proportional fitting, then sampling by calibrated probabilities. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, documents, materialize

DIMENSIONS = ("source", "lang", "topic")
#: Target share of a source, language or topic: its token share to this power, made to sum to 1.
TEMPER = 0.8
#: A document is taken at most so many times. What only discards must scale all weights to the poorest cell.
MAX_COPIES = 4
#: For corpora in which no document may come twice: targets nearer to what there is, and no copies.
ONCE = {"temper": 0.95, "max_copies": 1}
#: Raking ends when no weight changes by more than this share of it in a round, or after so many rounds.
TOLERANCE = 1e-9
ROUNDS = 40
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"
#: Topics by the signs of a text, in this order: signs, and how many words there are for each sign at most.
REGISTERS = (("listing", "|", 5), ("symbols", "#$%&*", 5), ("exclaiming", "!", 5), ("figures", "0123456789", 50))


def token_count(text: Column) -> Column:
    """Tokens of a text, taken as its maximal runs without white space."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


#: What no register counts.
UNCOUNTED = r"[^|#$%&*!0-9]+"


def register_topic(signs: Column, tokens: Column) -> Column:
    """A topic from what a text is written in, for corpora without one: blank, a register of REGISTERS, or prose. signs: the text without UNCOUNTED."""
    topic = F.when(F.coalesce(tokens, F.lit(0)) == 0, "blank")
    for name, own, words in REGISTERS:
        topic = topic.when(words * (F.length(signs) - F.length(F.translate(signs, own, ""))) > tokens, name)
    return topic.otherwise("prose")


def _cells(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*[f"_{d}" for d in DIMENSIONS]).agg(F.sum("_tokens").cast("double").alias("tokens"))


def _shares(cells: DataFrame, dim: str, temper: float, factors: dict[str, float] | None = None) -> DataFrame:
    """(_dim, target): target share of each value, from the tokens that it has, times its factor if it has one. Values without tokens have none."""
    factor = F.lit(1.0)
    for value, by in (factors or {}).items():
        factor = F.when(F.col(f"_{dim}") == value, F.lit(float(by))).otherwise(factor)
    sums = materialize(cells.groupBy(f"_{dim}").agg(F.sum("tokens").alias("t")).select(f"_{dim}", F.when(F.col("t") > 0, F.pow("t", F.lit(temper)) * factor).otherwise(F.lit(0.0)).alias("p")))
    whole = sums.agg(F.sum("p")).first()[0] or 1.0
    return sums.select(f"_{dim}", (F.col("p") / F.lit(whole)).alias("target"))


def rake(cells: DataFrame, temper: float = TEMPER, budget: float = 1.0, rounds: int = ROUNDS, targets: dict[str, DataFrame] | None = None, factors: dict[str, dict[str, float]] | None = None, max_copies: int = MAX_COPIES) -> DataFrame:
    """`cells` (_source, _lang, _topic, tokens) with weight, the tokens to take, and residual.

    Each round scales the weights to each dimension's targets in turn, until none changes; then all are scaled alike, to
    the most that asks no cell for more than max_copies times the tokens it has (and to `budget` of all tokens at most), so
    that the marginals stay as raked. residual is the largest relative distance of a marginal from its target: 0 unless the
    targets contradict each other. factors ({dimension: {value: factor}}) multiply tempered shares; targets may give a
    frame (_dim, target) for a dimension instead, in which a value without a target gets nothing.
    Cells are as many as there are combinations, few next to documents; each round is a written table.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0.0
    fit = cells.withColumn("weight", F.col("tokens"))
    for dim in DIMENSIONS:
        share = (targets or {}).get(dim)
        share = _shares(cells, dim, temper, (factors or {}).get(dim)) if share is None else share
        fit = fit.join(share.select(f"_{dim}", (F.col("target") * F.lit(total)).alias(f"_want_{dim}")), f"_{dim}", "left")
    fit = materialize(fit.fillna(0.0, [f"_want_{dim}" for dim in DIMENSIONS]))

    def beside(fit: DataFrame, dim: str) -> DataFrame:
        return fit.join(fit.groupBy(f"_{dim}").agg(F.sum("weight").alias("_has")), f"_{dim}")

    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    for _ in range(rounds):
        after = fit.withColumn("_before", F.col("weight"))
        for dim in DIMENSIONS:
            after = beside(after, dim).withColumn("weight", F.col("weight") * ratio(f"_want_{dim}", "_has")).drop("_has")
        after = materialize(after)
        discard(fit)
        change = after.where("_before > 0").agg(F.max(F.abs(F.col("weight") / F.col("_before") - 1))).first()[0]
        fit = after.drop("_before")
        if not change or change <= TOLERANCE:
            break
    worst = [beside(fit, dim).where(f"_want_{dim} > 0").agg(F.max(F.abs(F.col("_has") / F.col(f"_want_{dim}") - 1))).first()[0] or 0.0 for dim in DIMENSIONS]
    most = fit.where("weight > 0").agg(F.min(F.lit(float(max_copies)) * F.col("tokens") / F.col("weight"))).first()[0] or 0.0
    return fit.select(*[f"_{dim}" for dim in DIMENSIONS], "tokens", (F.col("weight") * F.lit(min(most, budget))).alias("weight"), F.lit(max(worst)).alias("residual"))


def keyed(docs: DataFrame, own: list[str], text: str, topic: Column | None) -> DataFrame:
    """The columns `own` of docs, then _source, _lang, _topic, _tokens. Each text is read once for its tokens and once for its signs."""
    given = F.lit(None).cast("string") if topic is None else F.coalesce(topic, F.lit(""))
    rows = docs.select(*own, *[F.coalesce(F.col(d).cast("string"), F.lit("")).alias(f"_{d}") for d in ("source", "lang")], token_count(F.col(text)).alias("_tokens"), given.alias("_given"), (F.regexp_replace(text, UNCOUNTED, "") if topic is None else F.lit("")).alias("_signs"))
    found = F.col("_given") if topic is not None else register_topic(F.col("_signs"), F.col("_tokens"))
    return rows.select(*own, "_source", "_lang", found.alias("_topic"), "_tokens")


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", topic: Column | None = None, keep_text: bool = False, **options) -> DataFrame:
    """One row per row of `docs`: id_col (keep_text: all columns), _source, _lang, _topic, _tokens, expected, residual, copies, kept.

    A row is expected weight / tokens of its cell times, that is `copies` whole times: the whole part, and once more with
    the probability that is left, by a hash of its id: the same in every run, and equal for repeated ids. kept: at least
    once. With max_copies = 1 expected is a probability and copies 0 or 1. Rows are not multiplied here; `taken` does that.
    A null source, language or topic counts as "". Rows without tokens are kept if their cell has none.
    An empty table gives no rows. Columns of `docs` whose names begin as those added are replaced.
    """
    added = {"_source", "_lang", "_topic", "_tokens", "_given", "_signs", "expected", "residual", "copies", "kept"}
    rows = keyed(docs, [c for c in docs.columns if c not in added] if keep_text else [id_col], text, topic)
    cells = materialize(_cells(keyed(docs, [], text, topic)))
    fit = rake(cells, **options).select(*[F.col(f"_{d}") for d in DIMENSIONS], F.round(F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(F.lit(1.0)), 6).alias("expected"), F.round("residual", 6).alias("residual"))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), 1, 8), 16, 10).cast("double") / 4294967296.0
    whole = F.floor("expected")
    rows = rows.join(materialize(fit), [f"_{d}" for d in DIMENSIONS]).withColumn("copies", (whole + (draw < F.col("expected") - whole).cast("long")).cast("int"))
    return rows.withColumn("kept", F.col("copies") > 0)


def taken(mixed: DataFrame) -> DataFrame:
    """The rows of `mix`, each as many times as it is taken, with `copy` from 0."""
    return mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, expected, residual, copies, kept for every document."""
    found = mix(documents(spark, sf_dir).select("doc_id", "text", "lang", "source"))
    return found.select("doc_id", F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"), "expected", "residual", "copies", "kept")


#: Rounds of the SQL twin, which can't stop by a test.
SQL_ROUNDS = 16


def oracle_sql(temper: float = TEMPER, max_copies: int = MAX_COPIES) -> str:
    """The same in DuckDB SQL, the rounds written out."""
    registers = " ".join(f"WHEN {words} * (length(text) - length(translate(text, '{signs}', ''))) > n_tokens THEN '{name}'" for name, signs, words in REGISTERS)
    parts = [
        r"""rows AS (SELECT doc_id, text, coalesce(source, '') AS source, coalesce(lang, '') AS lang, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n_tokens FROM documents)""",
        f"topics AS (SELECT doc_id, source, lang, n_tokens, CASE WHEN n_tokens = 0 THEN 'blank' {registers} ELSE 'prose' END AS topic FROM rows)",
        "cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM topics GROUP BY ALL)",
    ]
    for dim in DIMENSIONS:
        parts.append(f"p_{dim} AS (SELECT {dim}, CASE WHEN sum(tokens) > 0 THEN pow(sum(tokens), {temper}) ELSE 0 END AS p FROM cells GROUP BY {dim})")
        parts.append(f"want_{dim} AS MATERIALIZED (SELECT {dim}, p / (SELECT sum(p) FROM p_{dim}) * (SELECT sum(tokens) FROM cells) AS want FROM p_{dim})")
    last = "(SELECT *, tokens AS weight FROM cells)"
    for k in range(SQL_ROUNDS):
        for dim in DIMENSIONS:
            name = f"fit_{k}_{dim}"
            parts.append(f"{name} AS MATERIALIZED (SELECT f.source, f.lang, f.topic, f.tokens, f.weight * CASE WHEN h.has > 0 THEN w.want / h.has ELSE 0 END AS weight FROM {last} f JOIN (SELECT {dim}, sum(weight) AS has FROM {last} GROUP BY {dim}) h USING ({dim}) JOIN want_{dim} w USING ({dim}))")
            last = name
    for dim in DIMENSIONS:
        parts.append(f"off_{dim} AS (SELECT max(abs(has / want - 1)) AS off FROM (SELECT {dim}, sum(weight) AS has FROM {last} GROUP BY {dim}) JOIN want_{dim} USING ({dim}) WHERE want > 0)")
    residual = f"round(greatest({', '.join(f'(SELECT coalesce(max(off), 0) FROM off_{dim})' for dim in DIMENSIONS)}), 6)"
    most = f"(SELECT least(min({max_copies}.0::DOUBLE * tokens / weight), 1) FROM {last} WHERE weight > 0)"
    parts.append(f"fit AS (SELECT source, lang, topic, round(CASE WHEN tokens > 0 THEN weight * {most} / tokens ELSE 1 END, 6) AS expected FROM {last})")
    draw = f"('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0"
    parts.append(f"drawn AS (SELECT t.*, expected, (floor(expected) + ({draw} < expected - floor(expected))::INTEGER)::INTEGER AS copies FROM topics t JOIN fit USING (source, lang, topic))")
    return f"WITH {', '.join(parts)} SELECT doc_id, source, lang, topic, n_tokens, expected, {residual} AS residual, copies, copies > 0 AS kept FROM drawn"

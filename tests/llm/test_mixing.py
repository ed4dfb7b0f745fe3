from pyspark.sql import functions as F

from trafficloom.llm import mixing

from .util import corpus, frame


def docs(spark, rows):
    return spark.createDataFrame([(i, t, ("en", "de", None)[k % 3], f"s{k % 4 if k % 2 else 0}", "x") for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, expected string")


def test_rakes_to_the_marginals(spark):
    cells = spark.createDataFrame([(s, l, t, 1000.0 * (1 + (s == "a") * 9 + (l == "x"))) for s in "abc" for l in "xy" for t in "pq"], "_source string, _lang string, _topic string, tokens double")
    fit = mixing.rake(cells, budget=0.3, rounds=30)
    total = cells.agg(F.sum("tokens")).first()[0]
    for dim in mixing.DIMENSIONS:
        want = {r[0]: r[1] * total * 0.3 for r in mixing._shares(cells, dim, mixing.TEMPER).collect()}
        have = {r[0]: r[1] for r in fit.groupBy(f"_{dim}").agg(F.sum("weight")).collect()}
        assert all(abs(have[k] / want[k] - 1) < 1e-3 for k in want)
    assert fit.where("weight > 4 * tokens + 1e-9").count() == 0


def test_every_row_once_nulls_and_clashes(spark):
    rows = corpus()
    got = mixing.mix(docs(spark, rows))
    assert sorted(r.doc_id for r in got.collect()) == sorted(i for i, _ in rows)
    assert got.where("expected < 0 or expected > 4 or kept is null or copies < floor(expected) or copies > ceil(expected)").count() == 0
    full = mixing.mix(docs(spark, rows), keep_text=True)
    assert {"text", "lang", "source", "expected", "copies", "kept"} <= set(full.columns)
    assert sorted((r.doc_id, r.kept) for r in full.collect()) == sorted((r.doc_id, r.kept) for r in got.collect())
    twice = mixing.mix(docs(spark, [(7, "a b")] * 4)).collect()
    assert len(twice) == 4 and len({(r._source, r._lang, r.kept) for r in twice}) == len({(r._source, r._lang) for r in twice})
    assert mixing.mix(docs(spark, []).limit(0)).count() == 0


def test_plan_is_native(spark):
    plan = mixing.mix(docs(spark, corpus()))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_residual_is_reported(spark):
    """Targets that hold together are met to the last digit; those that contradict each other leave a residual, and no cell gives more than it has."""
    frame_of = lambda dim, shares: spark.createDataFrame(list(shares.items()), f"_{dim} string, target double")
    cells = spark.createDataFrame([("a", "x", "p", 90.0), ("a", "y", "p", 10.0), ("b", "x", "p", 30.0), ("b", "y", "p", 70.0), ("c", "x", "p", 0.0)], "_source string, _lang string, _topic string, tokens double")
    good = mixing.rake(cells, targets={"source": frame_of("source", {"a": 0.3, "b": 0.7}), "lang": frame_of("lang", {"x": 0.4, "y": 0.6})}, max_copies=1).collect()
    assert max(r.residual for r in good) < 1e-8 and all(r.weight <= r.tokens + 1e-9 for r in good)
    taken = {k: sum(r.weight for r in good if r._source == k) for k in "ab"}
    assert abs(taken["a"] / (taken["a"] + taken["b"]) - 0.3) < 1e-8 and max(r.weight / r.tokens for r in good if r.tokens) > 1 - 1e-9
    lone = spark.createDataFrame([("a", "x", "p", 90.0), ("b", "y", "p", 10.0)], cells.schema)
    bad = mixing.rake(lone, targets={"source": frame_of("source", {"a": 0.5, "b": 0.5}), "lang": frame_of("lang", {"x": 0.9, "y": 0.1})}, max_copies=1).collect()
    assert bad[0].residual > 0.1 and all(r.weight <= r.tokens + 1e-9 for r in bad)


def test_a_source_doubled_and_a_language_halved(spark):
    """Real shifts are met without throwing most tokens away: poor cells are taken more than once, whole copies and a draw."""
    texts = [(k, "word " * (5 + k % 7) + "1 " * (k % 3)) for k in range(2000)]
    rows = spark.createDataFrame([(i, t, ("en", "de")[i % 5 == 0], f"s{(i % 11) // 4}") for i, t in texts], "doc_id long, text string, lang string, source string")
    got = mixing.mix(rows, temper=1.0, factors={"source": {"s2": 2.0}, "lang": {"en": 0.5}}).collect()
    total = sum(r._tokens for r in got)
    had = lambda f: sum(r._tokens for r in got if f(r)) / total
    for weight, near in ((lambda r: r.expected, 1e-4), (lambda r: r.copies, 0.03)):
        whole = sum(r._tokens * weight(r) for r in got)
        has = lambda f: sum(r._tokens * weight(r) for r in got if f(r)) / whole
        s2, en = had(lambda r: r._source == "s2"), had(lambda r: r._lang == "en")
        assert abs(has(lambda r: r._source == "s2") / (2 * s2 / (1 + s2)) - 1) < near
        assert abs(has(lambda r: r._lang == "en") / (0.5 * en / (1 - 0.5 * en)) - 1) < near
        assert whole > 0.95 * total
    assert max(r.residual for r in got) == 0 and max(r.copies for r in got) > 1
    twice = mixing.taken(spark.createDataFrame([(1, 0), (2, 1), (3, 3)], "doc_id long, copies int"))
    assert sorted((r.doc_id, r.copy) for r in twice.collect()) == [(2, 0), (3, 0), (3, 1), (3, 2)]

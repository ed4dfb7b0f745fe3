"""The whole pipeline against plain versions of its stages, on a small corpus."""

import random

import corpus_pipeline
import duckdb
from tokenizers import Tokenizer

from trafficloom.llm import mixing

from .test_linededup import brute as brute_lines
from .test_nearcopies import brute_groups
from .test_toxicity import rows as labelled


def corpus(spark, folder):
    r = random.Random(11)
    rows, labels = labelled(400)
    shared = "\n".join(f"shared line {k} of a frame" for k in range(4))
    rows += [(1000 + k, f"{shared}\n" + " ".join(r.choice("abcdefgh") * 3 for _ in range(60))) for k in range(30)]
    rows += [(2000 + k, rows[1][1] if k % 2 else rows[2][1] + " end") for k in range(20)] + [(3000, ""), (3001, None), (3002, "word " * 3000)]
    docs = [(i, t, ("en", "de")[i % 2], f"s{i % 3}", len(t or "")) for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    return docs, {i for i, t in labels if t}


def expected(docs, toxic):
    docs = [d for d in docs if d[0] not in toxic]
    lines = brute_lines([(d[0], d[1]) for d in docs])
    docs = [(d[0], lines[d[0]][0] if d[1] is not None else None, d[2], d[3]) for d in docs]
    groups = brute_groups([(d[0], d[1]) for d in docs])
    docs = [d for d in docs if groups[d[0]] == d[0]]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", docs)
    kept = {i for i, keep in con.execute(f"SELECT doc_id, kept FROM ({mixing.oracle_sql(**mixing.ONCE)})").fetchall() if keep}
    return [d for d in docs if d[0] in kept]


def test_pipeline(spark, tmp_path):
    import public_tokenizers

    docs, toxic = corpus(spark, tmp_path)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for i, t, *_ in expected(docs, toxic):
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1
        want[i] = n
    tokens = {}
    for r in got:
        tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.length
    assert tokens == want
    assert len({r.sequence_id for r in got}) <= -(-sum(want.values()) // 2048) + 1


def test_stages_keep_the_columns(spark, tmp_path):
    corpus(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "mixing", "best_fit_packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs_after = stage(spark, docs, str(tmp_path))
        assert docs_after.columns == docs.columns

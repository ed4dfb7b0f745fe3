"""From documents to packed training sequences: five stages, each written as Parquet and reread by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficloom.llm import linededup, mixing, packing, simhash, toxicity
from trafficloom.llm.common import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted to be toxic go."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of lines that stand earlier in the corpus go; n_chars follows the text. A document without lines left stays, empty."""
    return linededup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word shingles, likeness 0.8 or more) stays."""
    return simhash.keep_one(docs, similar=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled by probabilities raked to source, language and topic weights; none comes twice, as copies have just gone."""
    return mixing.mix(docs, keep_text=True, **mixing.ONCE).where("kept").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document, with its sequence and its place there."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Toxicity and near copies cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

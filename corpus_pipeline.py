"""From raw documents to token ids: five stages, each over all that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``. Toxic
documents go, boilerplate lines of a source go, one document of each near-duplicate class stays, documents with benchmark
passages go, the rest is encoded by byte-level BPE and decoded again. Nulls, empty and long texts, repeated rows, empty
tables and further columns are treated as the operators of ``tabulon.llm`` state.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabulon.llm import bytebpe, decontam, linededup, simjoin, toxicity
from tabulon.llm.common import remove, scratch, shared_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; the model learns from the labels of the table."""
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"))


def drop_site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source."""
    return linededup.drop_boilerplate(docs)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of shingle similarity 0.8 or more."""
    return simjoin.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontam.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each document that is left."""
    return bytebpe.round_trip(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_site_lines),
    ("jaccard_join", keep_one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

#: Scores of a fitted model and BPE merges have no SQL form; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Each stage's scratch tables go when its result is written, that goes when the next one is."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, f"pipeline-{name}")
        with scratch(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.option("compression", "zstd").parquet(path)
            schema = kept.schema
        if before:
            remove(spark, before)
        docs, before = spark.read.schema(schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: documents are scored, de-duplicated, decontaminated and packed, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstay.llm import decontamination, factor_machine, queries, simhash, substrings
from fieldstay.llm.storage import materialise, with_row_key


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the accepted one; the others go."""
    model = queries.quality_model(docs, queries.table(spark, sf_dir, "labels"))
    return factor_machine.accept(docs, model, queries.ACCEPTED, metadata=queries.METADATA)


def simhash_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest id (null first), or of rows with
    that id the first by a hash of the text; of rows equal in both, one."""
    keyed = with_row_key(docs, "doc_id", "text", carry=True)
    found = simhash.near_duplicates(keyed, id_col="row_key", shingle=3, distance=2)
    kept = found.select(F.col("component_id").alias("row_key")).distinct()
    return keyed.join(kept, "row_key", "left_semi").dropDuplicates(["row_key"]).select("row.*")


def substring_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the words of repeated passages. A document that loses none keeps its text as it is; in
    others the words left are joined by one space and ``n_chars`` is counted anew."""
    return substrings.clean_texts(docs, length_col="n_chars", k=20)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark; contaminated ones go."""
    return decontamination.clean_documents(docs, queries.table(spark, sf_dir, "benchmark"), width=13)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document with their place in sequences of 2048 tokens."""
    return queries.packed_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_duplicates),
    ("substring dedup", substring_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", pack_sequences),
]

# Learned scores, XXH64 and token ids are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's rows are written once and read by the next."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline over ``documents``: each stage applies one operator to all that the stage
before kept; its result is written as Parquet and read as the next one's documents.

1. language ID: documents go whose language cannot be told (no letters, or a score under 0.35);
2. line dedup: later copies of repeated line runs of 50 words or more go; a document of which no
   line is left goes; the length column follows the text;
3. n-gram Jaccard join: of each group of near duplicates the document with the smallest id stays;
4. benchmark decontamination: documents that hold question and answer of a test item go;
5. BPE: the ids of each text and the text decoded from them, as digests.

Nulls, empty texts and repeated rows are handled as the operators say. No stage has SQL here:
language ID is a trained model, so the pipeline is tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmetrics.llm import bpe, crf, decontaminate, jaccard, line_dedup
from feedmetrics.llm.common import saved, table
from feedmetrics.llm.queries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return crf.keep_identified(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = line_dedup.delete_repeats(docs).where("n_deleted = 0 or text is not null")
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("n_deleted") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_first(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("jaccard_join", dedup_documents),
    ("decontamination", remove_benchmark),
    ("bpe", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

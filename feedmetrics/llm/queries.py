"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedmetrics.llm import ads, align, bpe, chat, crf, decontaminate, divergence, jaccard, line_dedup, merkle, site_style_tree, token_files, warc
from feedmetrics.llm.common import table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A tokenizer file that the queries use."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_digests(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


def op2_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_style_tree.extract(table(spark, sf_dir, "pages"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.delete_repeats(docs).select("doc_id", "n_lines", "n_deleted", "text")


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge(table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse_and_render(table(spark, sf_dir, "conversations"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (warc.deduplicated_archives(table(spark, sf_dir, "pages"), min_bytes=0)
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


def op10_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(table(spark, sf_dir, "documents"))


def op12_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_site_style_tree": op2_site_style_tree,
    "op3_decontaminate": op3_decontaminate,
    "op4_line_dedup": op4_line_dedup,
    "op5_jaccard": op5_jaccard,
    "op6_divergence": op6_divergence,
    "op7_chat": op7_chat,
    "op8_warc": op8_warc,
    "op9_bpe": op9_bpe,
    "op10_crf": op10_crf,
    "op11_merkle": op11_merkle,
    "op12_ads": op12_ads,
    "op13_align": op13_align,
}

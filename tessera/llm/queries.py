"""The operators bound to the driver's tables, and SQL for those that it can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.context_tree import score_texts
from tessera.llm.decontaminate import find_overlaps
from tessera.llm.jaccard import similar_groups
from tessera.llm.language import identify_languages, train_languages
from tessera.llm.lines import dedup_lines
from tessera.llm.packing import pack_documents
from tessera.llm.quality import apply_quality_rules
from tessera.llm.resample import resample
from tessera.llm.secrets import find_secrets, labelled_samples, spans_text, train_markov
from tessera.llm.spelling import count_words, group_spellings
from tessera.llm.sql import ORACLE_SQL
from tessera.llm.substrings import remove_repeats
from tessera.llm.toxicity import score_toxicity, train_toxicity
from tessera.llm.warc import archive_pages


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_identify_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify_languages(docs, train_languages(docs, fit=False))


def op3_find_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_secrets(docs, train_markov(labelled_samples(docs)))
    base = spans_text(("assign", "access", "hex"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(base, 256).alias("base_sha256"), spans_text().alias("spans"), "n_markov")


def op4_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), window=50)


def op5_benchmark_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per overlap of a document with a benchmark item."""
    found = find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("overlaps").alias("x")).select("doc_id", "x.*")


def op6_score_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, train_toxicity(docs, table(spark, sf_dir, "labels"), train_languages(docs, fit=False)))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_quality_rules(table(spark, sf_dir, "documents"))


def op8_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the archives and their index, look up every page's URL in it and read the records found."""
    pages = table(spark, sf_dir, "pages")
    index = archive_pages(pages)
    return index.read(index.find(pages)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"), least_docs=10, least_chars=1).drop("kept")


def op10_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents"), shingle=3, percent=90).select("doc_id", "n_shingles", "component_id")


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents, drawn towards the benchmark."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_words")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_spellings(count_words(table(spark, sf_dir, "documents"), one_in=97, least_chars=5, least_n=3), least_ratio=2)


def op13_score_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1)


__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES = {f.__name__: f for f in (op1_pack_documents, op2_identify_languages, op3_find_secrets, op4_remove_repeats, op5_benchmark_overlaps, op6_score_toxicity, op7_quality_rules, op8_capture_index, op9_dedup_lines, op10_jaccard_groups, op11_resample, op12_spelling_variants, op13_score_texts)}

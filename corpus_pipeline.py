"""A training corpus from ``documents`` in five stages of the operators in ``tessera.llm``.

Each stage takes what its predecessor wrote and returns documents again; the last returns the pieces
of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.decontaminate import drop_contaminated
from tessera.llm.jaccard import keep_leaders
from tessera.llm.language import keep_identified, train_languages
from tessera.llm.lines import clean_lines
from tessera.llm.packing import pack_documents
from tessera.llm.queries import table, tokenizer_path
from tessera.llm.shared import staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, of no language that makes up a third of them, or unlike any learned language, go."""
    return keep_identified(docs, train_languages(docs), least_score=1 / 3).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; every document stays, if need be with an empty text."""
    cleaned = clean_lines(docs.select(*COLUMNS), least_docs=10, least_chars=1)
    return cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, 0.8) the smallest doc_id stays."""
    return keep_leaders(docs.select(*COLUMNS), shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with an item of the benchmark go."""
    return drop_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences; null and empty texts are one piece each, very long ones several."""
    return pack_documents(docs, tokenizer_path())


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("jaccard_join", jaccard_join), ("decontamination", decontamination), ("packing", packing)]

#: Language inference, similarity components, substitution-tolerant overlaps and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Training corpus from ``documents``: clean, deduplicate, mask, mix, pack.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept.

Defined cases of the stages: null and empty texts fail the quality rules, and in the later stages stay as they are, without
personal data, without copies in the mix, and as one end id in the windows; rows with a null doc_id are no near duplicates of others and
stay; rows that repeat a doc_id are one document for the near-duplicate stage, whose first text stays, and documents of their own for the
others; a null source is a source of its own; an empty table gives no rows; other columns, whatever their names, come through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telescry.llm import mixing, ngram_join, packing, pii, quality
from telescry.llm.common import free_name, stage_table, table
from telescry.llm.queries import vocabulary
from telescry.session import configure


def _sized(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents, with the length of the new text."""
    return (docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in columns else docs).select(*columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules keep, without the lines that fail."""
    configure(spark)
    own = {c: free_name(f"_{c}", docs) for c in docs.columns if c != "text"}  # results must not replace columns of the input
    kept = quality.clean_lines(docs.withColumnsRenamed(own)).filter("kept").withColumnsRenamed({"text": "_text", "clean_text": "text"})
    return _sized(kept.select("text", *own.values()).withColumnsRenamed({v: k for k, v in own.items()}), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word shingle sets that are linked at 0.8 or more."""
    configure(spark)
    return ngram_join.representatives(docs, ngram_join.Likeness(width=5, percent=80))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked."""
    configure(spark)
    return _sized(pii.redacted(docs, pii.pattern_table(docs)), docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    configure(spark)
    return mixing.mixed(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 4096 ids."""
    configure(spark)
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("pack_windows", pack_windows),
]

#: Tokens and similarity components cannot be written in SQL; tests/llm/test_corpus_pipeline.py holds each stage and run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

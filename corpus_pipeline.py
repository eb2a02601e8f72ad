"""A training corpus from raw documents: five stages, each written as Parquet and read by the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talweg.llm import decontaminate, jaccard, linededup, packing, quality
from talweg.llm.common import stage, table, tokenizer_path
from talweg.session import ship_package


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose quality score is below the threshold."""
    ship_package(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated line passages; n_chars follows the text, and documents that lose all their lines are dropped.

    Null and empty texts that come in stay as they are.
    """
    ship_package(spark)
    done = linededup.dedup_lines(docs).filter("n_removed = 0 OR length(text) > 0")
    changed = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return done.withColumn("n_chars", changed).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies."""
    ship_package(spark)
    return jaccard.keep_one_of_each(docs, words=5, least=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a phrase of the benchmark."""
    ship_package(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences; one row for each piece of a document."""
    ship_package(spark)
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Kernel scores and tokenizers have no SQL form; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for _, function in STAGES:
        docs = stage(function(spark, docs, sf_dir))
    return docs

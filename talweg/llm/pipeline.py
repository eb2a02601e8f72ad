"""The corpus pipeline at the top of the repository as a registered query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from talweg.llm.common import ready


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over the documents table."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {"pipeline": ready(pipeline)}
ORACLES: dict[str, str] = {}

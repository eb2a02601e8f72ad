"""Versioned layers: raw copies, treated tables, audit tables, manifest."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talweg.functions.naming import REPAIR_FLAG
from talweg.operators.quality import QualityReports

#: Most files that one write makes of a partition.
FILES_OF_A_VERSION = 32
MANIFEST = "dataset_path string, role string, report string, report_path string"


def _complete(spark, path: str) -> bool:
    """Whether a write to the folder ended, by its success marker."""
    marker = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def drop_internal(df: DataFrame) -> DataFrame:
    return df.drop(REPAIR_FLAG)


def write_bronze(df: DataFrame, path: str) -> DataFrame:
    """Raw rows once per version: a complete copy stays, what a failed write left is replaced."""
    if not _complete(df.sparkSession, path):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_silver(df: DataFrame, path: str) -> DataFrame:
    """Treated rows, replacing the version, without internal columns."""
    drop_internal(df).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_silver_versions(df: DataFrame, path: str, by: list[str]) -> None:
    """Treated rows into a table with version columns: what ``df`` holds of them is replaced, all other versions stay.

    The overwrite is of the partitions in the data only, so a version never has to be read to be kept; rows of one
    partition are brought together first, spread by hash where there are many, so that it has few files.
    """
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns if c not in by]), F.lit(FILES_OF_A_VERSION))
    (
        drop_internal(df).repartition(*by, spread).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by).parquet(path)
    )


def read_silver_version(spark, path: str, **version: str) -> DataFrame:
    """Rows of the given values of version columns, as texts; only their folders are read."""
    found = spark.read.option("mergeSchema", "true").parquet(path)
    kept = found.filter(" AND ".join(f"`{c}` = '{v}'" for c, v in version.items())) if version else found
    return kept.withColumns({c: F.lit(v) for c, v in version.items()})


def append_group(df: DataFrame, path: str, first: bool) -> None:
    """Consolidated table of a group: the first layer creates it, others append."""
    drop_internal(df).write.mode("overwrite" if first else "append").parquet(path)


def read_group(spark, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


def write_reports(reports: QualityReports, folder: str) -> dict[str, str]:
    """Write the audit tables that exist and return their paths."""
    written = {}
    for name in QualityReports.__dataclass_fields__:
        frame = getattr(reports, name)
        if frame is not None:
            path = f"{folder}/{name}"
            drop_internal(frame).write.mode("overwrite").parquet(path)
            written[name] = path
    return written


def append_manifest(spark, path: str, dataset: str, role: str, reports: dict[str, str]) -> DataFrame:
    """Append one row per report of a dataset (one without a report when there is none); returns the appended rows, not the whole manifest."""
    rows = [(dataset, role, name, where) for name, where in reports.items()] or [(dataset, role, None, None)]
    frame = spark.createDataFrame(rows, MANIFEST).withColumn("written_at", F.lit(datetime.now(UTC)))
    frame.write.mode("append").parquet(path)
    return frame

"""Reading feature tables: pruned scans, many files with provenance, path resolution."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUFFIXES = (".parquet", ".gpkg")
SPREAD_BYTES = 2 << 20


def scan(
    spark: SparkSession, path: str, columns: list[str] | None = None, spread: bool = False
) -> DataFrame:
    """A feature table in its Parquet form; a column list prunes the scan, geometry included.

    ``spread`` redistributes an input, which pays before geometry work: at least one partition for each core and for each
    ``SPREAD_BYTES`` of its files, as a split of usual size, or a row group, holds millions of short rows.
    """
    df = spark.read.parquet(path)
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    df = df.select(*columns) if columns else df
    asked = max(spark.sparkContext.defaultParallelism, -(-size // SPREAD_BYTES))
    return df.repartition(asked) if spread and df.rdd.getNumPartitions() < asked else df


def scan_many(spark: SparkSession, paths: list[str], recursive: bool = False,
              pattern: str = "*.parquet", provenance: str | None = "source_file") -> DataFrame:
    """Several files or folders as one table, columns aligned, with the file each row came from."""
    df = (
        spark.read.option("recursiveFileLookup", str(recursive).lower())
        .option("pathGlobFilter", pattern)
        .option("mergeSchema", "true")
        .parquet(*paths)
    )
    return df.withColumn(provenance, F.col("_metadata.file_path")) if provenance else df


def resolve_paths(spark: SparkSession, path: str, suffixes: tuple[str, ...] = SUFFIXES) -> list[str]:
    """Datasets behind a path, as full paths: numbered siblings ``x_1, x_2``, a folder, or a tree of folders.

    A dataset is a file, or a folder that Spark wrote, whose name has a known suffix; names
    that begin with ``_`` or ``.`` are skipped. Listing goes through the session's Hadoop file
    system and paths keep its scheme and host, so any store works.
    """
    text = path.strip()
    if not text:
        raise FileNotFoundError("Campo de caminho de entrada vazio.")
    if text.lower().endswith(".zip"):
        raise ValueError("Caminho aponta para arquivo ZIP; leitura desabilitada.")
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(text)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        raise FileNotFoundError(f"Caminho nao encontrado: {text}")

    def files(folder, deep=False):
        found = []
        for status in fs.listStatus(folder):
            name = status.getPath().getName()
            if name.startswith(("_", ".")):
                continue
            if name.lower().endswith(suffixes):
                found.append(status.getPath())
            elif deep and status.isDirectory() and not name.lower().endswith(".zip"):
                found += files(status.getPath(), True)
        return found

    as_texts = lambda found: sorted(p.toString() for p in found)
    root = fs.makeQualified(root)
    name = root.getName()
    if fs.getFileStatus(root).isFile() or name.lower().endswith(suffixes):
        if not name.lower().endswith(suffixes):
            raise ValueError(f"Caminho nao suportado para leitura automatica: {text}")
        stem, _, suffix = name.rpartition(".")
        numbered = re.fullmatch(r"(.+?)_\d+", stem)
        if numbered:
            sibling = re.compile(rf"{re.escape(numbered[1])}_\d+\.{suffix}", re.IGNORECASE)
            group = [p for p in files(root.getParent()) if sibling.fullmatch(p.getName())]
            if len(group) > 1:
                return as_texts(group)
        return as_texts([root])
    found = files(root) or files(root, deep=True)
    if not found:
        raise FileNotFoundError(f"Nenhum dataset suportado encontrado dentro de: {text}")
    return as_texts(found)

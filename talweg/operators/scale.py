"""Salted group facts, join sides of known size and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a group from which on it is hot, and rows that one of its salts takes.
HOT_ROWS = 1_000_000


def checked_side(df: DataFrame, small: bool = False) -> DataFrame:
    """Join side with a broadcast hint if the caller knows its size to be small, else left to adaptive execution."""
    return F.broadcast(df) if small else df


def salts_of(n: Column, hot_rows: int) -> Column:
    """Salts of a group of ``n`` rows, so that each of them takes about ``hot_rows``."""
    return F.ceil(n / F.lit(hot_rows)).cast("int")


#: Setting that names the part of the staging area in use; the application's id where it is unset.
SCOPE = "talweg.staging.scope"


def _staging_area(spark: SparkSession) -> str:
    """The session's own part of the shared checkpoint location the cluster names."""
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="spark-talweg-stage-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/talweg/{spark.conf.get(SCOPE, spark.sparkContext.applicationId)}"


def staging_folder(spark: SparkSession) -> str:
    """A fresh folder in the staging area."""
    return f"{_staging_area(spark)}/{uuid.uuid4().hex}"


def remove_staged(spark: SparkSession) -> bool:
    """Remove all that this session staged, once no frame that reads it is needed any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_staging_area(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame) -> DataFrame:
    """Write once to shared storage and read back: cuts lineage, survives lost executors."""
    path = staging_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_digest(*columns: str) -> Column:
    """Injective digest of a row: length-prefixed texts, nulls equal to each other."""
    parts = []
    for name in columns:
        text = F.col(f"`{name}`").cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def with_group_facts(
    df: DataFrame,
    key: Column,
    facts: list[Column],
    having: Column,
    spread_by: list[str],
    *,
    hot_rows: int = HOT_ROWS,
    base: DataFrame | None = None,
) -> DataFrame:
    """Attach per-group aggregates to every row, without gathering a group anywhere.

    ``facts`` aggregate with map-side combine next to the group size ``_n``; only
    groups that satisfy ``having`` take part in the join back. Groups above
    ``hot_rows`` get a salt for each ``hot_rows`` rows: the row side is spread by
    ``spread_by``, the group side is repeated per salt. The list of hot groups, at
    most the number of all rows over ``hot_rows``, is broadcast. ``base``
    holds the same rows when ``df`` already carries joins that grouping can skip.
    """
    # A key that is never null keeps join filters off the group side, so its one
    # shuffle is reused by the hot groups and both joins.
    key = F.coalesce(key, F.lit(""))
    keyed = df.withColumn("_key", key)
    source = keyed if base is None else base.withColumn("_key", key)
    groups = source.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), *facts).filter(having)
    hot = groups.filter(F.col("_n") > hot_rows).select("_key", salts_of(F.col("_n"), hot_rows).alias("_salts"))
    salted_groups = (
        groups.join(F.broadcast(hot), "_key", "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
        .drop("_salts")
    )
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in spread_by]), F.col("_salts")).cast("int")
    salted_rows = (
        keyed.join(F.broadcast(hot), "_key", "left")
        .withColumn("_salt", F.coalesce(spread, F.lit(0)))
        .drop("_salts")
    )
    return salted_rows.join(salted_groups, ["_key", "_salt"], "left").drop("_key", "_salt")

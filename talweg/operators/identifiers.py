"""Dense sequential identifiers without a global window."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from talweg.functions.naming import FID_COLUMN, ID_COLUMN
from talweg.operators.scale import stage

PARTITION_BYTES, MOST_PARTITIONS = 256 << 20, 500_000
READ_ORDER = "__read"  # place in which a row was read; told beforehand where the table has been written since
_POSITION_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def _partitions(df: DataFrame) -> list[int]:
    """Partition count where the optimizer's size of the input asks for more than the default, which adapts to smaller ones."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    asked = min(size // PARTITION_BYTES, MOST_PARTITIONS)
    return [asked] if asked > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []


def _offsets(counts: DataFrame, unit: str, group: list[str]) -> DataFrame:
    """Rows before each unit, per group; one row per file or partition, never per data row."""
    before = Window.partitionBy(*group).orderBy(unit).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")


def add_sequential_id(
    df: DataFrame, order_by: list[str | Column], column: str = ID_COLUMN, start: int = 1,
    work: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Dense ids in the given order.

    Rows are range-partitioned and sorted once and staged, which freezes the
    partitions; ids are then partition offset plus position. Equal keys keep the order in which they are read: that place is
    the last key, so partitions can begin inside a run of equal keys, however long. ``work``, which must keep
    every row and its column ``_at``, runs on the placed rows on their way to the staged
    table: range partitioning looks at its input twice, so costly columns belong there. A column ``READ_ORDER``
    tells the place of a row where ``df`` doesn't have its rows in the order in which they were read.
    """
    tied = df if READ_ORDER in df.columns else df.withColumn(READ_ORDER, F.monotonically_increasing_id())
    placed = (
        tied.repartitionByRange(*_partitions(df), *order_by, READ_ORDER)
        .sortWithinPartitions(*order_by, READ_ORDER).drop(READ_ORDER)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    placed = stage(work(placed) if work else placed)
    part = F.shiftright("_at", _POSITION_BITS)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n"))
    offsets = _offsets(counts.withColumn("_all", F.lit(0)), "_part", ["_all"]).drop("_all")
    position = F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")  # one row per shuffle partition
        .withColumn(column, F.col("_before") + position + F.lit(start))
        .drop("_part", "_before", "_at")
    )


def add_scan_order_id(df: DataFrame, column: str = ID_COLUMN, start: int = 1) -> DataFrame:
    """Dense ids in file order for a frame read straight from Parquet files.

    File offset plus row position in the file, from the scan's own metadata: no
    shuffle of the data at all.
    """
    located = df.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
    counts = located.groupBy("_file").agg(F.count(F.lit(1)).alias("n"))
    offsets = _offsets(counts.withColumn("_all", F.lit(0)), "_file", ["_all"]).drop("_all")
    return (
        located.join(stage(offsets), "_file")  # written, so of known size: one row per file
        .withColumn(column, F.col("_before") + F.col("_row") + F.lit(start))
        .drop("_file", "_row", "_before")
    )


def group_offsets(files: DataFrame, group: list[str], unit: str, start: int = 1) -> DataFrame:
    """First id of every file of a group, from rows (group..., unit, n)."""
    return _offsets(files, unit, group).select(
        *group, unit, (F.col("_before") + F.lit(start)).alias("id_start")
    )


def assign_output_identifiers(df: DataFrame, order_by: list[str | Column], start: int = 1) -> DataFrame:
    """``acm_id`` unless present, and ``fid`` equal to it."""
    if ID_COLUMN not in df.columns:
        df = add_sequential_id(df, order_by, start=start)
    return df.withColumn(FID_COLUMN, F.col(ID_COLUMN))


def next_free_version(used: DataFrame, keys: list[str], datasets: DataFrame) -> DataFrame:
    """Smallest version from 00 that holds no data yet, per dataset key.

    ``used(keys..., version)`` lists versions with data. The first gap is where a
    sorted version stops matching its rank; no group is gathered.
    """
    number = used.select(*keys, F.col("version").cast("int").alias("v")).filter("v >= 0").distinct()
    following = number.select(*keys, (F.col("v") + 1).alias("v"))
    starts = datasets.select(*keys).distinct().withColumn("v", F.lit(0))
    free = starts.unionByName(following).join(number, [*keys, "v"], "left_anti")
    first = free.join(datasets.select(*keys).distinct(), keys, "left_semi").groupBy(*keys).agg(F.min("v").alias("v"))
    text = F.col("v").cast("string")
    return first.select(*keys, F.when(F.col("v") < 10, F.lpad(text, 2, "0")).otherwise(text).alias("version"))


def version_order(version: str = "version") -> Column:
    """Sort key of a version text: its number, then the text."""
    return F.struct(F.col(version).try_cast("int"), F.col(version))


def latest_version(versions: DataFrame, keys: list[str]) -> DataFrame:
    """Newest version that holds data, per key, from rows (keys..., version, has_data).

    Versions compare as numbers, like ``next_free_version`` counts them; texts that are none come before all.
    """
    return versions.filter("has_data").groupBy(*keys).agg(F.max_by("version", version_order()).alias("version"))


def latest_reference(datasets: DataFrame, order: list[str], path: str) -> DataFrame:
    """Path of the latest dataset by the order columns, as one row."""
    rank = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order], F.col(path))
    return datasets.agg(F.max_by(F.col(path), rank).alias(path))


def merge_files(frames: list[DataFrame]) -> DataFrame:
    """Union of layers of one group, columns aligned by name."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged

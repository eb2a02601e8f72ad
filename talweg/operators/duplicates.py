"""Duplicate flags and counts over attributes, geometries and whole records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talweg.functions.geometry import signature
from talweg.functions.naming import (
    AREA, FID_COLUMN, GEOMETRY, ID_COLUMN, LATITUDE, LONGITUDE, PERIMETER, REPAIR_FLAG, SRID,
)
from talweg.operators.scale import HOT_ROWS, row_digest, with_group_facts

# Identifiers, metrics and the geometry say nothing about a repeated record.
NOT_COMPARED = {
    ID_COLUMN, FID_COLUMN, AREA, PERIMETER, LONGITUDE, LATITUDE, GEOMETRY, SRID, REPAIR_FLAG, "bbox",
}
RECORD_FLAG = "dup_registro"


def compared_columns(df: DataFrame, ignored: set[str] = frozenset(NOT_COMPARED)) -> list[str]:
    return [c for c in df.columns if c not in ignored]


def geometry_key(column: str = GEOMETRY) -> Column:
    """Grouping key of a geometry; null geometries equal each other."""
    return F.coalesce(signature(F.col(column)), F.lit("-"))


def flag_duplicates(
    df: DataFrame, key: Column, out: str, row_key: list[str], hot_rows: int = HOT_ROWS,
    base: DataFrame | None = None,
) -> DataFrame:
    """All members of a group of equal rows flagged; ``row_key`` spreads large groups."""
    joined = with_group_facts(df, key, [], F.col("_n") > 1, row_key, hot_rows=hot_rows, base=base)
    return joined.withColumn(out, F.col("_n").isNotNull()).drop("_n")


def flag_attribute_duplicates(
    df: DataFrame, columns: list[str] | None = None, out: str = "dup_attributes",
    row_key: list[str] | None = None, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    columns = columns or compared_columns(df)
    if not columns:
        return df.withColumn(out, F.lit(False))
    return flag_duplicates(df, row_digest(*columns), out, row_key or [ID_COLUMN], hot_rows)


def flag_repeats(
    df: DataFrame, columns: list[str], order_by: str, out: str = "repeat", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Every member of a group after its first row, in the given (unique) order."""
    joined = with_group_facts(
        df, row_digest(*columns), [F.min(order_by).alias("_first")], F.col("_n") > 1, [order_by],
        hot_rows=hot_rows,
    )
    return joined.withColumn(
        out, F.coalesce(F.col(order_by) > F.col("_first"), F.lit(False))
    ).drop("_n", "_first")


def flag_geometric_duplicates(
    df: DataFrame, out: str = "dup_geometry", row_key: list[str] | None = None, hot_rows: int = HOT_ROWS,
    base: DataFrame | None = None,
) -> DataFrame:
    return flag_duplicates(df, geometry_key(), out, row_key or [ID_COLUMN], hot_rows, base)


def flag_record_duplicates(
    df: DataFrame, out: str = RECORD_FLAG, row_key: list[str] | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Whole-record duplicates, ignoring the geometry and the identifiers."""
    ignored = {GEOMETRY, SRID, ID_COLUMN, FID_COLUMN, "bbox", "dup_geometry", "dup_attributes", REPAIR_FLAG}
    columns = compared_columns(df, ignored)
    if not columns:
        return df.withColumn(out, F.lit(False))
    return flag_duplicates(df, row_digest(*columns), out, row_key or [ID_COLUMN], hot_rows)


def duplicate_count(df: DataFrame, key: Column) -> DataFrame:
    """Number of rows in groups of two or more: a two-level aggregate, no join back."""
    return (
        df.groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("n"))
    )

"""Output quality audit: duplicates, OGC-invalid geometries, summary."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talweg.functions.geometry import ogc_errors
from talweg.functions.naming import GEOMETRY, REPAIR_FLAG, SRID
from talweg.functions.validity import SAFE_REPAIR_NULL
from talweg.operators.duplicates import (
    compared_columns, duplicate_count, flag_attribute_duplicates, flag_geometric_duplicates,
    flag_record_duplicates, geometry_key,
)
from talweg.operators.scale import row_digest

REASON = "ogc_motivo"


@dataclass(frozen=True)
class QualityConfig:
    attribute_duplicates: bool = True
    geometric_duplicates: bool = True
    ogc_invalid_geometries: bool = True
    export_report_files: bool = True
    full_record_duplicate_flag: bool = True

    @classmethod
    def from_profile(cls, config: Mapping | None) -> "QualityConfig":
        """Boolean switches of a profile over the defaults."""
        switches = {
            k: v for k, v in (config or {}).items()
            if k in cls.__dataclass_fields__ and isinstance(v, bool)
        }
        return replace(cls(), **switches)


def with_ogc_errors(df: DataFrame, out: str = "ogc_errors", **expected) -> DataFrame:
    """Error array per row; a geometry nulled by safe repair has that one reason."""
    errors = ogc_errors(F.col(GEOMETRY), F.col(SRID), **expected)
    if REPAIR_FLAG in df.columns:
        errors = F.when(F.col(REPAIR_FLAG), F.array(F.lit(SAFE_REPAIR_NULL))).otherwise(errors)
    return df.withColumn(out, errors)


def ogc_invalid_records(df: DataFrame, **expected) -> DataFrame:
    """Rows with errors and their joined reason."""
    checked = with_ogc_errors(df, "_errors", **expected).filter(F.size("_errors") > 0)
    return checked.withColumn(REASON, F.array_join("_errors", " | ")).drop("_errors")


def error_histogram(df: DataFrame, errors: str = "ogc_errors") -> DataFrame:
    return (
        df.filter(F.size(errors) > 0)
        .select(F.explode(errors).alias("error"))
        .groupBy("error").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "error")
    )


def quality_summary(df: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """Rows (check, n) of the enabled checks; disabled ones count zero.

    Counting needs no flags: duplicates are two-level aggregates over digests.
    """
    one = lambda name, frame: frame.select(F.lit(name).alias("check"), F.col("n").cast("bigint"))
    zero = df.sparkSession.range(1).select(F.lit(0).alias("n"))
    columns = compared_columns(df)
    attributes = duplicate_count(df, row_digest(*columns)) if config.attribute_duplicates and columns else zero
    has_geometry = GEOMETRY in df.columns
    shapes = duplicate_count(df, geometry_key()) if config.geometric_duplicates and has_geometry else zero
    if config.ogc_invalid_geometries and has_geometry:
        invalid = with_ogc_errors(df, "_e").agg(F.count_if(F.size("_e") > 0).alias("n"))
    else:
        invalid = zero
    nulled = df.agg(F.count_if(F.col(REPAIR_FLAG)).alias("n")) if REPAIR_FLAG in df.columns else zero
    return (
        one("attribute_duplicates", attributes)
        .unionByName(one("geometric_duplicates", shapes))
        .unionByName(one("ogc_invalid", invalid))
        .unionByName(one("safe_null", nulled))
    )


@dataclass(frozen=True)
class QualityReports:
    attribute_duplicates: DataFrame | None
    geometric_duplicates: DataFrame | None
    ogc_invalid: DataFrame | None


def quality_reports(
    df: DataFrame, config: QualityConfig = QualityConfig(), row_key: list[str] | None = None
) -> QualityReports:
    """The three audit tables; None where a check is disabled."""
    attributes = shapes = invalid = None
    if config.attribute_duplicates:
        attributes = flag_attribute_duplicates(df, row_key=row_key).filter("dup_attributes").drop("dup_attributes")
    if config.geometric_duplicates:
        shapes = df
        if config.full_record_duplicate_flag:
            shapes = flag_record_duplicates(shapes, row_key=row_key)
        shapes = flag_geometric_duplicates(shapes, row_key=row_key, base=df).filter("dup_geometry").drop("dup_geometry")
    if config.ogc_invalid_geometries:
        invalid = ogc_invalid_records(df)
    return QualityReports(attributes, shapes, invalid)

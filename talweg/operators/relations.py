"""Cross-column relations: the target is forced to what its source maps to."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from talweg.operators.scale import checked_side

UNCHECKED_REASON = "Valor fonte fora do dominio configurado para {name}."
NULL_LABEL = "<NULL>"


@dataclass(frozen=True)
class Relation:
    name: str
    source: str
    target: str


def resolve_column(token: str, columns: list[str]) -> str | None:
    """Column of a relation token: prefixed, exact, then the first suffix match by name."""
    if f"sdb_{token}" in columns:
        return f"sdb_{token}"
    if token in columns:
        return token
    return next((c for c in sorted(columns) if c.endswith(f"_{token}")), None)


def resolve_relation(name: str, columns: list[str]) -> Relation | None:
    if "_to_" not in name:
        return None
    source, target = (resolve_column(t, columns) for t in name.split("_to_", 1))
    return Relation(name, source, target) if source and target else None


def enforce_relation(
    df: DataFrame, relation: Relation, pairs: DataFrame, source: str, target: str, status: str,
    small: bool = False,
) -> DataFrame:
    """Force column ``target`` to the mapped value of ``source``; ``status`` tells what happened.

    ``pairs(src_value, dst_value)`` has one row per source value; it is broadcast
    if the caller knows it to be ``small``. Relations on one target are applied one after another.
    """
    side = checked_side(
        pairs.select(F.col("src_value").alias("_src"), F.col("dst_value").alias("_dst")), small
    )
    joined = df.join(side, F.col(f"`{source}`").cast("string") == F.col("_src"), "left")
    current = F.col(f"`{target}`")
    return (
        joined.withColumn(
            status,
            F.when(F.col("_dst").isNull(), "unchecked")
            .when(current == F.col("_dst"), "consistent")
            .otherwise("autocorrected"),
        )
        .withColumn(target, F.coalesce("_dst", current))
        .drop("_src", "_dst")
    )


def relation_summary(df: DataFrame, name: str, source: str, status: str) -> DataFrame:
    """Rows (relation, status, source_value, n); the value is kept where it explains the status."""
    value = F.when(
        F.col(status) != "consistent", F.coalesce(F.col(f"`{source}`").cast("string"), F.lit(NULL_LABEL))
    )
    return (
        df.groupBy(F.col(status).alias("status"), value.alias("source_value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(name).alias("relation"), "status", "source_value", "n")
    )


def top_counts(counts: DataFrame, by: list[str], value: str, limit: int) -> DataFrame:
    """The most frequent values per group (a report): ties go by value."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), value))
    return counts.withColumn("rank", rank).filter(F.col("rank") <= limit)

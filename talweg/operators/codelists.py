"""Integrity audits of code lists: every reference must resolve."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VALIDATE_DOMAIN = "validate_shapefile_attribute"


def dangling_aliases(aliases: DataFrame, values: DataFrame) -> DataFrame:
    """Aliases whose target is not an accepted value."""
    return aliases.select("profile", "column", "alias", "canonical").join(
        values.select("profile", "column", "canonical"), ["profile", "column", "canonical"], "left_anti"
    )


def broken_relations(pairs: DataFrame, fields: DataFrame) -> DataFrame:
    """Rows (profile, relation, problem): malformed names, unconfigured sides, pairs without text.

    Profiles without any configured field are not checked for fields.
    """
    name = F.col("relation")
    at = F.instr(name, "_to_")
    sides = pairs.select("profile", "relation").distinct().filter(at > 0).select(
        "profile", "relation",
        F.explode(F.array(
            F.struct(F.lit("source").alias("side"), F.substring_index(name, "_to_", 1).alias("token")),
            F.struct(F.lit("target").alias("side"), F.expr("substring(relation, instr(relation, '_to_') + 4)").alias("token")),
        )).alias("s"),
    ).select("profile", "relation", "s.*")
    tokens = fields.select("profile", F.explode(F.array(
        F.col("column"), F.regexp_replace("column", "^sdb_", "")
    )).alias("token")).distinct()
    unknown = (
        sides.join(fields.select("profile").distinct(), "profile", "left_semi")
        .join(tokens, ["profile", "token"], "left_anti")
        .select("profile", "relation", F.concat(F.lit("unconfigured_"), F.col("side")).alias("problem"))
    )
    malformed = pairs.filter(at == 0).select("profile", "relation", F.lit("malformed_name").alias("problem"))
    untyped = pairs.filter("src_value IS NULL OR dst_value IS NULL").select(
        "profile", "relation", F.lit("non_text_pair").alias("problem")
    )
    return unknown.unionByName(malformed).unionByName(untyped).distinct()


def style_coverage(literals: DataFrame, values: DataFrame) -> DataFrame:
    """Rows (profile, property, literal, problem) between style literals and a non-empty domain."""
    wanted = literals.select("profile", "property", "literal").distinct()
    accepted = values.select("profile", F.col("column").alias("property"), F.col("canonical").alias("literal")).distinct()
    keys, every = ["profile", "property"], ["profile", "property", "literal"]
    unknown = wanted.join(accepted.select(keys).distinct(), keys, "left_semi").join(accepted, every, "left_anti")
    missing = accepted.join(wanted.select(keys).distinct(), keys, "left_semi").join(wanted, every, "left_anti")
    return unknown.withColumn("problem", F.lit("unknown")).unionByName(missing.withColumn("problem", F.lit("missing")))


def broken_functions(functions: DataFrame, fields: DataFrame, registered: DataFrame) -> DataFrame:
    """Rows (profile, column, function, problem): unregistered functions, validated columns without a domain."""
    used = functions.select("profile", "column", "function").distinct()
    unregistered = used.join(registered.select("function"), "function", "left_anti").select(
        "profile", "column", "function", F.lit("not_registered").alias("problem")
    )
    no_domain = (
        used.filter(F.col("function") == VALIDATE_DOMAIN)
        .join(fields.select("profile").distinct(), "profile", "left_semi")
        .join(fields.select("profile", "column"), ["profile", "column"], "left_anti")
        .select("profile", "column", "function", F.lit("no_domain").alias("problem"))
    )
    return unregistered.unionByName(no_domain)


def merge_functions(base: DataFrame, extra: DataFrame, keys: list[str]) -> DataFrame:
    """Order-preserving union of function lists per column: rows (keys..., functions)."""
    left, right = base.withColumnRenamed("functions", "_a"), extra.withColumnRenamed("functions", "_b")
    empty = F.array().cast("array<string>")
    return left.join(right, keys, "full").select(
        *keys, F.array_union(F.coalesce("_a", empty), F.coalesce("_b", empty)).alias("functions")
    )

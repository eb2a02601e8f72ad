"""Domain validation: classify values against accepted values and aliases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talweg.functions.text import rule_key, strip
from talweg.operators.scale import checked_side

# Reasons of a classification.
NULL_VALUE, BLANK_VALUE = "Valor nulo.", "Valor vazio."
INVALID_VALUE = "Valor fora do dominio configurado."
ALIAS_REASON = "Valor normalizado por alias: "
STATUSES = ("valid", "normalized", "invalid", "empty", "unconfigured")


def domain_lookup(values: DataFrame, aliases: DataFrame, by: list[str]) -> DataFrame:
    """One row per (by..., key): the canonical value and how it is reached.

    Accepted values win over aliases; among equal keys the last listed wins.
    ``values(by..., canonical, position)``, ``aliases(by..., alias, canonical, position)``.
    """
    entries = values.select(
        *by, rule_key(F.col("canonical")).alias("key"), "canonical", F.lit(1).alias("rank"), "position"
    ).unionByName(
        aliases.select(
            *by, rule_key(F.col("alias")).alias("key"), "canonical", F.lit(0).alias("rank"), "position"
        )
    )
    best = F.max_by(F.struct("canonical", "rank"), F.struct("rank", "position"))
    return (
        entries.groupBy(*by, "key").agg(best.alias("best"))
        .select(*by, "key", F.col("best.canonical").alias("canonical"),
                (F.col("best.rank") == 0).alias("by_alias"))
    )


def classify(
    df: DataFrame, column: str, lookup: DataFrame, out: str = "domain", small: bool = False
) -> DataFrame:
    """Add ``out`` = struct(value, status, reason) for a column, given its (key, canonical, by_alias).

    A left join on the comparison key. The lookup is broadcast if the caller knows it
    to be ``small``; otherwise adaptive execution decides by measured bytes and splits hot values.
    """
    source, text = F.col(f"`{column}`"), F.col("_text")
    side = checked_side(
        lookup.select(F.col("key").alias("_key"), F.col("canonical").alias("_canonical"),
                      F.col("by_alias").alias("_alias")),
        small,
    )
    # A column of its own is worked out once, for the key and for the result.
    keyed = df.withColumn("_text", strip(source.cast("string"))).withColumn("_key", F.when(text != "", rule_key(text)))
    return (
        keyed.join(side, "_key", "left")
        .withColumn(out, classification(source, text, F.col("_canonical"), F.col("_alias")))
        .drop("_key", "_text", "_canonical", "_alias")
    )


def classification(source: Column, text: Column, canonical: Column, by_alias: Column) -> Column:
    def result(value, status, reason):
        return F.struct(
            value.cast("string").alias("value"), F.lit(status).alias("status"), reason.alias("reason")
        )

    return (
        F.when(source.isNull(), result(source, "empty", F.lit(NULL_VALUE)))
        .when(text == "", result(source, "empty", F.lit(BLANK_VALUE)))
        .when(canonical.isNull(), result(text, "invalid", F.lit(INVALID_VALUE)))
        .when(by_alias, result(canonical, "normalized",
                               F.concat(F.lit(ALIAS_REASON), text, F.lit(" -> "), canonical)))
        .otherwise(result(canonical, "valid", F.lit("")))
    )


def unconfigured(source: Column) -> Column:
    """Classification of a column that has no domain."""
    return F.struct(
        source.cast("string").alias("value"), F.lit("unconfigured").alias("status"), F.lit("").alias("reason")
    )


def value_mapping(df: DataFrame, column: str, lookup: DataFrame) -> DataFrame:
    """Replacement, status and use of every distinct non-empty value of a column."""
    text = strip(F.col(f"`{column}`").cast("string"))
    distinct = df.select(text.alias("value")).filter("value != ''").distinct()
    return classify(distinct, "value", lookup).select(
        "value", F.col("domain.value").alias("replacement"), F.col("domain.status").alias("status"),
        (F.col("domain.status") == "normalized").alias("corrected"),
    )


def status_counts(df: DataFrame, classified: dict[str, str]) -> DataFrame:
    """Rows (column, status, reason, n) from one aggregate over all classified columns.

    ``classified`` maps a column name to its struct column. The statuses and the
    reasons counted per status are a fixed small set, so nothing is exploded.
    """
    cells = [
        (name, out, status, reason)
        for name, out in classified.items()
        for status, reason in (
            ("valid", ""), ("normalized", ""), ("invalid", INVALID_VALUE),
            ("empty", NULL_VALUE), ("empty", BLANK_VALUE), ("unconfigured", ""),
        )
    ]
    counts = []
    for i, (_, out, status, reason) in enumerate(cells):
        test = F.col(f"`{out}`.status") == status
        if reason:
            test = test & (F.col(f"`{out}`.reason") == reason)
        counts.append(F.count_if(test).alias(f"c{i}"))
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("column"), F.lit(s).alias("status"), F.lit(r).alias("reason"),
                     F.col(f"c{i}").alias("n"))
            for i, (n, _, s, r) in enumerate(cells)
        ]
    )
    return df.agg(*counts).select(F.inline(rows)).filter("n > 0")


def invalid_value_counts(df: DataFrame, lookups: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (column, value, n) of out-of-domain values; equal trimmed texts add up.

    ``lookups(column, key, canonical, by_alias)`` holds the domains of all columns. The layer is scanned once, whatever their
    number: its cells are one stream of (column, value), counted together and joined once.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), strip(F.col(f"`{c}`").cast("string")).alias("value")) for c in columns])
    counted = df.select(F.inline(cells)).filter("value != ''").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return (
        counted.withColumn("key", rule_key(F.col("value")))
        .join(lookups.select("column", "key"), ["column", "key"], "left_anti")
        .select("column", "value", "n")
    )

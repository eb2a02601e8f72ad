"""Rule mining: domains, aliases and relations learned from observed values.

Results are rule rows for the next run; the rules in use never change here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talweg.functions.text import (
    alias_stem, canonical_domain_text, looks_like_mojibake, repair_mojibake, rule_key, strip,
)
from talweg.operators.identifiers import add_sequential_id
from talweg.operators.scale import stage


def generate_domain(df: DataFrame, column: str) -> DataFrame:
    """Domain rows (kind, value, canonical) of a column's distinct texts.

    Clean texts are accepted in canonical form; what differs from its canonical
    form, or had to be repaired, becomes an alias.
    """
    text = strip(F.col(f"`{column}`").cast("string"))
    # Written, as the tests of canonical texts would else move before the distinct step, onto every row, and run once for each kind.
    distinct = stage(df.select(text.alias("value")).filter("value != ''").distinct())
    broken = looks_like_mojibake(F.col("value"))
    canonical = canonical_domain_text(
        F.when(broken, repair_mojibake(F.col("value"))).otherwise(F.col("value"))
    )
    rows = distinct.select("value", canonical.alias("canonical")).filter("canonical != ''")
    accepted = rows.select(
        F.lit("accepted").alias("kind"), F.col("canonical").alias("value"), "canonical"
    ).distinct()
    aliases = rows.filter("value != canonical").select(F.lit("alias").alias("kind"), "value", "canonical")
    return accepted.unionByName(aliases)


def accepted_arrays(domain: DataFrame, by: list[str]) -> DataFrame:
    """Sorted accepted values per domain, as one array each, for domains that are bounded rule sets; ``accepted_chunks`` is for all others."""
    return domain.filter("kind = 'accepted'").groupBy(*by).agg(
        F.array_sort(F.collect_set("value")).alias("accepted_values")
    )


def accepted_chunks(domain: DataFrame, by: list[str], size: int = 10_000) -> DataFrame:
    """Rows (by..., chunk, accepted_values): sorted accepted values of each domain, at most ``size`` in a row, however large it is.

    Values are numbered in order across all domains by range partitions, so no task sorts a whole domain.
    """
    values = domain.filter("kind = 'accepted'").select(*by, "value").distinct()
    numbered = add_sequential_id(values, [*by, "value"], column="_number")
    first = numbered.groupBy(*by).agg(F.min("_number").alias("_first"))
    placed = numbered.join(first, by).withColumn("chunk", F.floor((F.col("_number") - F.col("_first")) / size))
    return placed.groupBy(*by, "chunk").agg(F.array_sort(F.collect_list("value")).alias("accepted_values"))


def functional_dependency(df: DataFrame, source: Column, target: Column, name: str) -> DataFrame:
    """Rows (relation, src_value, dst_value, ambiguous) of a column pair.

    A source is functional when its smallest and largest target agree, so no set
    of targets is built; ambiguous sources keep all their targets as rows.
    """
    pairs = (
        df.select(source.cast("string").alias("src_value"), target.cast("string").alias("dst_value"))
        .filter("src_value != '' AND dst_value != ''")
        .distinct()
    )
    spread = pairs.groupBy("src_value").agg((F.min("dst_value") != F.max("dst_value")).alias("ambiguous"))
    return pairs.join(spread, "src_value").select(F.lit(name).alias("relation"), "src_value", "dst_value", "ambiguous")


def clean_value(value: Column) -> Column:
    """Trimmed text; blank and textual nulls are null."""
    text = strip(value.cast("string"))
    return F.when(~F.lower(text).isin("", "nan", "<na>"), text)


def mine_relations(
    df: DataFrame, relations: list[tuple[str, str, str]], lookups: DataFrame, configured: list[str], existing: DataFrame
) -> DataFrame:
    """New pairs (relation, src_value, dst_value) seen with exactly one target, for all (name, source, target) in one scan.

    Both sides must be valid in their domains (``lookups(column, key, canonical, by_alias)``; a column that isn't ``configured`` is free),
    and a source already mapped in ``existing(relation, src_value)`` is left alone. Where two raw sources share a
    canonical value, the first in order decides.
    """
    text = lambda c: F.nullif(strip(F.col(f"`{c}`").cast("string")), F.lit(""))
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("relation"), F.lit(a).alias("src_column"), F.lit(b).alias("dst_column"), text(a).alias("src"), text(b).alias("dst"))
            for name, a, b in relations
        ]
    )
    found = (
        df.select(F.inline(pairs)).filter("src IS NOT NULL AND dst IS NOT NULL")
        .groupBy("relation", "src_column", "dst_column", "src")
        .agg(F.min("dst").alias("dst"), F.max("dst").alias("last"))
        .filter("dst = last").drop("last")
    )
    for side in ("src", "dst"):
        known = lookups.select(F.col("column").alias(f"{side}_column"), F.col("key").alias("_key"), F.col("canonical").alias("_canonical"))
        free = ~F.col(f"{side}_column").isin(*configured) if configured else F.lit(True)
        found = (
            found.withColumn("_key", rule_key(F.col(side))).join(known, [f"{side}_column", "_key"], "left")
            .withColumn(f"{side}_value", F.when(free, F.col(side)).otherwise(F.col("_canonical")))
            .filter(F.col(f"{side}_value").isNotNull()).drop("_key", "_canonical")
        )
    return (
        found.groupBy("relation", "src_value")
        .agg(F.min_by("dst_value", "src").alias("dst_value"))
        .join(existing.select("relation", "src_value"), ["relation", "src_value"], "left_anti")
        .select("relation", "src_value", "dst_value")
    )


def autofix_domain(invalid: DataFrame, accepted: DataFrame) -> DataFrame:
    """Decide every invalid value of a column: rows (column, kind, value, canonical).

    ``invalid(column, value, n)`` and ``accepted(column, canonical)``. Values count
    in order of frequency, then text. A broken text becomes an alias of its repair,
    which is accepted if new. Another value becomes an alias when exactly one
    accepted value shares its stem at that point, and is accepted otherwise, so
    the first of an unknown stem is accepted and its later spellings follow it.
    That sequence is resolved with per-stem aggregates instead of a loop.
    """
    value = F.col("value")
    repaired = repair_mojibake(value)
    broken = looks_like_mojibake(value)
    rank = F.struct((-F.col("n")).alias("n"), value.alias("v"))
    items = (
        invalid.withColumn("broken", broken)
        .withColumn("text", F.when(broken, repaired).otherwise(value))
        .filter("text IS NOT NULL")
        .withColumn("rank", rank)
        .withColumn("norm", rule_key(value))
    )
    # Values with one comparison key: the first decides, later ones are known by then.
    firsts = items.groupBy("column", "norm").agg(F.min_by(F.struct("value", "text", "broken", "rank"), "rank").alias("i"))
    items = firsts.select("column", "norm", "i.*").withColumn("key", rule_key(F.col("text")))
    items = stage(items.withColumn("stem", alias_stem(F.col("text"))))

    known = accepted.select("column", "canonical").distinct()
    known = known.withColumn("key", rule_key(F.col("canonical"))).withColumn("stem", alias_stem(F.col("canonical")))
    by_key = known.groupBy("column", "key").agg(F.max("canonical").alias("known_text"))
    by_stem = known.filter("stem != ''").groupBy("column", "stem").agg(
        F.count(F.lit(1)).alias("a0"), F.min("canonical").alias("sole")
    )
    items = items.join(by_key, ["column", "key"], "left").join(
        by_stem, ["column", "stem"], "left"
    ).withColumn("a0", F.coalesce("a0", F.lit(0)))

    # First repair that introduces each key, and first value of each stem.
    repair_first = items.filter("broken").groupBy("column", "stem", "key").agg(
        F.min("rank").alias("repair_rank"), F.min_by("text", "rank").alias("repair_text")
    )
    lead = items.groupBy("column", "stem").agg(
        F.min("rank").alias("lead_rank"), F.min_by("text", "rank").alias("lead_text"),
        F.min_by("key", "rank").alias("lead_key"),
    )
    second = (
        items.filter("broken AND known_text IS NULL")
        .join(lead, ["column", "stem"])
        .filter("a0 > 0 OR key != lead_key")
        .groupBy("column", "stem").agg(F.min("rank").alias("second_rank"))
    )
    items = (
        items.join(repair_first, ["column", "stem", "key"], "left")
        .join(lead, ["column", "stem"], "left")
        .join(second, ["column", "stem"], "left")
    )
    # One accepted value per stem holds from the lead (or the start) until a repair adds another.
    single = (
        ((F.col("a0") == 1) | ((F.col("a0") == 0) & (F.col("rank") > F.col("lead_rank"))))
        & (F.col("second_rank").isNull() | (F.col("rank") < F.col("second_rank")))
        & (F.col("stem") != "")
    )
    base = F.when(F.col("a0") == 1, F.col("sole")).otherwise(F.col("lead_text"))
    plain = (
        F.when(F.col("repair_rank") < F.col("rank"), F.lit(None))
        .when(single, F.struct(F.lit("alias").alias("kind"), base.alias("canonical")))
        .otherwise(F.struct(F.lit("accepted").alias("kind"), F.col("value").alias("canonical")))
    )
    items = stage(items.withColumn("plain", F.when(~F.col("broken"), plain)))
    # A repair takes an accepted text with its key if one exists by then, else it adds its own.
    taken = items.filter("plain.kind = 'accepted'").select(
        "column", F.col("norm").alias("key"), F.col("value").alias("plain_text"), F.col("rank").alias("plain_rank")
    )
    repairs = items.filter("broken").join(taken, ["column", "key"], "left")
    target = F.coalesce(
        "known_text", F.when(F.col("plain_rank") < F.col("rank"), F.col("plain_text")), "repair_text"
    )
    repairs = repairs.withColumn("target", target)
    return (
        items.filter("plain IS NOT NULL")
        .select("column", "plain.kind", "value", "plain.canonical")
        .unionByName(repairs.select("column", F.lit("alias").alias("kind"), "value", F.col("target").alias("canonical")))
        .unionByName(
            repairs.filter("known_text IS NULL AND target = repair_text AND rank = repair_rank").select(
                "column", F.lit("accepted").alias("kind"), F.col("target").alias("value"),
                F.col("target").alias("canonical"),
            )
        )
    )

"""Data dictionary: descriptions, their resolution, attribute differences, types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talweg.functions.text import attribute_key, lookup_key, stringify

GENERIC_THEME = "generic"  # theme key of descriptions shared by all layers


def prefixed(name: Column) -> Column:
    """Source-prefixed attribute key; prefixed and derived names stay."""
    key = attribute_key(name)
    return F.when((key == "") | key.rlike("^(sdb_|acm_)"), key).otherwise(F.concat(F.lit("sdb_"), key))


def unprefixed(name: Column) -> Column:
    return F.regexp_replace(attribute_key(name), "^sdb_", "")


def descriptions(rows: DataFrame, order_by: str, derived_prefix: str = "derived") -> DataFrame:
    """Rows (theme, namespace, name, description): first non-empty wins per name.

    Each entry counts under its original and its derived name; a missing
    description is borrowed from the other one.
    """
    original, derived = stringify(F.col("original_description")), stringify(
        F.col(f"{derived_prefix}_description")
    )
    entry = lambda space, name, own, other: F.struct(
        F.lit(space).alias("namespace"), attribute_key(F.col(name)).alias("name"),
        F.when(own != "", own).otherwise(other).alias("description"),
    )
    both = F.array(
        entry("original", "original_attribute_name", original, derived),
        entry("derived", f"{derived_prefix}_attribute_name", derived, original),
    )
    long = rows.select(
        lookup_key(F.col("theme")).alias("theme"), F.col(order_by).alias("at"), F.explode(both).alias("e")
    ).select("theme", "at", "e.*").filter("theme != '' AND name != ''")
    first = F.min_by("description", F.when(F.col("description") != "", F.col("at")))
    return long.groupBy("theme", "namespace", "name").agg(F.coalesce(first, F.lit("")).alias("description"))


def resolve_descriptions(
    fields: DataFrame, dictionary: DataFrame, stage: str = "silver", generic_theme: str = GENERIC_THEME
) -> DataFrame:
    """Description of rows (theme, field): the best of the ordered candidate names.

    One join on the exploded candidates, then the non-empty one with the lowest
    priority; derived fields fall back to the generic theme.
    """
    key = attribute_key(F.col("field"))
    own, generic = lookup_key(F.col("theme")), F.lit(generic_theme)
    derived = key.startswith("acm_")

    def candidate(order, theme, namespace, name, when=F.lit(True)):
        return F.when(
            when,
            F.struct(F.lit(order).alias("order"), theme.alias("d_theme"),
                     F.lit(namespace).alias("namespace"), name.alias("name")),
        )

    def preferring(namespace, theme, base, when):
        if namespace == "original":
            names = (("original", key), ("derived", prefixed(F.col("field"))), ("derived", key))
        else:
            names = (("derived", key), ("derived", prefixed(F.col("field"))),
                     ("original", unprefixed(F.col("field"))), ("original", key))
        return [candidate(base + i, theme, n, c, when) for i, (n, c) in enumerate(names)]

    plain = "original" if stage == "bronze" else "derived"
    options = (
        preferring("derived", own, 0, derived) + preferring("derived", generic, 10, derived)
        + preferring(plain, own, 0, ~derived)
    )
    asked = fields.select("theme", "field").distinct()
    long = asked.select("theme", "field", F.explode(F.array_compact(F.array(*options))).alias("c")).select(
        "theme", "field", "c.*"
    )
    side = dictionary.filter("description != ''").withColumnRenamed("theme", "d_theme")
    found = (
        long.join(side, ["d_theme", "namespace", "name"])
        .groupBy("theme", "field").agg(F.min_by("description", "order").alias("description"))
    )
    return asked.join(found, ["theme", "field"], "left").withColumn(
        "description", F.coalesce("description", F.lit(""))
    )


def attribute_diff(layers: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Rows (layer, attribute, difference) of layers(layer, theme, attribute) against dictionary rows.

    ``dictionary(theme, attribute)``; 'missing' keeps the dictionary's label, 'extra'
    the layer's; a theme without entries gives one 'theme_not_found' row.
    """

    def canonical(column):
        key = attribute_key(F.col(column))
        free = (key == "") | key.isin("-", "geometry", "fid") | key.rlike("^(sdb_|acm_)")
        return F.when(free, key).otherwise(F.concat(F.lit("sdb_"), key))

    known = (
        dictionary.select(lookup_key(F.col("theme")).alias("t"), canonical("attribute").alias("a"), "attribute")
        .filter("t != '' AND a NOT IN ('', '-', 'fid') AND NOT startswith(a, 'acm_')")
        .groupBy("t", "a").agg(F.min("attribute").alias("label"))
    )
    have = (
        layers.select("layer", lookup_key(F.col("theme")).alias("t"), canonical("attribute").alias("a"), "attribute")
        .filter("a NOT IN ('', 'geometry')")
        .groupBy("layer", "t", "a").agg(F.min("attribute").alias("label"))
    )
    asked = layers.select("layer", lookup_key(F.col("theme")).alias("t")).distinct()
    themes = known.select("t").distinct()
    missing = asked.join(known, "t").join(have.select("layer", "t", "a"), ["layer", "t", "a"], "left_anti")
    extra = have.join(themes, "t", "left_semi").join(known.select("t", "a"), ["t", "a"], "left_anti")
    unknown = asked.join(themes, "t", "left_anti")
    row = lambda df, label, what: df.select("layer", label.alias("attribute"), F.lit(what).alias("difference"))
    return (
        row(missing, F.col("label"), "missing")
        .unionByName(row(extra, F.col("label"), "extra"))
        .unionByName(row(unknown, F.lit(None).cast("string"), "theme_not_found"))
    )


def attribute_types(fields: DataFrame, types: DataFrame) -> DataFrame:
    """Type of rows (layer, field) from types(layer, name, type).

    Exact name, then source-prefixed, then a suffix ``_field`` that only one name has.
    Suffixes become join keys, so the suffix case is an equi-join as well.
    """
    parts = F.split("name", "_")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda k: F.array_join(F.slice(parts, k, F.size(parts) - k + 1), "_"),
    )
    keyed = types.select("layer", F.explode(F.array_distinct(suffixes)).alias("field"), F.struct("name", "type").alias("known"))
    # Questions and answers meet as rows of one group instead of in a join: the planner takes exploded rows for as few as
    # their source's, and would send either side through the driver.
    asked = fields.select("layer", "field", F.lit(None).cast(keyed.schema["known"].dataType).alias("known"))
    name, found = F.col("known.name"), F.col("known").isNotNull()
    rank = F.when(name == F.col("field"), 0).when(name == F.concat(F.lit("sdb_"), F.col("field")), 1).otherwise(2)
    best = F.col("b")
    return (
        asked.unionByName(keyed).repartition("layer", "field").groupBy("layer", "field").agg(
            F.bool_or(~found).alias("asked"), F.count_if(found & (rank == 2)).alias("suffixes"),
            F.min(F.when(found & F.col("layer").isNotNull(), F.struct(rank.alias("rank"), "known.name", "known.type"))).alias("b"),
        )
        .filter("asked")
        .select("layer", "field", F.coalesce(F.when((best["rank"] < 2) | (F.col("suffixes") == 1), best["type"]), F.lit("")).alias("type"))
    )

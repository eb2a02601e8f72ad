"""Value counts and column profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talweg.functions.naming import GEOMETRY
from talweg.functions.text import strip

NULL_LABEL = "<NULL>"


def resolve_columns(df: DataFrame, wanted: list[str] | None = None) -> list[str]:
    """Requested columns by exact, case-insensitive or unprefixed name; geometry never."""
    if wanted is None:
        return [c for c in df.columns if c != GEOMETRY]
    folded = {c.casefold(): c for c in df.columns}
    found = []
    for name in wanted:
        bare = name[4:] if name.startswith(("sdb_", "acm_")) else None
        if name in df.columns:
            found.append(name)
        elif name.casefold() in folded:
            found.append(folded[name.casefold()])
        elif bare in df.columns:
            found.append(bare)
    return [c for c in dict.fromkeys(found) if c != GEOMETRY]


def value_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows (column, value, n): text trimmed, blank counted as null, null shown as a label."""
    names = resolve_columns(df, columns)
    if not names:
        raise ValueError("no column to count")
    types = {f.name: f.dataType for f in df.schema.fields}
    shown = []
    for name in names:
        value = F.col(f"`{name}`")
        if isinstance(types[name], T.StringType):
            value = F.nullif(strip(value), F.lit(""))
        shown.append(F.coalesce(value.cast("string"), F.lit(NULL_LABEL)).alias(name))
    return (
        df.select(*shown)
        .unpivot([], names, "column", "value")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def column_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows (column, type, unique_values); null counts as one value."""
    types = dict(df.dtypes)
    names = resolve_columns(df, columns)
    kinds = F.create_map(*[F.lit(x) for name in names for x in (name, types[name])])
    return (
        value_counts(df, names)
        .groupBy("column")
        .agg(F.count(F.lit(1)).alias("unique_values"))
        .select("column", kinds[F.col("column")].alias("type"), "unique_values")
    )


def unique_texts(df: DataFrame, column: str, order_by: str) -> DataFrame:
    """Distinct non-empty trimmed texts with the order key of their first appearance."""
    text = strip(F.col(f"`{column}`").cast("string"))
    return (
        df.select(text.alias("value"), F.col(order_by).alias("first_at"))
        .filter("value != ''")
        .groupBy("value")
        .agg(F.min("first_at").alias("first_at"))
    )

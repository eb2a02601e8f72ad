"""Declared schemas: presence, types, coercion with a new-null guard."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talweg.functions.naming import FID_COLUMN, GEOMETRY, SRID, derived_name, source_name
from talweg.functions.text import attribute_key, strip

STRING_TYPES = {"string", "str", "text"}
NUMBER_TYPES = {"number", "numeric", "float", "double"}
INTEGER_TYPES = {"integer", "int"}
DATE_TYPES = {"datetime", "date"}
BOOLEAN_TYPES = {"boolean", "bool"}
# Texts read as booleans.
TRUE_TEXTS, FALSE_TEXTS = ("true", "1", "sim", "yes"), ("false", "0", "nao", "no")
# Legacy spellings of columns.
LEGACY_ALIASES = {"sdb_desc_condic": "sdb_des_condic", "acm_desc_condic": "acm_des_condic"}


@dataclass(frozen=True)
class ColumnRule:
    dtype: str = "string"
    required: bool = True
    nullable: bool = True


@dataclass(frozen=True)
class TableSchema:
    columns: Mapping[str, ColumnRule] = field(default_factory=dict)
    require_geometry: bool = True
    allow_extra_columns: bool = True

    @classmethod
    def from_config(cls, config: Mapping, fields: Iterable[str] = ()) -> "TableSchema | None":
        """Schema of a profile; without one, every domain column is a string."""
        if not config:
            columns = {name: ColumnRule() for name in fields if str(name).strip()}
            return cls(columns) if columns else None
        columns = {
            name: ColumnRule(rule) if isinstance(rule, str) else ColumnRule(**rule)
            for name, rule in config.get("columns", {}).items()
        }
        return cls(
            columns, config.get("require_geometry", True), config.get("allow_extra_columns", True)
        )


def infer_schema(domain_values: DataFrame) -> DataFrame:
    """String schema rows, one per column that has a domain."""
    return domain_values.select("profile", "column").distinct().select(
        "profile", "column", F.lit("string").alias("dtype"),
        F.lit(True).alias("required"), F.lit(True).alias("nullable"),
    )


def normalize_columns(df: DataFrame) -> DataFrame:
    kept = {GEOMETRY, SRID}
    return df.toDF(*[c if c in kept else source_name(c) for c in df.columns])


def columns_are_normalized(df: DataFrame) -> bool:
    return all(c in (GEOMETRY, SRID) or c.lower().startswith("sdb_") for c in df.columns)


def apply_legacy_aliases(df: DataFrame, expected: set[str] | None = None) -> DataFrame:
    return df.withColumnsRenamed(
        {
            old: new
            for old, new in LEGACY_ALIASES.items()
            if old in df.columns and new not in df.columns and (expected is None or new in expected)
        }
    )


def missing_columns(df: DataFrame, schema: TableSchema) -> list[str]:
    return sorted(c for c, rule in schema.columns.items() if rule.required and c not in df.columns)


def unexpected_columns(df: DataFrame, schema: TableSchema) -> list[str]:
    if schema.allow_extra_columns:
        return []
    return sorted(c for c in set(df.columns) - set(schema.columns) - {GEOMETRY, SRID} if not c.startswith("__"))


def structure_diff(present: DataFrame, expected: DataFrame) -> DataFrame:
    """Case-insensitive column differences of many layers against many schemas.

    ``present(layer, profile, column)`` and ``expected(profile, column, required,
    allow_extra)`` give rows (layer, column, difference).
    """

    def comparable(df):
        key = attribute_key(F.col("column"))
        keep = (key != "") & (key != GEOMETRY) & (key != FID_COLUMN) & ~key.startswith("acm_")
        return df.withColumn("column", key).filter(keep)

    have, want = comparable(present), comparable(expected)
    layers = have.select("layer", "profile").distinct()
    missing = (
        layers.join(want.filter("required"), "profile")
        .join(have, ["layer", "profile", "column"], "left_anti")
        .select("layer", "column", F.lit("missing").alias("difference"))
    )
    closed = want.groupBy("profile").agg(F.bool_or("allow_extra").alias("allow_extra")).filter("NOT allow_extra")
    extra = (
        have.join(closed, "profile", "left_semi")
        .join(want, ["profile", "column"], "left_anti")
        .select("layer", "column", F.lit("extra").alias("difference"))
    )
    return missing.unionByName(extra).distinct()


def matches_dtype(dtype: T.DataType, token: str) -> bool:
    token = token.strip().lower()
    if token in STRING_TYPES:
        return isinstance(dtype, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType))
    if token in NUMBER_TYPES:
        return isinstance(dtype, (T.NumericType, T.BooleanType))
    if token in INTEGER_TYPES:
        return isinstance(dtype, T.IntegralType)
    if token in DATE_TYPES:
        return isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))
    if token in BOOLEAN_TYPES:
        return isinstance(dtype, T.BooleanType)
    return True


def boolean_text(value: Column) -> Column:
    text = F.lower(strip(value.cast("string")))
    return F.when(text.isin(*TRUE_TEXTS), True).when(text.isin(*FALSE_TEXTS), False)


def _as_date(value: Column) -> Column:
    return F.coalesce(
        value.try_cast("timestamp"),
        *[
            F.try_to_timestamp(value.cast("string"), F.lit(layout))
            for layout in ("MM/dd/yyyy", "dd/MM/yyyy")
        ],
    )


def coerced(value: Column, dtype: T.DataType, token: str) -> Column:
    token = token.strip().lower()
    if token in STRING_TYPES:
        return value.cast("string")
    if token in NUMBER_TYPES or token in INTEGER_TYPES:
        number = strip(value) if isinstance(dtype, T.StringType) else value
        return number.try_cast("double")
    if token in DATE_TYPES:
        return _as_date(value)
    if token in BOOLEAN_TYPES:
        if isinstance(dtype, T.NumericType):
            return F.when(value == 1, True).when(value == 0, False)
        return boolean_text(value)
    return value


@dataclass(frozen=True)
class Conformed:
    data: DataFrame
    errors: list[tuple[str, str]]  # (column, message)


def conform(df: DataFrame, schema: TableSchema, keep_text_dates: bool = True) -> Conformed:
    """Coerce declared columns in place and collect the errors.

    All decisions that depend on the data come from one aggregate over the
    columns that need one. A text column declared as a date is left for the date
    functions, which write the derived column, unless ``keep_text_dates`` is off.
    """
    errors = []
    if schema.require_geometry and GEOMETRY not in df.columns:
        errors.append((GEOMETRY, f"Coluna obrigatoria ausente: {GEOMETRY}."))
    missing = missing_columns(df, schema)
    if missing:
        errors.append((", ".join(missing), f"Colunas obrigatorias ausentes: {', '.join(missing)}."))
    extra = unexpected_columns(df, schema)
    if extra:
        errors.append((", ".join(extra), f"Colunas nao previstas no schema: {', '.join(extra)}."))

    types = {f.name: f.dataType for f in df.schema.fields}
    facts, candidates = [], {}
    for i, (name, rule) in enumerate(schema.columns.items()):
        if name not in types:
            continue
        source, token = F.col(f"`{name}`"), rule.dtype.strip().lower()
        if not rule.nullable:
            facts.append(F.count_if(source.isNull()).alias(f"null_{i}"))
        text_date = token in DATE_TYPES and isinstance(types[name], T.StringType) and keep_text_dates
        if matches_dtype(types[name], token) or text_date:
            continue
        candidate = coerced(source, types[name], token)
        candidates[i] = candidate
        facts.append(F.count_if(source.isNotNull() & candidate.isNull()).alias(f"lost_{i}"))
        if token in INTEGER_TYPES:
            facts.append(F.coalesce(F.bool_and(candidate % 1 == 0), F.lit(True)).alias(f"whole_{i}"))
    found = df.agg(*facts).first().asDict() if facts else {}

    replaced = {}
    for i, (name, rule) in enumerate(schema.columns.items()):
        if name not in types:
            continue
        token = rule.dtype.strip().lower()
        nulls, final = found.get(f"null_{i}", 0), types[name]
        if i in candidates:
            lost = found[f"lost_{i}"]
            fits = (token not in INTEGER_TYPES or found[f"whole_{i}"]) and (
                token not in BOOLEAN_TYPES or not (lost or nulls)
            )
            if fits and lost and not rule.nullable:
                errors.append(
                    (name, f"Coluna {name} nao pode ser convertida para {rule.dtype} "
                           f"sem gerar {lost} valor(es) nulo(s).")
                )
                continue
            if fits:
                replaced[name] = (
                    candidates[i].cast("bigint") if token in INTEGER_TYPES else candidates[i]
                )
                final, nulls = None, nulls + lost
        if not rule.nullable and nulls:
            errors.append((name, f"Coluna {name} nao permite valores nulos."))
        text_date = token in DATE_TYPES and isinstance(types[name], T.StringType) and keep_text_dates
        if final is not None and not matches_dtype(final, token) and not text_date:
            errors.append(
                (name, f"Coluna {name} tem tipo invalido: esperado {rule.dtype}, "
                       f"encontrado {final.simpleString()}.")
            )
    return Conformed(df.withColumns(replaced) if replaced else df, errors)


def error_rows(spark, errors: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(errors, "column string, message string")


def date_only_columns(df: DataFrame) -> DataFrame:
    """Rows (column, date_only) for every timestamp column; all-null counts as date-only."""
    stamps = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
    ]
    tests = [
        F.coalesce(F.bool_and(F.col(f"`{c}`") == F.date_trunc("day", F.col(f"`{c}`"))), F.lit(True)).alias(c)
        for c in stamps
    ]
    return df.agg(*tests).unpivot([], stamps, "column", "date_only")


def store_dates(df: DataFrame) -> DataFrame:
    """Timestamp columns that only hold midnights become DATE."""
    stamps = [f for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    if not stamps:
        return df
    only = [r["column"] for r in date_only_columns(df).filter("date_only").collect()]
    return df.withColumns({c: F.col(f"`{c}`").cast("date") for c in only}) if only else df


def change_tests(pairs: Mapping[str, str]) -> dict[str, Column]:
    """Aggregates that tell whether a derived column differs from its source anywhere."""
    return {
        derived: F.coalesce(
            F.bool_or(~F.col(f"`{derived}`").eqNullSafe(F.col(f"`{source}`"))), F.lit(False)
        )
        for derived, source in pairs.items()
    }


def changed_columns(df: DataFrame, pairs: Mapping[str, str]) -> set[str]:
    """Which derived columns differ from their source anywhere, in one aggregate."""
    if not pairs:
        return set()
    row = df.agg(*[test.alias(name) for name, test in change_tests(pairs).items()]).first()
    return {derived for derived in pairs if row[derived]}


def keep_changed(df: DataFrame, pairs: Mapping[str, str], always_emit: bool = False) -> DataFrame:
    """Drop derived columns equal to their source everywhere.

    ``always_emit`` skips the aggregate, as a stream has to.
    """
    if always_emit or not pairs:
        return df
    return df.drop(*(set(pairs) - changed_columns(df, pairs)))


def backfill_derived(df: DataFrame) -> DataFrame:
    """Null derived values take the source value, never across types."""
    types = dict(df.dtypes)
    fills = {}
    for name in df.columns:
        source = "sdb_" + name.removeprefix("acm_")
        if name.startswith("acm_") and source in types and types[source] == types[name]:
            fills[name] = F.coalesce(F.col(f"`{name}`"), F.col(f"`{source}`"))
    return df.withColumns(fills) if fills else df


__all__ = [
    "ColumnRule", "Conformed", "TableSchema", "apply_legacy_aliases", "backfill_derived",
    "boolean_text", "change_tests", "changed_columns", "coerced", "columns_are_normalized", "conform",
    "date_only_columns", "derived_name", "error_rows", "infer_schema", "keep_changed",
    "matches_dtype", "missing_columns", "normalize_columns", "source_name", "store_dates", "structure_diff",
    "unexpected_columns",
]

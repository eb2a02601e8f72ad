"""Registries of column functions and table post-processing steps."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talweg.functions.dates import date_text, parse_date
from talweg.functions.naming import derived_name
from talweg.functions.text import STATE_KEY_FAMILIES, condition_label, rule_key
from talweg.operators import relations as rel
from talweg.operators.domains import classify, domain_lookup
from talweg.operators.scale import stage
from talweg.operators.spatial import STATE_BOUNDS, clip_to_states
from talweg.operators.spatial_join import assign_regions
from talweg.sources.rules import RuleTables


BROADCAST_CHARACTERS = 32 << 20


@dataclass
class RuleContext:
    """Rules of one profile, and what the functions of a run leave behind."""

    rules: RuleTables
    config: dict
    theme: str = ""
    places: tuple[str | None, ...] = ()  # texts that may name the state, in order
    regions: DataFrame | None = None
    row_key: str = "acm_id"
    derived: dict[str, str] = field(default_factory=dict)     # derived column -> source column
    classified: dict[str, str] = field(default_factory=dict)  # column -> struct column
    related: list[tuple[str, str, str]] = field(default_factory=list)  # relation, source, status column
    log: list[tuple[str, str, str]] = field(default_factory=list)      # column, function, outcome

    @property
    def domains(self) -> list[str]:
        return self.config.get("domains") or []

    @property
    def relations(self) -> list[str]:
        return self.config.get("relations") or []

    @property
    def small(self) -> bool:
        """Rule components are small enough to broadcast any lookup built from them."""
        return all(
            self.config["sizes"].get(part, 0) <= BROADCAST_CHARACTERS for part in ("domains", "relations")
        )

    def lookup(self, column: str) -> DataFrame:
        here = F.col("column") == column
        return domain_lookup(
            self.rules.domain_values.filter(here), self.rules.domain_aliases.filter(here), []
        )


ColumnFunction = Callable[[DataFrame, str, RuleContext], DataFrame]


def validate_domain(df: DataFrame, column: str, ctx: RuleContext) -> DataFrame:
    """Classify a column, force its relations, write the derived column."""
    if column not in ctx.domains:
        return df
    out, target = f"__domain_{column}", derived_name(column)
    df = classify(df, column, ctx.lookup(column), out, ctx.small).withColumn(target, F.col(f"`{out}`.value"))
    ctx.classified[column] = out
    ctx.derived[target] = column
    sources = [c for c in df.columns if not c.startswith("__")]
    for name in ctx.relations:
        relation = rel.resolve_relation(name, sources)
        if relation is None or relation.target != column:
            continue
        status, effective = f"__relation_{name}", f"__source_{name}"
        known = derived_name(relation.source)
        if known in df.columns:
            df = df.withColumn(effective, F.col(f"`{known}`").cast("string"))
        elif relation.source in ctx.domains:
            df = classify(df, relation.source, ctx.lookup(relation.source), "_s", ctx.small).withColumn(
                effective, F.col("_s.value")
            ).drop("_s")
        else:
            df = df.withColumn(effective, F.col(f"`{relation.source}`").cast("string"))
        pairs = ctx.rules.relation_pairs.filter(F.col("relation") == name)
        df = rel.enforce_relation(df, relation, pairs, effective, target, status, ctx.small)
        ctx.related.append((name, effective, status))
    return df


def validate_dates(df: DataFrame, column: str, ctx: RuleContext) -> DataFrame:
    """Text dates get a derived date column; typed dates stay as they are."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return df
    source = F.col(f"`{column}`").cast("string")
    return df.withColumn("_text", date_text(source)).withColumn(derived_name(column), parse_date(source, F.col("_text"))).drop("_text")


def label_condition(df: DataFrame, column: str, ctx: RuleContext) -> DataFrame:
    source = F.col(f"`{column}`")
    return df.withColumn("_key", rule_key(source)).withColumn(derived_name(column), condition_label(source, F.col("_key"))).drop("_key")


# Function names used by rule profiles.
COLUMN_FUNCTIONS: dict[str, ColumnFunction] = {
    "validate_shapefile_attribute": validate_domain,
    "validate_date_fields": validate_dates,
    "car_area_preservacao_permanente_transform_des_condic": label_condition,
    "car_app_transform_des_condic": label_condition,
    "car_reserva_legal_transform_des_condic": label_condition,
    "reserva_legal_car_transform_des_condic": label_condition,
    "car_servidao_administrativa_transform_des_condic": label_condition,
    "sa_car_transform_des_condic": label_condition,
    "car_uso_restrito_transform_des_condic": label_condition,
    "ur_car_transform_des_condic": label_condition,
}


def register_column_function(name: str, function: ColumnFunction) -> None:
    """Allow a profile to name one more function (dotted names included)."""
    COLUMN_FUNCTIONS[name] = function


def apply_column_functions(df: DataFrame, mapping: dict[str, list[str]], ctx: RuleContext) -> DataFrame:
    """Run each column's functions in order; absent columns and failures are logged, not fatal."""
    for column, names in mapping.items():
        if column not in df.columns:
            ctx.log.append((column, "", "missing_column"))
            continue
        for name in names:
            function = COLUMN_FUNCTIONS.get(name)
            if function is None:
                ctx.log.append((column, name, "not_registered"))
                continue
            try:
                df = function(df, column, ctx)
                ctx.log.append((column, name, "applied"))
            except Exception as error:  # a broken rule must not stop the other columns
                ctx.log.append((column, name, f"failed: {type(error).__name__}"))
    return df


def check_postprocess(names: list[str], ctx: RuleContext) -> None:
    """Raise before any step runs where one lacks what it needs."""
    if "enrich_with_municipality_intersection" in names and ctx.regions is None:
        raise ValueError("the profile joins reference regions but none were given")


def enrich_regions(df: DataFrame, ctx: RuleContext) -> DataFrame:
    check_postprocess(["enrich_with_municipality_intersection"], ctx)
    return assign_regions(df, ctx.regions, ctx.row_key)


def named_state(places: tuple[str | None, ...]) -> str | None:
    """State code in the first of theme folder, profile and paths that names a known one; settings, so no column is needed."""
    for place in places:
        found = re.search(rf"(?:{STATE_KEY_FAMILIES})_([a-z]{{2}})(?:_|\.|$)", (place or "").lower())
        if found and found[1] in STATE_BOUNDS:
            return found[1]
    return None


def clip_to_theme_state(df: DataFrame, ctx: RuleContext) -> DataFrame:
    """Clip to the envelope of the state that the run names; without one nothing is looked at."""
    state = named_state(ctx.places or (ctx.theme,))
    return clip_to_states(df, state, out="__clip") if state else df


POSTPROCESS_STEPS: dict[str, Callable[[DataFrame, RuleContext], DataFrame]] = {
    "enrich_with_municipality_intersection": enrich_regions,
    "enforce_car_state_bounds": clip_to_theme_state,
}


#: Steps after which no row lacks a metric that it had before.
METRICS_KEPT = frozenset(POSTPROCESS_STEPS)


def apply_postprocess(df: DataFrame, names: list[str], ctx: RuleContext) -> DataFrame:
    """Run the steps in order; what one has changed is written for the next, which may read it twice.

    So a step runs once, and no task holds the Python workers of two steps.
    """
    written = df
    for name in names:
        step = POSTPROCESS_STEPS.get(name)
        if step is None:
            ctx.log.append(("", name, "not_registered"))
            continue
        written = df if df is written else stage(df)
        df = step(written, ctx)
        ctx.log.append(("", name, "applied"))
    return df

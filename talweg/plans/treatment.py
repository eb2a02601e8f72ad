"""The whole treatment of a feature table as one lazy plan."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talweg.functions.naming import AREA, FID_COLUMN, ID_COLUMN, PERIMETER, REPAIR_FLAG
from talweg.functions.text import collapse
from talweg.operators import schema as sc
from talweg.operators import spatial as sp
from talweg.operators.domains import domain_lookup, invalid_value_counts, status_counts
from talweg.operators.identifiers import READ_ORDER, add_sequential_id
from talweg.operators.mining import autofix_domain, mine_relations
from talweg.operators.quality import QualityConfig
from talweg.operators.relations import relation_summary, resolve_relation
from talweg.operators.scale import stage
from talweg.plans.registry import METRICS_KEPT, RuleContext, apply_column_functions, apply_postprocess, check_postprocess
from talweg.sources.rules import RuleTables, profile_config

RELOCATE = "relocate_outside_brazil_bounds_to_centroid"  # fixed value: profile switch


class SchemaMismatch(ValueError):
    def __init__(self, errors):
        super().__init__("; ".join(message for _, message in errors))
        self.errors = errors


@dataclass(frozen=True)
class Profile:
    """Plan-time settings of one rule profile (configuration, not data)."""

    name: str
    theme: str
    schema: sc.TableSchema | None
    functions: dict[str, list[str]]
    postprocess: list[str]
    relocate: bool
    quality: QualityConfig
    config: dict

    @classmethod
    def of(cls, rules: RuleTables, name: str) -> "Profile":
        config = profile_config(rules, name)
        treatment = config.get("treatment", {})
        return cls(
            name,
            config.get("profile", {}).get("theme_folder") or name.rsplit("/", 1)[-1],
            sc.TableSchema.from_config(config.get("input_schema"), config.get("domains") or ()),
            {c: list(f) for c, f in treatment.get("auto_functions", {}).items()},
            list(treatment.get("postprocess_functions", [])),
            treatment.get("output_adjustments", {}).get(RELOCATE) is True,
            QualityConfig.from_profile(treatment.get("quality_outputs")),
            config,
        )


@dataclass(frozen=True)
class TreatmentResult:
    context: RuleContext
    profile: Profile
    audited: DataFrame              # the same rows with classification columns
    stats: dict                     # counted while the rows were written
    finish: Callable[[], DataFrame]  # post-processing of the audited rows
    region: sp.Region = sp.Region()

    @cached_property
    def data(self) -> DataFrame:
        """Treated table with internal columns; post-processed when first asked for, as summaries and deltas don't need it."""
        return self.finish()

    @property
    def silver(self) -> DataFrame:
        """Output rows: internal columns dropped, features off the region relocated if configured."""
        from talweg.sources.sinks import drop_internal

        kept = drop_internal(self.data)
        return sp.relocate_outside(kept, self.region) if self.profile.relocate else kept

    def domain_summary(self) -> DataFrame | None:
        classified = self.context.classified
        return status_counts(self.audited, classified) if classified else None

    def relation_summaries(self) -> DataFrame | None:
        found = None
        for name, source, status in self.context.related:
            part = relation_summary(self.audited, name, source, status)
            found = part if found is None else found.unionByName(part)
        return found

    def rule_deltas(self) -> tuple[DataFrame | None, DataFrame | None]:
        """(domain rows, relation rows) learned for the next run; the layer is read once for each."""
        ctx = self.context
        columns = [c for c in sorted(ctx.domains) if c in self.audited.columns]
        if not columns:
            return None, None
        lookups = domain_lookup(ctx.rules.domain_values, ctx.rules.domain_aliases, ["column"])
        invalid = invalid_value_counts(self.audited, lookups, columns)
        domains = autofix_domain(invalid, ctx.rules.domain_values.select("column", "canonical"))
        present = [c for c in self.audited.columns if not c.startswith("__")]
        found = [r for r in (resolve_relation(name, present) for name in ctx.relations) if r]
        if not found:
            return domains, None
        relations = [(r.name, r.source, r.target) for r in found]
        return domains, mine_relations(self.audited, relations, lookups, list(ctx.domains), ctx.rules.relation_pairs)


def clean_whitespace(df: DataFrame) -> DataFrame:
    """Trim and collapse white space in every text column."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: collapse(F.col(f"`{c}`")) for c in texts}) if texts else df


DIMS, MEASURABLE, REPROJECTED = "__dims", "__measurable", "__reprojected"


def mandatory_treatments(df: DataFrame, cleaned: bool = False) -> DataFrame:
    """White space, reprojection, metrics and 2-D; one look at each geometry.

    Metrics need only x and y, so they are taken together with the dimension before
    Z and M are dropped. Hidden columns keep what the run statistics need. Texts that were ``cleaned`` already are left.
    """
    facts = F.col("_facts")
    texts = df if cleaned else clean_whitespace(df)
    looked = sp.geographic_2d(texts.withColumn(REPROJECTED, sp.needs_reprojection(df)), "_facts")
    return looked.withColumns(
        {
            **sp.metric_values(facts),
            DIMS: F.when(~facts["is_empty"], facts["dims"]),
            MEASURABLE: F.coalesce(sp.measurable(facts), F.lit(False)),
        }
    ).drop("_facts")


def prepare_input(df: DataFrame, profile: Profile) -> DataFrame:
    """Normalised names, legacy aliases, clean text, coerced types; raises on schema errors.

    The clean rows are written with their place: schema tests and the range partitioning then read stored columns,
    and what the input computes itself is computed once.
    """
    expected = set(profile.schema.columns) if profile.schema else None
    df = clean_whitespace(sc.apply_legacy_aliases(sc.normalize_columns(df), expected))
    df = stage(df.withColumn(READ_ORDER, F.monotonically_increasing_id()))
    if profile.schema is None:
        return df
    conformed = sc.conform(df, profile.schema)
    if conformed.errors:
        raise SchemaMismatch(conformed.errors)
    return conformed.data


def treat(
    df: DataFrame, rules: RuleTables, profile_name: str, order_by: list[str | Column],
    *, regions: DataFrame | None = None, id_start: int = 1, region: sp.Region = sp.Region(),
    input_path: str | None = None, source_path: str | None = None,
) -> TreatmentResult:
    """Treat a feature table by a rule profile.

    ``order_by`` names the input columns (before renaming) whose order the ids
    follow. Clean rows are written and put in order first; everything else row-local then runs once on its way
    to the staged table which also fixes the ids. What depends on all rows (which derived columns
    changed, whether the layer is measurable, the statistics of the run) is observed during that write, so the
    table is not read again for it. Post-processing joins end in a second staged table, so that
    output and reports read rows instead of joining again; it is written when ``data`` or ``silver`` is first asked for.
    ``region`` is where relocated features go; the paths may name the state, like profile and theme.
    """
    profile = Profile.of(rules, profile_name)
    places = (profile.theme, profile_name, input_path, source_path)
    ctx = RuleContext(rules.of(profile_name), profile.config, theme=profile.theme, places=places, regions=regions)
    ordered = [sc.source_name(c) if isinstance(c, str) else c for c in order_by]
    seen = Observation()

    def row_local(rows: DataFrame) -> DataFrame:
        done = sp.repair_geometries(apply_column_functions(mandatory_treatments(rows, cleaned=True), profile.functions, ctx))
        tests = {
            "rows": F.count(F.lit(1)),
            "forced_to_2d": F.count_if(F.col(DIMS) > 2),
            "reprojected_to_wgs84": F.count_if(REPROJECTED),
            "measurable": F.coalesce(F.bool_or(MEASURABLE), F.lit(False)),
            "unmeasured": F.count_if(sp.lacks_metrics(done)),
            **sc.change_tests(ctx.derived),
        }
        return done.observe(seen, *[test.alias(name) for name, test in tests.items()])

    treated = add_sequential_id(prepare_input(df, profile), ordered, start=id_start, work=row_local)

    found = seen.get
    stats = {name: found[name] for name in ("rows", "forced_to_2d", "reprojected_to_wgs84", "measurable")}
    stats["skipped_point_measurements"] = 0 if stats["measurable"] else stats["rows"]
    unchanged = [column for column in ctx.derived if not found[column]]
    absent = [] if stats["measurable"] else [AREA, PERIMETER]

    hidden = [c for c in treated.columns if c.startswith("__") and c != REPAIR_FLAG]
    final = treated.drop(*hidden, *unchanged, *absent)
    final = sc.backfill_derived(final).withColumn(FID_COLUMN, F.col(ID_COLUMN))
    check_postprocess(profile.postprocess, ctx)

    def finish() -> DataFrame:
        done = apply_postprocess(final, profile.postprocess, ctx).drop("__clip")
        if found["unmeasured"] or not METRICS_KEPT.issuperset(profile.postprocess):
            done = sp.fill_missing_metrics(done)
        return stage(done) if profile.postprocess else done

    return TreatmentResult(ctx, profile, treated, stats, finish, region)

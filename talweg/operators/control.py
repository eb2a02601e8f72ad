"""Control table: eligibility, first-failing-check triage, profile resolution, versions."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talweg.functions.keys import location_key, parse_status
from talweg.functions.text import profile_key, stringify, theme_key
from talweg.operators.identifiers import version_order

# Issue codes.
MISSING_SOURCE_PATH, ZIP_SOURCE_PATH = "missing_source_path", "zip_source_path"
DATASET_ERROR = "input_dataset_resolution_error"
PROFILE_ERROR, PROFILE_MISSING = "rule_profile_resolution_error", "missing_rule_profile"
PROFILE_INCOMPLETE, PROFILE_INCONSISTENT = "rule_profile_incomplete", "rule_profile_project_inconsistent"
VERSIONING_INCOMPLETE = "versioning_metadata_incomplete"
STATUS_NOT_ALLOWED, INVALID_STATUS = "status_not_allowed", "invalid_status_flags"
THEME_NOT_REQUESTED = "theme_not_requested"
FORCED, OVERRIDDEN = "force_enabled", "source_path_overridden"
VERSIONING_FIELDS = ("access_constraints", "category_acronym", "citation", "date")
# Projects by theme prefix, in matching order, and legacy project names.
PROJECT_PREFIXES = {
    "car_area_preservacao_permanente": "app_car_",
    "estado": "estado",
    "localidades": "loc",
    "setor_censitario": "setor_censitario",
    "car_reserva_legal": "rl_car_",
    "car_servidao_administrativa": "sa_car_",
    "car_uso_restrito": "ur_car_",
    "autorizacao_para_supressao_vegetal": "auth_supn",
    "autos_infracao": "enov",
    "degradacao_amazonia": "dfaab",
}
LEGACY_PROJECTS = {
    "app_car": "car_area_preservacao_permanente",
    "reserva_legal_car": "car_reserva_legal",
    "sa_car": "car_servidao_administrativa",
    "ur_car": "car_uso_restrito",
    "degradacao": "degradacao_amazonia",
}
DEFAULT_PROJECT = "default"


def theme_selection(themes) -> list[str]:
    """Requested themes as raw texts, from a list, a mapping, a JSON text or one name."""
    if themes is None:
        return []
    if isinstance(themes, Mapping):
        themes = themes["value"] if "value" in themes else list(themes.values())
    if isinstance(themes, str):
        try:
            themes = json.loads(themes)
        except json.JSONDecodeError:
            pass
        themes = [themes] if isinstance(themes, str) else themes
    return [str(t) for t in themes if str(t).strip()]


@dataclass(frozen=True)
class RunRequest:
    themes: object = None
    required_flag: str = "treatment"
    source_path_overrides: Mapping[str, str] = field(default_factory=dict)
    force: bool = False
    scheduled: bool = False

    def theme_requested(self, theme: Column) -> Column:
        names = theme_selection(self.themes)
        if not names:
            return F.lit(True)
        keys = F.array(*[theme_key(F.lit(n)) for n in names])
        return F.array_contains(keys, theme_key(theme))

    def override(self, theme: Column) -> Column:
        paths = {k: str(v).strip() for k, v in self.source_path_overrides.items() if str(v).strip()}
        if not paths:
            return F.lit(None).cast("string")
        key = theme_key(theme)
        return F.coalesce(
            *[F.when((key == theme_key(F.lit(k))) & (key != ""), F.lit(v)) for k, v in paths.items()]
        )


def filter_themes(df: DataFrame, themes, column: str = "theme_folder") -> DataFrame:
    return df.filter(RunRequest(themes).theme_requested(F.col(column)))


def with_eligibility(control: DataFrame, request: RunRequest = RunRequest()) -> DataFrame:
    """Status plan, effective source path, and request and blocking reasons of every control row."""
    theme = F.col("theme_folder")
    status = F.col("status_plan")
    override = request.override(theme)
    valid = F.size(status["invalid"]) == 0
    planned = F.array_contains(status["flags"], F.lit("schedule")) & status["scheduled_for"].isNotNull()
    wanted = planned if request.scheduled else F.array_contains(status["flags"], F.lit(request.required_flag))
    allowed = F.lit(request.force) | F.col("source_overridden") | (valid & wanted)
    path = F.col("source_path")
    return (
        control.withColumn("status_plan", parse_status(F.col("status")))
        .withColumn("source_overridden", override.isNotNull())
        .withColumn("source_path", F.coalesce(override, stringify(F.col("path_shapefile_temp"))))
        .withColumn("status_allowed", F.coalesce(allowed, F.lit(False)))
        .withColumn("theme_requested", request.theme_requested(theme))
        .withColumn(
            "request_reasons",
            F.array_compact(F.array(
                F.when(F.lit(request.force), F.lit(FORCED)),
                F.when(F.col("source_overridden"), F.lit(OVERRIDDEN)),
            )),
        )
        .withColumn(
            "blocking_reasons",
            F.array_compact(F.array(
                F.when(~valid, F.lit(INVALID_STATUS)).when(~F.col("status_allowed"), F.lit(STATUS_NOT_ALLOWED)),
                F.when(~F.col("theme_requested"), F.lit(THEME_NOT_REQUESTED)),
                F.when(path == "", F.lit(MISSING_SOURCE_PATH)),
                F.when(F.lower(path).endswith(".zip"), F.lit(ZIP_SOURCE_PATH)),
            )),
        )
    )


def project_of(theme: Column) -> Column:
    """Project of a theme: legacy name, exact name, then the first matching prefix."""
    key = F.lower(stringify(theme))
    legacy = F.coalesce(*[F.when(key == old, F.lit(new)) for old, new in LEGACY_PROJECTS.items()], key)
    exact = F.when(legacy.isin(*PROJECT_PREFIXES), legacy)
    prefix = F.coalesce(
        *[F.when(legacy.startswith(p), F.lit(name)) for name, p in PROJECT_PREFIXES.items()]
    )
    return F.coalesce(exact, prefix, F.lit(DEFAULT_PROJECT))


def resolve_profiles(themes: DataFrame, profiles: DataFrame, theme: str = "theme_folder") -> DataFrame:
    """Ranked join of distinct themes to profiles.

    ``profiles(profile, project, missing ARRAY<STRING>)``. Rows (theme, project,
    expected, profile, missing, error, consistent): an exact name wins, then the
    expected ``project/theme``, then the preferred folder, then a sole stem match;
    several stem matches are an error.
    """
    key = profile_key(F.col(theme))
    wanted = themes.select(F.col(theme), key.alias("key")).distinct().withColumn(
        "project", project_of(F.col("key"))
    ).withColumn(
        "expected",
        F.when(F.col("project") == DEFAULT_PROJECT, F.col("key")).otherwise(F.concat_ws("/", "project", "key")),
    )
    known = profiles.select(
        "profile", F.col("project").alias("declared"), "missing", profile_key(F.col("profile")).alias("name")
    ).withColumn("stem", F.element_at(F.split("name", "/"), -1))
    by_name = known.select(F.col("name").alias("key"), F.lit(0).alias("rank"), "profile", "declared", "missing")
    by_stem = known.filter("name != stem").select(
        F.col("stem").alias("key"), F.lit(1).alias("rank"), "profile", "declared", "missing"
    )
    side = by_name.unionByName(by_stem)
    folder = F.regexp_replace("key", "_?[^_]*$", "")
    rank = (
        F.when(F.col("rank") == 0, 0)
        .when(F.col("profile") == F.col("expected"), 1)
        .when((folder != "") & F.col("profile").startswith(F.concat(folder, F.lit("/"))), 2)
        .otherwise(3)
    )
    best = (
        wanted.filter("key != ''").join(side, "key").withColumn("rank", rank)
        .groupBy(theme, "key")
        .agg(F.min(F.struct("rank", "profile", "declared", "missing")).alias("b"),
             F.count(F.lit(1)).alias("matches"))
    )
    canonical = F.coalesce(
        *[F.when(F.lower("declared") == old, F.lit(new)) for old, new in LEGACY_PROJECTS.items()],
        F.lower("declared"),
    )
    ambiguous = (F.col("b.rank") == 3) & (F.col("matches") > 1)
    return (
        wanted.join(best, [theme, "key"], "left")
        .withColumn("declared", F.trim(F.coalesce("b.declared", F.lit(""))))
        .select(
            theme, "project", "expected",
            F.when(~ambiguous, F.col("b.profile")).alias("profile"),
            F.when(~ambiguous, F.col("b.missing")).alias("missing"),
            F.when(F.col("key") == "", "theme_folder vazio.").when(ambiguous, "ambiguous").alias("error"),
            ((F.col("declared") == "") | (canonical == F.col("project"))).alias("consistent"),
        )
    )


def triage(
    control: DataFrame, profiles: DataFrame, request: RunRequest = RunRequest(),
    datasets: DataFrame | None = None,
) -> DataFrame:
    """Candidate rows with the code of their first failing check (null means eligible).

    ``datasets(source_path)`` lists paths that hold a readable dataset; without it
    that check passes.
    """
    rows = with_eligibility(control, request).filter("status_allowed AND theme_requested")
    # A blank theme still joins, so it is reported instead of lost.
    rows = rows.withColumn("theme_folder", F.coalesce("theme_folder", F.lit("")))
    resolved = resolve_profiles(rows, profiles).select(
        "theme_folder", "profile", "missing", F.col("error").alias("profile_error"), "consistent"
    )
    rows = rows.join(resolved, "theme_folder", "left")
    if datasets is None:
        readable = F.lit(True)
    else:
        side = datasets.select("source_path").distinct().withColumn("_readable", F.lit(True))
        rows = rows.join(side, "source_path", "left")
        readable = F.coalesce("_readable", F.lit(False))
    incomplete = F.lit(False)
    for name in VERSIONING_FIELDS:
        incomplete = incomplete | (stringify(F.col(name)) == "")
    code = F.coalesce(
        F.when(F.col("source_path") == "", F.lit(MISSING_SOURCE_PATH)),
        F.when(F.lower("source_path").endswith(".zip"), F.lit(ZIP_SOURCE_PATH)),
        F.when(~readable, F.lit(DATASET_ERROR)),
        F.when(F.col("profile_error") == "ambiguous", F.lit(PROFILE_ERROR)),
        F.when(F.col("profile").isNull(), F.lit(PROFILE_MISSING)),
        F.when(F.size("missing") > 0, F.lit(PROFILE_INCOMPLETE)),
        F.when(~F.col("consistent"), F.lit(PROFILE_INCONSISTENT)),
        F.when(incomplete, F.lit(VERSIONING_INCOMPLETE)),
    )
    return rows.withColumn("code", code).drop("_readable", "profile_error", "consistent", "missing")


def eligible(triaged: DataFrame) -> DataFrame:
    return triaged.filter("code IS NULL").drop("code")


def issues(triaged: DataFrame) -> DataFrame:
    return triaged.filter("code IS NOT NULL").select(
        "ID", "theme_folder", "status", "source_path", "code"
    )


def run_summary(control: DataFrame, triaged: DataFrame, request: RunRequest = RunRequest()) -> DataFrame:
    """One row of counts: total, candidates, eligible, issues."""
    totals = with_eligibility(control, request).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if("status_allowed").alias("ready_candidates"),
    )
    outcome = triaged.agg(
        F.count_if(F.col("code").isNull()).alias("eligible_records"),
        F.count_if(F.col("code").isNotNull()).alias("issues"),
    )
    one = F.lit(1).alias("_one")
    return totals.select("*", one).join(outcome.select("*", one), "_one").drop("_one")


def flagged_records(
    control: DataFrame, flag: str, versions: DataFrame | None = None, themes=None,
    base: str = "lake", stage: str = "silver_data",
) -> DataFrame:
    """Rows whose status asks for ``flag``, with the first reason they cannot run.

    With ``versions(path, version, has_data)`` a row also needs a version that holds
    data under its location, and gets the latest one.
    """
    rows = (
        control.withColumn("status_plan", parse_status(F.col("status")))
        .filter(F.array_contains("status_plan.flags", F.lit(flag)))
        .withColumn("invalid", F.size("status_plan.invalid") > 0)
        .withColumn("requested", RunRequest(themes).theme_requested(F.col("theme_folder")))
        .filter("invalid OR requested")
    )
    code = F.when(F.col("invalid"), F.lit(INVALID_STATUS))
    if versions is not None:
        where = location_key(
            base, stage, F.col("access_constraints"), F.col("category_acronym"), F.col("theme_folder"),
            F.col("citation"), F.col("date"),
        )
        latest = versions.filter("has_data").groupBy("path").agg(F.max_by("version", version_order()).alias("version"))
        rows = rows.withColumn("_where", where).withColumn("path", F.col("_where.path")).join(
            latest, "path", "left"
        )
        code = code.when(F.col("_where.error").isNotNull(), F.lit(VERSIONING_INCOMPLETE)).when(
            F.col("version").isNull(), F.lit("no_publishable_version")
        )
    return rows.withColumn("code", code).drop("_where", "invalid", "requested", "status_plan")


def scheduled_rows(control: DataFrame, themes=None) -> DataFrame:
    """Rows with a valid status and a schedule time."""
    plan = F.col("plan")
    return (
        filter_themes(control, themes)
        .withColumn("plan", parse_status(F.col("status")))
        .filter((theme_key(F.col("theme_folder")) != "") & (F.size(plan["invalid"]) == 0)
                & plan["scheduled_for"].isNotNull())
        .select("ID", theme_key(F.col("theme_folder")).alias("theme_folder"),
                plan["scheduled_for"].alias("scheduled_for"), "status")
    )


def group_sizes(records: DataFrame, key: str) -> DataFrame:
    """Expected number of records per group."""
    return records.groupBy(key).agg(F.count(F.lit(1)).alias("expected"))


def duplicate_stems(profiles: DataFrame) -> DataFrame:
    """Profile stems that several profiles share, one row per profile."""
    stems = profiles.select(
        "profile", F.element_at(F.split(profile_key(F.col("profile")), "/"), -1).alias("stem")
    )
    shared = stems.groupBy("stem").agg(F.count(F.lit(1)).alias("profiles")).filter("profiles > 1")
    return stems.join(shared, "stem").select("stem", "profile", "profiles")


def incomplete_profiles(profiles: DataFrame, present: DataFrame, required: Iterable[str]) -> DataFrame:
    """Rows (profile, component) for required components that are absent."""
    wanted = profiles.select("profile", F.explode(F.array(*map(F.lit, required))).alias("component"))
    return wanted.join(present, ["profile", "component"], "left_anti")

"""Rule bundles as tables: one JSON folder per profile becomes rows of six tables."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMPONENTS = ("profile.json", "input_schema.json", "domains.json", "relations.json", "treatment.json")
FIELDS_TYPE = "map<string,struct<accepted_values:array<string>,aliases:map<string,string>>>"
PROFILE_TYPE = "struct<profile_name:string,project_name:string,theme_folder:string,description:string>"
COLUMN_TYPE = "struct<dtype:string,required:boolean,nullable:boolean>"
TREATMENT_TYPE = (
    "struct<postprocess_functions:array<string>,auto_functions:map<string,array<string>>,"
    "output_adjustments:map<string,boolean>,quality_outputs:map<string,boolean>>"
)


@dataclass(frozen=True)
class RuleTables:
    profiles: DataFrame          # profile, project, theme, description
    schema_columns: DataFrame    # profile, column, dtype, required, nullable
    schema_options: DataFrame    # profile, require_geometry, allow_extra_columns
    domain_values: DataFrame     # profile, column, canonical, position
    domain_aliases: DataFrame    # profile, column, alias, canonical, position
    relation_pairs: DataFrame    # profile, relation, relation_position, src_value, dst_value
    column_functions: DataFrame  # profile, column, position, function
    options: DataFrame           # profile, kind, name, enabled, position
    bundles: DataFrame           # profile, component, body

    def of(self, profile: str) -> "RuleTables":
        """Rules of one profile."""
        return RuleTables(
            *[getattr(self, name).filter(F.col("profile") == profile) for name in self.__dataclass_fields__]
        )


def read_bundles(spark: SparkSession, path: str, component: str | None = None, suffix: str = ".json") -> DataFrame:
    """Rows (profile, component, body) of every JSON component under a rules folder.

    Files are named after their component; where a writer names them, ``component`` tells what they all are.
    """
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").text(
        path, wholetext=True
    )
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    root = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(root)
    base = F.lit(len([p for p in root.toUri().getPath().split("/") if p]))
    # Scheme and host do not count: they can be given in the path, in the listing, or in both.
    inner = F.regexp_replace(F.col("_metadata.file_path"), r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?", "")
    folders = F.filter(F.split(inner, "/"), lambda p: p != "")
    inside = F.transform(F.slice(folders, base + 1, F.size(folders) - base - 1), F.url_decode)
    return files.select(
        F.array_join(inside, "/").alias("profile"), (F.lit(component) if component else F.element_at(folders, -1)).alias("component"),
        F.regexp_replace("value", "^﻿", "").alias("body"),
    ).filter(~F.exists(F.split("profile", "/"), lambda p: p.startswith("_")))


def rule_tables(bundles: DataFrame) -> RuleTables:
    """Explode bundle rows into the rule tables."""

    def component(name, schema, alias):
        return bundles.filter(F.col("component") == f"{name}.json").select(
            "profile", F.from_json("body", schema).alias(alias)
        )

    profile = component("profile", PROFILE_TYPE, "p")
    profiles = profile.select(
        "profile", F.coalesce("p.project_name", F.lit("")).alias("project"),
        F.col("p.theme_folder").alias("theme"), F.col("p.description").alias("description"),
    )
    # A column rule is an object, or just its type as text.
    raw_schema = component(
        "input_schema",
        "struct<columns:map<string,string>,require_geometry:boolean,allow_extra_columns:boolean>", "s"
    )
    rule = F.from_json("rule", COLUMN_TYPE)
    schema_columns = raw_schema.select("profile", F.explode("s.columns").alias("column", "rule")).select(
        "profile", "column",
        F.coalesce(rule["dtype"], F.when(~F.col("rule").startswith("{"), F.col("rule")), F.lit("string")).alias("dtype"),
        F.coalesce(rule["required"], F.lit(True)).alias("required"),
        F.coalesce(rule["nullable"], F.lit(True)).alias("nullable"),
    )
    schema_options = raw_schema.select(
        "profile", F.coalesce("s.require_geometry", F.lit(True)).alias("require_geometry"),
        F.coalesce("s.allow_extra_columns", F.lit(True)).alias("allow_extra_columns"),
    )
    fields = component("domains", f"struct<fields:{FIELDS_TYPE}>", "d").select(
        "profile", F.explode("d.fields").alias("column", "field")
    )
    domain_values = fields.select(
        "profile", "column", F.posexplode("field.accepted_values").alias("position", "canonical")
    )
    domain_aliases = fields.select(
        "profile", "column", F.posexplode(F.map_entries("field.aliases")).alias("position", "e")
    ).select("profile", "column", F.col("e.key").alias("alias"), F.col("e.value").alias("canonical"), "position")
    relation_pairs = (
        component("relations", "struct<relations:map<string,map<string,string>>>", "r")
        .select("profile", F.posexplode(F.map_entries("r.relations")).alias("relation_position", "e"))
        .select("profile", F.col("e.key").alias("relation"), "relation_position", F.explode("e.value").alias("src_value", "dst_value"))
    )
    treatment = component("treatment", TREATMENT_TYPE, "t")
    column_functions = treatment.select("profile", F.explode("t.auto_functions").alias("column", "names")).select(
        "profile", "column", F.posexplode("names").alias("position", "function")
    )
    switch = lambda kind, name: treatment.select(
        "profile", F.lit(kind).alias("kind"), F.explode(name).alias("name", "enabled"), F.lit(0).alias("position")
    )
    options = (
        switch("output", "t.output_adjustments").unionByName(switch("quality", "t.quality_outputs"))
        .unionByName(
            treatment.select("profile", F.lit("postprocess").alias("kind"),
                             F.posexplode("t.postprocess_functions").alias("position", "name"))
            .withColumn("enabled", F.lit(True))
        )
    )
    return RuleTables(profiles, schema_columns, schema_options, domain_values, domain_aliases,
                      relation_pairs, column_functions, options, bundles)


def profile_config(rules: RuleTables, profile: str) -> dict:
    """Settings of one profile in one small read: everything but domain values and relation pairs.

    Of those only the names and the size of the component come back, which bounds
    the size of every lookup built from it.
    """
    body = F.col("body")
    names = F.when(
        F.col("component") == "domains.json",
        F.to_json(F.json_object_keys(F.get_json_object(body, "$.fields"))),
    ).when(
        F.col("component") == "relations.json",
        F.to_json(F.json_object_keys(F.get_json_object(body, "$.relations"))),
    ).otherwise(body)
    found = (
        rules.bundles.filter(F.col("profile") == profile)
        .select("component", names.alias("body"), F.length(body).alias("size")).collect()
    )
    config: dict = {"sizes": {}}
    for row in found:
        part = row["component"].removesuffix(".json")
        config[part] = json.loads(row["body"]) if row["body"] else {}
        config["sizes"][part] = row["size"]
    return config


def load_rules(spark: SparkSession, path: str, component: str | None = None, suffix: str = ".json") -> RuleTables:
    return rule_tables(read_bundles(spark, path, component, suffix).cache())

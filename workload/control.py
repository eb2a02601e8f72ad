"""Control table, profile resolution, code lists and the data dictionary."""

from __future__ import annotations

from pyspark.sql import functions as F

from talweg.functions.keys import location_key, parse_status, version_folder
from talweg.functions.text import theme_key
from talweg.operators import codelists as cl
from talweg.operators import control as c
from talweg.operators import dictionary as dd
from workload.inputs import CONTROL_SQL, STATUS_CASE, THEME_KEY_SQL, Registry, control_rows, rows, table

QUERIES = Registry()
ORACLES = QUERIES.sql
M = "ID % 7"
ALLOWED = "ID % 6 IN (0, 1, 4, 5)"
CODE_SQL = f"""CASE WHEN trim(path) = '' THEN 'missing_source_path' WHEN lower(path) LIKE '%.zip' THEN 'zip_source_path'
    WHEN ID % 5 > 2 AND ID % 8 = 5 THEN 'input_dataset_resolution_error' WHEN {M} = 4 THEN 'rule_profile_resolution_error'
    WHEN {M} IN (3, 6) THEN 'missing_rule_profile' WHEN {M} = 1 THEN 'rule_profile_incomplete'
    WHEN {M} = 2 THEN 'rule_profile_project_inconsistent' WHEN ID % 17 = 3 THEN 'versioning_metadata_incomplete' END"""
TRIAGE_SQL = f"SELECT *, {CODE_SQL} AS code FROM ({CONTROL_SQL}) WHERE {ALLOWED}"


def profiles(spark):
    return rows(
        spark, "profile string, project string, missing array<string>",
        ("car_area_preservacao_permanente/app_car_ac", "app_car", []),
        ("car_reserva_legal/rl_car_am", "car_reserva_legal", ["relations.json"]),
        ("estado", "other", []), ("x/shared", "", []), ("y/shared", "", []),
        ("autos_infracao/autos_infracao", "autos_infracao", []), ("z/autos_infracao", "", []),
    )


def triaged(spark, sf):
    control = control_rows(spark, sf)
    readable = control.filter("ID % 8 != 5 OR ID % 5 = 0").select(
        F.trim("path_shapefile_temp").alias("source_path")
    )
    return control, c.triage(control, profiles(spark), datasets=readable)


@QUERIES.query(
    """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'treatment' WHEN 1 THEN 'download,publish,treatment' WHEN 2 THEN 'download'
           WHEN 3 THEN 'download,review' WHEN 4 THEN 'schedule,treatment' ELSE 'publish,treatment' END AS flags,
           CASE o_orderkey % 6 WHEN 3 THEN 'review' ELSE '' END AS invalid,
           CASE o_orderkey % 6 WHEN 4 THEN '2026-05-13 18:49:00' END AS scheduled_for FROM orders"""
)
def statuses_parsed(spark, sf):
    plan = parse_status(F.expr(STATUS_CASE.replace("s_suppkey", "o_orderkey")))
    return table(spark, sf, "orders").select("o_orderkey", plan.alias("p")).select(
        "o_orderkey", F.array_join("p.flags", ",").alias("flags"), F.array_join("p.invalid", ",").alias("invalid"),
        F.date_format("p.scheduled_for", "yyyy-MM-dd HH:mm:ss").alias("scheduled_for"),
    )


@QUERIES.query(
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '00' WHEN 4 THEN NULL ELSE printf('%02d', o_orderkey % 300) END AS version FROM orders"""
)
def version_folders(spark, sf):
    text = """CASE o_orderkey % 5 WHEN 0 THEN ' ' WHEN 1 THEN cast(o_orderkey % 300 AS string)
              WHEN 2 THEN concat(cast(o_orderkey % 300 AS string), '.0') WHEN 3 THEN lpad(cast(o_orderkey % 300 AS string), 5, '0')
              ELSE 'v1' END"""
    return table(spark, sf, "orders").select("o_orderkey", version_folder(F.expr(text)).alias("version"))


PATH_SQL = f"""concat('lake/silver_data/', trim(access_constraints), '/', category_acronym, '/', {THEME_KEY_SQL.format(c='theme_folder')}, '/', citation, '/',
    CASE ID % 4 WHEN 0 THEN '20210915' WHEN 1 THEN '20210915' WHEN 2 THEN '20201231' ELSE '20200506' END)"""


@QUERIES.query(
    f"""SELECT ID, CASE WHEN ID % 17 = 3 THEN 'Campo access_constraints vazio para montagem do caminho.'
                       WHEN ID % 19 = 4 THEN 'Campo citation contem separador de caminho: A/B' END AS error,
               CASE WHEN ID % 17 <> 3 AND ID % 19 <> 4 THEN {PATH_SQL} || '/' || printf('%02d', ID % 12) END AS path
        FROM ({CONTROL_SQL})"""
)
def location_keys(spark, sf):
    key = location_key(
        "lake", "silver_data", F.col("access_constraints"), F.col("category_acronym"), F.col("theme_folder"),
        F.col("citation"), F.col("date"), F.col("ID") % 12,
    )
    return control_rows(spark, sf).select("ID", key.alias("k")).select("ID", "k.error", "k.path")


@QUERIES.query(
    f"""SELECT ID, array_to_string(list_filter([
          CASE WHEN ID % 6 = 3 THEN 'invalid_status_flags' WHEN ID % 6 = 2 THEN 'status_not_allowed' END,
          CASE WHEN {M} NOT IN (1, 2) THEN 'theme_not_requested' END,
          CASE WHEN trim(path) = '' THEN 'missing_source_path' END,
          CASE WHEN lower(path) LIKE '%.zip' THEN 'zip_source_path' END], lambda x: x IS NOT NULL), ',') AS blocking
        FROM ({CONTROL_SQL})"""
)
def eligibility_reasons(spark, sf):
    checked = c.with_eligibility(control_rows(spark, sf), c.RunRequest(themes='["rl_car_am", "Estado"]'))
    return checked.select("ID", F.array_join("blocking_reasons", ",").alias("blocking"))


@QUERIES.query(
    f"""SELECT ID, CASE WHEN {M} = 2 THEN '/other.gpkg' ELSE trim(path) END AS source_path, {M} = 2 OR ID % 6 = 4 AS status_allowed
        FROM ({CONTROL_SQL})"""
)
def scheduled_eligibility(spark, sf):
    """Scheduled mode with a source path override, which makes its theme eligible."""
    request = c.RunRequest(scheduled=True, source_path_overrides={"ESTADO": "/other.gpkg"})
    return c.with_eligibility(control_rows(spark, sf), request).select("ID", "source_path", "status_allowed")


@QUERIES.query(f"SELECT ID, code FROM ({TRIAGE_SQL})")
def control_triage(spark, sf):
    return triaged(spark, sf)[1].select("ID", "code")


@QUERIES.query(f"SELECT ID, theme_folder, trim(path) AS source_path, code FROM ({TRIAGE_SQL}) WHERE code IS NOT NULL")
def control_issues(spark, sf):
    return c.issues(triaged(spark, sf)[1]).select("ID", "theme_folder", "source_path", "code")


@QUERIES.query(
    f"""SELECT (SELECT count(*) FROM supplier) AS total_records, count(*) AS ready_candidates,
               count(*) FILTER (code IS NULL) AS eligible_records, count(code) AS issues FROM ({TRIAGE_SQL})"""
)
def control_summary(spark, sf):
    return c.run_summary(*triaged(spark, sf))


@QUERIES.query(f"SELECT ID FROM ({CONTROL_SQL}) WHERE {M} IN (0, 2)")
def selected_themes(spark, sf):
    return c.filter_themes(control_rows(spark, sf), {"value": ["APP_car_AC", " estado"]}).select("ID")


@QUERIES.query(
    f"""SELECT ID, {THEME_KEY_SQL.format(c='theme_folder')} AS theme_folder, '2026-05-13 18:49' AS scheduled_for
        FROM ({CONTROL_SQL}) WHERE ID % 6 = 4"""
)
def scheduled_records(spark, sf):
    return c.scheduled_rows(control_rows(spark, sf)).select(
        "ID", "theme_folder", F.date_format("scheduled_for", "yyyy-MM-dd HH:mm").alias("scheduled_for")
    )


@QUERIES.query(
    f"""WITH r AS (SELECT *, {PATH_SQL} AS p, ID % 17 = 3 OR ID % 19 = 4 AS bad FROM ({CONTROL_SQL})),
             v AS (SELECT p, max(printf('%02d', ID % 5)) AS version FROM r WHERE NOT bad AND ID % 3 <> 0 GROUP BY p)
        SELECT ID, CASE WHEN NOT bad THEN version END AS version,
               CASE WHEN bad THEN 'versioning_metadata_incomplete' WHEN version IS NULL THEN 'no_publishable_version' END AS code
        FROM r LEFT JOIN v USING (p) WHERE ID % 6 IN (1, 5)"""
)
def publishable_records(spark, sf):
    control = control_rows(spark, sf)
    where = location_key("lake", "silver_data", F.col("access_constraints"), F.col("category_acronym"),
                         F.col("theme_folder"), F.col("citation"), F.col("date"))
    versions = control.select(
        where["path"].alias("path"), F.format_string("%02d", F.col("ID") % 5).alias("version"),
        (F.col("ID") % 3 != 0).alias("has_data"),
    ).filter("path IS NOT NULL")
    return c.flagged_records(control, "publish", versions).select("ID", "version", "code")


@QUERIES.query(
    f"""SELECT ID, CASE WHEN ID % 6 = 3 THEN 'invalid_status_flags' END AS code FROM ({CONTROL_SQL}) WHERE ID % 6 IN (1, 2, 3)"""
)
def downloadable_records(spark, sf):
    return c.flagged_records(control_rows(spark, sf), "download").select("ID", "code")


@QUERIES.query(
    f"SELECT {THEME_KEY_SQL.format(c='theme_folder')} AS theme, count(*) AS expected FROM ({CONTROL_SQL}) GROUP BY ALL"
)
def record_group_sizes(spark, sf):
    return c.group_sizes(control_rows(spark, sf).withColumn("theme", theme_key(F.col("theme_folder"))), "theme")


@QUERIES.query(
    r"""SELECT DISTINCT p_brand AS theme_folder, CASE WHEN n = 0 THEN concat('a/', lower(p_brand)) END AS profile,
               CASE WHEN n = 1 THEN 'ambiguous' END AS error
        FROM (SELECT p_brand, regexp_extract(p_brand, '(\d+)', 1)::INT % 2 AS n FROM part)"""
)
def profiles_resolved(spark, sf):
    """Brands as themes: one profile for even brands, two equally good ones for odd brands."""
    brands = table(spark, sf, "part").select("p_brand").distinct()
    number = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    known = brands.select(F.concat(F.lit("a/"), F.lower("p_brand")).alias("profile")).unionByName(
        brands.filter(number % 2 == 1).select(F.concat(F.lit("b/"), F.lower("p_brand")).alias("profile"))
    ).select("profile", F.lit("").alias("project"), F.array().cast("array<string>").alias("missing"))
    asked = table(spark, sf, "part").select(F.col("p_brand").alias("theme_folder"))
    return c.resolve_profiles(asked, known).select("theme_folder", "profile", "error")


@QUERIES.query(
    "SELECT lower(p_type) AS stem, lower(concat(p_brand, '/', p_type)) AS profile, n AS profiles FROM "
    "(SELECT DISTINCT p_brand, p_type, count(*) OVER (PARTITION BY p_type) AS n FROM (SELECT DISTINCT p_brand, p_type FROM part)) WHERE n > 1"
)
def duplicate_profile_stems(spark, sf):
    names = table(spark, sf, "part").select(F.lower(F.concat_ws("/", "p_brand", "p_type")).alias("profile")).distinct()
    return c.duplicate_stems(names)


@QUERIES.query(
    """SELECT b AS profile, t AS component FROM (SELECT DISTINCT p_brand AS b FROM part), (VALUES ('ECONOMY'), ('SMALL'), ('none')) v(t)
       WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_brand = b AND p_type = t AND p_size < 10)"""
)
def incomplete_profiles(spark, sf):
    part = table(spark, sf, "part")
    present = part.filter("p_size < 10").select(F.col("p_brand").alias("profile"), F.col("p_type").alias("component"))
    return c.incomplete_profiles(part.select(F.col("p_brand").alias("profile")).distinct(), present, ("ECONOMY", "SMALL", "none"))


# Code lists: brands are profiles, types are columns, names are values.
@QUERIES.query(
    """SELECT DISTINCT p_brand AS profile, p_type AS "column", p_name AS alias, concat(p_name, p_size % 2) AS canonical FROM part a
       WHERE NOT EXISTS (SELECT 1 FROM part b WHERE b.p_brand = a.p_brand AND b.p_type = a.p_type AND b.p_size < 30
                         AND concat(b.p_name, '0') = concat(a.p_name, a.p_size % 2))"""
)
def dangling_aliases(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_brand").alias("profile"), F.col("p_type").alias("column"), "p_name", "p_size")
    aliases = part.select("profile", "column", F.col("p_name").alias("alias"),
                          F.concat("p_name", (F.col("p_size") % 2).cast("string")).alias("canonical")).distinct()
    values = part.filter("p_size < 30").select("profile", "column", F.concat("p_name", F.lit("0")).alias("canonical"))
    return cl.dangling_aliases(aliases, values)


@QUERIES.query(
    """WITH f AS (SELECT DISTINCT p_brand, p_type FROM part WHERE p_size < 20),
            r AS (SELECT DISTINCT p_brand, p_type, p_size % 4 AS k FROM part)
       SELECT p_brand AS profile, concat(p_type, '-', k) AS relation, 'malformed_name' AS problem FROM r WHERE k = 0
       UNION ALL SELECT p_brand, concat(p_type, '_to_', k), 'unconfigured_source' FROM r WHERE k > 0 AND p_brand IN (SELECT p_brand FROM f)
                 AND NOT EXISTS (SELECT 1 FROM f WHERE f.p_brand = r.p_brand AND f.p_type = r.p_type)
       UNION ALL SELECT p_brand, concat(p_type, '_to_', k), 'unconfigured_target' FROM r WHERE k > 0 AND p_brand IN (SELECT p_brand FROM f)
       UNION ALL SELECT p_brand, concat(p_type, '_to_', k), 'non_text_pair' FROM r WHERE k = 2"""
)
def broken_relations(spark, sf):
    part = table(spark, sf, "part").withColumn("k", F.col("p_size") % 4)
    pairs = part.select(
        F.col("p_brand").alias("profile"),
        F.when(F.col("k") == 0, F.concat("p_type", F.lit("-"), "k")).otherwise(F.concat("p_type", F.lit("_to_"), "k")).alias("relation"),
        F.lit("a").alias("src_value"), F.when(F.col("k") != 2, "b").alias("dst_value"),
    )
    fields = part.filter("p_size < 20").select(F.col("p_brand").alias("profile"), F.concat(F.lit("sdb_"), "p_type").alias("column")).distinct()
    return cl.broken_relations(pairs, fields)


@QUERIES.query(
    """WITH w AS (SELECT DISTINCT p_brand AS profile, p_type AS property, p_name AS literal FROM part WHERE p_size < 15),
            a AS (SELECT DISTINCT p_brand AS profile, p_type AS property, p_name AS literal FROM part WHERE p_size > 10)
       SELECT *, 'unknown' AS problem FROM (SELECT * FROM w EXCEPT SELECT * FROM a) WHERE (profile, property) IN (SELECT (profile, property) FROM a)
       UNION ALL SELECT *, 'missing' FROM (SELECT * FROM a EXCEPT SELECT * FROM w) WHERE (profile, property) IN (SELECT (profile, property) FROM w)"""
)
def style_coverage(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_brand").alias("profile"), F.col("p_type").alias("property"), F.col("p_name").alias("literal"), "p_size")
    values = part.filter("p_size > 10").select("profile", F.col("property").alias("column"), F.col("literal").alias("canonical"))
    return cl.style_coverage(part.filter("p_size < 15").drop("p_size"), values)


@QUERIES.query(
    """WITH u AS (SELECT DISTINCT p_brand AS profile, p_type AS "column", CASE p_size % 3 WHEN 0 THEN 'validate_shapefile_attribute'
                         WHEN 1 THEN 'validate_date_fields' ELSE 'nope' END AS function FROM part),
            f AS (SELECT DISTINCT p_brand, p_type FROM part WHERE p_size < 10)
       SELECT *, 'not_registered' AS problem FROM u WHERE function = 'nope'
       UNION ALL SELECT *, 'no_domain' FROM u WHERE function = 'validate_shapefile_attribute' AND profile IN (SELECT p_brand FROM f)
                 AND NOT EXISTS (SELECT 1 FROM f WHERE p_brand = profile AND p_type = "column")"""
)
def broken_functions(spark, sf):
    from talweg.plans.registry import COLUMN_FUNCTIONS

    part = table(spark, sf, "part")
    used = part.selectExpr("p_brand AS profile", "p_type AS column",
                           "CASE p_size % 3 WHEN 0 THEN 'validate_shapefile_attribute' WHEN 1 THEN 'validate_date_fields' ELSE 'nope' END AS function")
    fields = part.filter("p_size < 10").selectExpr("p_brand AS profile", "p_type AS column").distinct()
    registered = rows(spark, "function string", *[(n,) for n in COLUMN_FUNCTIONS])
    return cl.broken_functions(used, fields, registered)


@QUERIES.query(
    """SELECT k, array_to_string(list_distinct_ordered, ',') AS functions FROM (
         SELECT coalesce(a.k, b.k) AS k, list_concat(coalesce(a.f, []), list_filter(coalesce(b.f, []), lambda x: NOT list_contains(coalesce(a.f, []), x))) AS list_distinct_ordered
         FROM (SELECT o_orderkey AS k, [o_orderstatus, 'x'] AS f FROM orders WHERE o_orderkey % 3 > 0) a
         FULL JOIN (SELECT o_orderkey AS k, ['F', 'x', 'z'] AS f FROM orders WHERE o_orderkey % 3 < 2) b ON a.k = b.k)"""
)
def merged_functions(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_orderstatus")
    base = orders.filter("k % 3 > 0").select("k", F.array("o_orderstatus", F.lit("x")).alias("functions"))
    extra = orders.filter("k % 3 < 2").select("k", F.array(F.lit("F"), F.lit("x"), F.lit("z")).alias("functions"))
    return cl.merge_functions(base, extra, ["k"]).select("k", F.array_join("functions", ",").alias("functions"))


# Dictionary: parts as entries, brands as themes, names as attributes.
ENTRIES = """SELECT p_partkey, p_brand AS theme, replace(p_name, ' ', '_') AS original_attribute_name,
    concat('sdb_', replace(p_name, ' ', '_')) AS derived_attribute_name,
    CASE WHEN p_size % 3 = 0 THEN concat('o', p_size) ELSE '' END AS original_description,
    CASE WHEN p_size % 4 = 0 THEN concat('d', p_size) ELSE '' END AS derived_description FROM part"""
DESCRIBED = f"""
    SELECT lower(theme) AS theme, namespace, lower(name) AS name, coalesce(arg_min(d, p_partkey) FILTER (d <> ''), '') AS description
    FROM (SELECT p_partkey, theme, 'original' AS namespace, original_attribute_name AS name,
                 CASE WHEN original_description <> '' THEN original_description ELSE derived_description END AS d FROM ({ENTRIES})
          UNION ALL SELECT p_partkey, theme, 'derived', derived_attribute_name,
                 CASE WHEN derived_description <> '' THEN derived_description ELSE original_description END FROM ({ENTRIES}))
    GROUP BY ALL
"""


def described(spark, sf):
    part = table(spark, sf, "part")
    entries = part.select(
        "p_partkey", F.col("p_brand").alias("theme"), F.replace("p_name", F.lit(" "), F.lit("_")).alias("original_attribute_name"),
        F.concat(F.lit("sdb_"), F.replace("p_name", F.lit(" "), F.lit("_"))).alias("derived_attribute_name"),
        F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("o"), "p_size")).otherwise("").alias("original_description"),
        F.when(F.col("p_size") % 4 == 0, F.concat(F.lit("d"), "p_size")).otherwise("").alias("derived_description"),
    )
    return dd.descriptions(entries, "p_partkey")


@QUERIES.query(DESCRIBED)
def dictionary_descriptions(spark, sf):
    return described(spark, sf)


@QUERIES.query(
    f"""WITH d AS ({DESCRIBED}), f AS (SELECT DISTINCT p_brand AS theme, replace(p_name, ' ', '_') AS field FROM part)
        SELECT f.theme, f.field, coalesce(
            (SELECT max(description) FROM d WHERE d.theme = lower(f.theme) AND namespace = 'derived' AND name = 'sdb_' || f.field AND description <> ''),
            (SELECT max(description) FROM d WHERE d.theme = lower(f.theme) AND namespace = 'original' AND name = f.field AND description <> ''), '') AS description
        FROM f UNION ALL SELECT theme, 'acm_' || field, '' FROM f"""
)
def field_descriptions(spark, sf):
    fields = table(spark, sf, "part").select(F.col("p_brand").alias("theme"), F.replace("p_name", F.lit(" "), F.lit("_")).alias("field"))
    return dd.resolve_descriptions(
        fields.unionByName(fields.withColumn("field", F.concat(F.lit("acm_"), "field"))), described(spark, sf)
    )


@QUERIES.query(
    """WITH l AS (SELECT DISTINCT o_custkey AS layer, CASE WHEN o_custkey % 10 = 0 THEN 'none' ELSE 'orders' END AS theme, o_orderpriority AS a FROM orders),
            d(a) AS (VALUES ('1-URGENT'), ('2-HIGH'), ('Extra'))
       SELECT layer, d.a AS attribute, 'missing' AS difference FROM (SELECT DISTINCT layer FROM l WHERE theme = 'orders') s, d
       WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.layer = s.layer AND lower(l.a) = lower(d.a))
       UNION ALL SELECT layer, a, 'extra' FROM l WHERE theme = 'orders' AND a NOT IN (SELECT a FROM d)
       UNION ALL SELECT DISTINCT layer, NULL, 'theme_not_found' FROM l WHERE theme = 'none'"""
)
def attribute_differences(spark, sf):
    layers = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("layer"), F.when(F.col("o_custkey") % 10 == 0, "none").otherwise(" Orders ").alias("theme"),
        F.col("o_orderpriority").alias("attribute"),
    )
    dictionary = rows(spark, "theme string, attribute string", ("orders", "1-URGENT"), ("orders", "2-HIGH"),
                      ("Orders", "Extra"), ("orders", "acm_x"), ("orders", "fid"), ("orders", "-"))
    return dd.attribute_diff(layers, dictionary)


@QUERIES.query(
    """SELECT c_custkey AS layer, f AS field, CASE WHEN f = 'seg' THEN 'exact' WHEN f = 'bal' THEN 'prefixed' WHEN f = 'key' AND c_custkey % 2 = 0 THEN 'sole' ELSE '' END AS type
       FROM customer, (VALUES ('seg'), ('bal'), ('key')) v(f)"""
)
def attribute_types(spark, sf):
    layer = table(spark, sf, "customer").select(F.col("c_custkey").alias("layer"))
    entry = lambda n, t: F.struct(F.lit(n).alias("name"), F.lit(t).alias("type"))
    names = F.array_compact(F.array(
        entry("seg", "exact"), entry("sdb_seg", "other"), entry("sdb_bal", "prefixed"), entry("x_bal", "other"),
        entry("cust_key", "sole"), F.when(F.col("layer") % 2 == 1, entry("nation_key", "second")),
    ))
    types = layer.select("layer", F.inline(names))
    fields = layer.select("layer", F.explode(F.array(F.lit("seg"), F.lit("bal"), F.lit("key"))).alias("field"))
    return dd.attribute_types(fields, types)

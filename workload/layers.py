"""Scans, sinks, rule bundles and whole treatments."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talweg.functions import geometry as g
from talweg.functions.shapes import POLYGON, write_tree
from talweg.operators import quality as q
from talweg.operators import spatial as sp
from talweg.operators.identifiers import merge_files
from talweg.operators.scale import staging_folder
from talweg.operators.spatial import STATE_BOUNDS
from talweg.plans.treatment import TreatmentResult, treat
from talweg.sources import sinks
from talweg.sources.rules import load_rules, rule_tables
from talweg.sources.tables import resolve_paths, scan_many
from workload.inputs import BOX_SQL, LAT_SQL, LON_SQL, POINT_BOXES_SQL, Registry, customer_boxes, lat, lon, nation_regions, rows, spread_table, table

QUERIES = Registry()
ORACLES = QUERIES.sql


@QUERIES.query("SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY event_type")
def scan_many_files(spark, sf):
    """Events written as a tree of files and read back recursively, provenance giving the type."""
    folder = staging_folder(spark)
    table(spark, sf, "events").select("event_id", F.col("event_type").alias("kind"), "event_type").write.partitionBy("kind").parquet(folder)
    found = scan_many(spark, [folder], recursive=True)
    kind = F.regexp_extract("source_file", "kind=([a-z]+)", 1)
    return found.groupBy(kind.alias("event_type")).agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@QUERIES.query("SELECT o_orderkey % 3 + 1 AS file, count(*) AS n FROM orders GROUP BY ALL")
def numbered_sibling_files(spark, sf):
    """Numbered siblings x_1, x_2, x_3 of one file, resolved and united."""
    folder = staging_folder(spark)
    orders = table(spark, sf, "orders").select("o_orderkey")
    for i in range(3):
        orders.filter(F.col("o_orderkey") % 3 == i).write.parquet(f"{folder}/layer_{i + 1}.parquet")
    frames = [
        spark.read.parquet(p).withColumn("file", F.lit(int(p.rsplit("_", 1)[1].split(".")[0])))
        for p in resolve_paths(spark, f"{folder}/layer_1.parquet")
    ]
    return merge_files(frames).groupBy(F.col("file").cast("bigint").alias("file")).agg(F.count(F.lit(1)).alias("n"))


@QUERIES.query(
    """SELECT o_orderkey AS k, o_orderstatus AS a, NULL AS b FROM orders WHERE o_orderkey % 2 = 0
       UNION ALL SELECT o_orderkey, NULL, o_orderpriority FROM orders WHERE o_orderkey % 2 = 1"""
)
def consolidated_group(spark, sf):
    """The first layer of a group creates the table, the second appends with other columns."""
    path = staging_folder(spark)
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "k")
    sinks.append_group(orders.filter("k % 2 = 0").select("k", F.col("o_orderstatus").alias("a")), path, first=True)
    sinks.append_group(orders.filter("k % 2 = 1").select("k", F.col("o_orderpriority").alias("b")), path, first=False)
    return sinks.read_group(spark, path).select("k", "a", "b")


@QUERIES.query("SELECT count(*) AS bronze_rows, count(*) FILTER (c_custkey % 2 = 0) AS silver_rows, 6 AS silver_columns FROM customer")
def bronze_and_silver(spark, sf):
    """A raw copy is kept on the second write; the treated table replaces its version."""
    base = staging_folder(spark)
    customers = table(spark, sf, "customer")
    sinks.write_bronze(customers, f"{base}/bronze")
    bronze = sinks.write_bronze(customers.filter("c_custkey < 0"), f"{base}/bronze")
    flagged = customers.withColumn("__internal_geom_null_safe_repair", F.lit(False)).withColumn("x", F.lit(1))
    sinks.write_silver(flagged, f"{base}/silver")
    silver = sinks.write_silver(flagged.filter("c_custkey % 2 = 0"), f"{base}/silver")
    return bronze.agg(F.count(F.lit(1)).alias("bronze_rows")).withColumn("k", F.lit(1)).join(
        silver.agg(F.count(F.lit(1)).alias("silver_rows")).withColumn("k", F.lit(1)), "k"
    ).select("bronze_rows", "silver_rows", F.lit(len(silver.columns)).alias("silver_columns"))


@QUERIES.query(
    f"""SELECT report, n FROM (
          SELECT 'attribute_duplicates' AS report, coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS n
          FROM (SELECT count(*) AS n FROM customer GROUP BY c_nationkey, c_mktsegment)
          UNION ALL SELECT 'geometric_duplicates', coalesce(sum(n) FILTER (n > 1), 0)::BIGINT
          FROM (SELECT count(*) AS n FROM ({BOX_SQL}) GROUP BY x0, y0, x1, y1)
          UNION ALL SELECT 'ogc_invalid', 0) WHERE n > 0"""
)
def quality_report_tables(spark, sf):
    """Audit tables written, listed in the manifest and read back."""
    base = staging_folder(spark)
    boxes = customer_boxes(spark, sf).select(F.col("c_custkey").alias("acm_id"), "c_nationkey", "c_mktsegment", "geometry", "srid")
    written = sinks.write_reports(q.quality_reports(boxes), f"{base}/reports")
    sinks.append_manifest(spark, f"{base}/manifest", f"{base}/silver", "primary", written)
    found = None
    for row in spark.read.parquet(f"{base}/manifest").collect():
        part = spark.read.parquet(row["report_path"]).select(F.lit(row["report"]).alias("report"))
        found = part if found is None else found.unionByName(part)
    return found.groupBy("report").agg(F.count(F.lit(1)).alias("n"))


@QUERIES.query(
    """SELECT DISTINCT p_brand AS profile, p_type AS "column", p_name AS value, 'accepted' AS kind FROM part
       UNION ALL SELECT DISTINCT p_brand, p_type, concat('x ', p_name), 'alias' FROM part
       UNION ALL SELECT DISTINCT p_brand, concat(p_brand, '_to_', p_type), p_name, 'relation' FROM part"""
)
def rule_tables_from_bundles(spark, sf):
    """Rule bundles as JSON texts, one per brand, exploded to rule tables."""
    part = table(spark, sf, "part").select("p_brand", "p_type", "p_name").distinct()
    lists = part.groupBy("p_brand", "p_type").agg(F.array_sort(F.collect_list("p_name")).alias("names"))
    aliases = F.map_from_entries(F.transform("names", lambda n: F.struct(F.concat(F.lit("x "), n), n)))
    pairs = F.map_from_entries(F.transform("names", lambda n: F.struct(n, n)))
    fields = F.map_from_entries(F.collect_list(F.struct(
        F.col("p_type"), F.struct(F.col("names").alias("accepted_values"), aliases.alias("aliases")))))
    relations = F.map_from_entries(F.collect_list(F.struct(F.concat_ws("_to_", "p_brand", "p_type"), pairs)))
    bodies = lists.groupBy(F.col("p_brand").alias("profile")).agg(
        F.to_json(F.struct(fields.alias("fields"))).alias("domains"),
        F.to_json(F.struct(relations.alias("relations"))).alias("relations"),
    )
    bundles = bodies.unpivot(["profile"], ["domains", "relations"], "component", "body").withColumn(
        "component", F.concat("component", F.lit(".json"))
    )
    rules = rule_tables(bundles)
    shape = lambda df, column, value, kind: df.select("profile", F.col(column).alias("column"), F.col(value).alias("value"), F.lit(kind).alias("kind"))
    return (
        shape(rules.domain_values, "column", "canonical", "accepted")
        .unionByName(shape(rules.domain_aliases, "column", "alias", "alias"))
        .unionByName(shape(rules.relation_pairs, "relation", "src_value", "relation"))
    )


ORDER_BUNDLE = (
    ("profile.json", '{"profile_name": "orders", "project_name": "autos_infracao", "theme_folder": "rl_car_ma", "description": ""}'),
    ("input_schema.json",
     '{"columns": {"sdb_key": {"dtype": "integer", "nullable": false}, "sdb_status": "string", "sdb_label": "string", '
     '"sdb_price": "number", "sdb_date": {"dtype": "date"}, "sdb_condition": "string"}}'),
    ("domains.json",
     '{"fields": {"sdb_status": {"accepted_values": ["Final", "Open"], "aliases": {"F": "Final", "o": "Open"}}}}'),
    ("relations.json", '{"relations": {"status_to_label": {"Final": "Encerrado", "Open": "Aberto"}}}'),
    ("treatment.json",
     '{"postprocess_functions": ["enforce_car_state_bounds", "enrich_with_municipality_intersection"],'
     ' "output_adjustments": {"relocate_outside_brazil_bounds_to_centroid": true},'
     ' "auto_functions": {"sdb_status": ["validate_shapefile_attribute"], "sdb_label": ["validate_shapefile_attribute"],'
     ' "sdb_date": ["validate_date_fields"], "sdb_condition": ["car_reserva_legal_transform_des_condic"], "sdb_none": ["nope"]}}'),
)


def order_rules(spark: SparkSession):
    """A profile as a user would write it, labels included as a domain."""
    bundle = [("orders", name, body.replace('"aliases": {"F": "Final", "o": "Open"}}}',
                                            '"aliases": {"F": "Final", "o": "Open"}}, '
                                            '"sdb_label": {"accepted_values": ["Encerrado", "Aberto", "Parcial"], "aliases": {"encerr.": "Encerrado"}}}'))
              for name, body in ORDER_BUNDLE]
    return rule_tables(rows(spark, "profile string, component string, body string", *bundle))


def order_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as a point layer with untidy attributes."""
    return spread_table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("Key"),
        F.when(F.col("o_orderkey") % 10 == 0, F.lit(None)).otherwise(F.concat(F.lit(" "), "o_orderstatus", F.lit("  "))).alias("status"),
        F.when(F.col("o_orderkey") % 4 == 0, "encerr.").otherwise("Aberto").alias("label"),
        F.col("o_totalprice").cast("string").alias("price"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("date"),
        F.when(F.col("o_orderkey") % 2 == 0, "Cancelado por  decisão").otherwise("Em analise").alias("condition"),
        g.make_point(lon("o_custkey"), lat("o_custkey")).alias("geometry"), F.lit(4674).alias("srid"),
    )


def treated_layer(spark: SparkSession, sf: str) -> TreatmentResult:
    return treat(order_layer(spark, sf), order_rules(spark), "orders", ["Key"], regions=nation_regions(spark, sf))


# The label follows the status: F and O are mapped, P and null are not.
TREATED_SQL = """
    SELECT o_orderkey::BIGINT AS sdb_key, row_number() OVER (ORDER BY o_orderkey) AS acm_id,
           CASE WHEN o_orderkey % 10 <> 0 THEN o_orderstatus END AS sdb_status,
           CASE WHEN o_orderkey % 10 <> 0 THEN CASE o_orderstatus WHEN 'F' THEN 'Final' WHEN 'O' THEN 'Open' ELSE o_orderstatus END END AS acm_status,
           CASE WHEN o_orderkey % 10 <> 0 AND o_orderstatus = 'F' THEN 'Encerrado' WHEN o_orderkey % 10 <> 0 AND o_orderstatus = 'O' THEN 'Aberto'
                WHEN o_orderkey % 4 = 0 THEN 'Encerrado' ELSE 'Aberto' END AS acm_label,
           o_orderdate::DATE AS acm_date, CASE WHEN o_orderkey % 2 = 0 THEN 'Cancelado' ELSE 'Em analise' END AS acm_condition,
           o_custkey FROM orders
"""
OX, OY = f"{LON_SQL.format(k='o_custkey')}::DOUBLE", f"{LAT_SQL.format(k='o_custkey')}::DOUBLE"


@QUERIES.query(
    f"""SELECT sdb_key, acm_id, sdb_status, acm_status, acm_label, acm_date, acm_condition, round({OX}, 4) AS acm_long,
               coalesce(code, 'Fora do limite territorial brasileiro / zona costeira') AS acm_cod_munici
        FROM ({TREATED_SQL}) o LEFT JOIN ({POINT_BOXES_SQL.format(x=OX, y=OY)}) h ON h.k = o.o_custkey"""
)
def treated_orders(spark, sf):
    """Flagship: read, conform, rules, metrics, repair, clip and region join in one plan."""
    data = treated_layer(spark, sf).data
    return data.select(
        "sdb_key", "acm_id", "sdb_status", "acm_status", "acm_label", "acm_date", "acm_condition",
        F.round("acm_long", 4).alias("acm_long"), "acm_cod_munici",
    )


@QUERIES.query(
    """WITH l AS (SELECT o_orderkey % 10 = 0 AS gone, o_orderstatus AS s, CASE WHEN o_orderkey % 4 = 0 THEN 'normalized' ELSE 'valid' END AS label FROM orders)
       SELECT 'sdb_label' AS "column", label AS status, '' AS reason, count(*) AS n FROM l GROUP BY label
       UNION ALL SELECT 'sdb_status', CASE WHEN gone THEN 'empty' WHEN s IN ('F', 'O') THEN 'normalized' ELSE 'invalid' END,
              CASE WHEN gone THEN 'Valor nulo.' WHEN s IN ('F', 'O') THEN '' ELSE 'Valor fora do dominio configurado.' END, count(*) FROM l GROUP BY ALL"""
)
def treated_domain_summary(spark, sf):
    return treated_layer(spark, sf).domain_summary()


@QUERIES.query(
    """WITH l AS (SELECT CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'Final' WHEN o_orderstatus = 'O' THEN 'Open' ELSE o_orderstatus END AS s,
                         CASE WHEN o_orderkey % 4 = 0 THEN 'Encerrado' ELSE 'Aberto' END AS label FROM orders),
            c AS (SELECT s, CASE WHEN s IS NULL OR s NOT IN ('Final', 'Open') THEN 'unchecked'
                                 WHEN label = CASE s WHEN 'Final' THEN 'Encerrado' ELSE 'Aberto' END THEN 'consistent' ELSE 'autocorrected' END AS status FROM l)
       SELECT 'status_to_label' AS relation, status, CASE WHEN status <> 'consistent' THEN coalesce(s, '<NULL>') END AS source_value, count(*) AS n FROM c GROUP BY ALL"""
)
def treated_relation_summary(spark, sf):
    return treated_layer(spark, sf).relation_summaries()


@QUERIES.query("SELECT 'sdb_status' AS \"column\", 'accepted' AS kind, 'P' AS value, 'P' AS canonical FROM (SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'P') WHERE n > 0")
def treated_rule_deltas(spark, sf):
    """What the treatment learns: the unknown status becomes an accepted value."""
    return treated_layer(spark, sf).rule_deltas()[0]


# Labels that follow the priority, but for one priority that has two.
PRIORITY_LABEL_SQL = """CASE WHEN o_orderpriority = '5-LOW' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'Aberto' ELSE 'Encerrado' END
    WHEN o_orderpriority < '3' THEN 'encerr.' ELSE 'Parcial' END"""
RELATION_BUNDLE = (
    ("profile.json", '{"profile_name": "priorities"}'),
    ("domains.json", '{"fields": {"sdb_label": {"accepted_values": ["Encerrado", "Aberto", "Parcial"], "aliases": {"encerr.": "Encerrado"}}, '
                     '"sdb_status": {"accepted_values": ["F", "O"], "aliases": {}}}}'),
    ("relations.json", '{"relations": {"priority_to_label": {"2-HIGH": "Encerrado"}, "clerk_to_status": {}}}'),
)


@QUERIES.query(
    f"""WITH l AS (SELECT o_orderpriority AS p, {PRIORITY_LABEL_SQL} AS l, concat('C', o_custkey) AS clerk, o_orderstatus FROM orders)
        SELECT 'priority_to_label' AS relation, p AS src_value, CASE min(l) WHEN 'encerr.' THEN 'Encerrado' ELSE min(l) END AS dst_value
        FROM l WHERE p <> '2-HIGH' GROUP BY p HAVING min(l) = max(l)
        UNION ALL SELECT 'clerk_to_status', clerk, min(o_orderstatus) FROM l GROUP BY clerk
        HAVING min(o_orderstatus) = max(o_orderstatus) AND min(o_orderstatus) <> 'P'"""
)
def treated_relation_deltas(spark, sf):
    """Relations that a treatment learns: sources with one target that is valid in its domain and not yet mapped."""
    bundle = [("priorities", name, body) for name, body in RELATION_BUNDLE]
    layer = spread_table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("priority"), F.expr(PRIORITY_LABEL_SQL).alias("label"), F.concat(F.lit("C"), "o_custkey").alias("clerk"),
        F.col("o_orderstatus").alias("status"), g.make_point(lon("o_custkey"), lat("o_custkey")).alias("geometry"), F.lit(4326).alias("srid"),
    )
    return treat(layer, rule_tables(rows(spark, "profile string, component string, body string", *bundle)), "priorities", ["o_orderkey"]).rule_deltas()[1]


@QUERIES.query(
    """SELECT count(*) AS rows, count(*) FILTER (o_orderkey % 5 = 0) AS forced_to_2d,
              count(*) FILTER (o_orderkey % 4 <> 0) AS reprojected_to_wgs84, count(*) AS skipped_point_measurements FROM orders"""
)
def treated_stats(spark, sf):
    """Statistics of a run as observed while its rows were written: points with Z, three of four in other systems, one of those unset."""
    points = order_layer(spark, sf)
    raised = F.unhex(F.concat(F.lit("0101000080"), F.substring(F.hex("geometry"), 11, 32), F.lit("000000000000F03F")))
    key = F.col("Key").cast("bigint")
    layer = points.withColumn("geometry", F.when(key % 5 == 0, raised).otherwise(F.col("geometry"))).withColumn(
        "srid", F.when(key % 4 == 0, F.lit(4326)).when(key % 4 != 1, F.lit(4674))
    )
    stats = treat(layer, order_rules(spark), "orders", ["Key"], regions=nation_regions(spark, sf)).stats
    names = ("rows", "forced_to_2d", "reprojected_to_wgs84", "skipped_point_measurements")
    return spark.createDataFrame([tuple(stats[n] for n in names)], ", ".join(f"{n} long" for n in names))


CLIP_BUNDLE = '{"postprocess_functions": ["enforce_car_state_bounds"]}'
MA = STATE_BOUNDS["ma"]
MA_SQL = "x1 > {2} OR x0 < {0} OR y1 > {3} OR y0 < {1}".format(*MA)
MEETS_MA_SQL = "x1 >= {0} AND x0 <= {2} AND y1 >= {1} AND y0 <= {3}".format(*MA)


@QUERIES.query(
    f"""SELECT c_custkey AS sdb_c_custkey, round(CASE WHEN clip THEN greatest(x0, {MA[0]}) ELSE x0 END, 6) AS minx,
               round(CASE WHEN clip THEN least(y1, {MA[3]}) ELSE y1 END, 6) AS maxy
        FROM (SELECT *, ({MA_SQL}) AND ({MEETS_MA_SQL}) AS clip FROM ({BOX_SQL}))"""
)
def treated_clip_by_input_path(spark, sf):
    """The state comes from the input path when theme and profile name none."""
    bundle = (("anywhere", "profile.json", '{"profile_name": "anywhere"}'), ("anywhere", "treatment.json", CLIP_BUNDLE))
    boxes = customer_boxes(spark, sf).select("c_custkey", "geometry", "srid")
    result = treat(boxes, rule_tables(rows(spark, "profile string, component string, body string", *bundle)), "anywhere", ["c_custkey"],
                   input_path="/lake/in/RL_CAR_MA.gpkg", source_path="/src/app_car_ac.gpkg")
    return sp.with_facts(result.data, "f").select("sdb_c_custkey", F.round("f.minx", 6).alias("minx"), F.round("f.maxy", 6).alias("maxy"))


# A region in the shape of an L: a tall box and a flat one.
TALL, FLAT = (-60.0, -30.0, -52.0, 0.0), (-60.0, -30.0, -36.0, -24.0)
L_WKB = write_tree(POLYGON, [np.array([(-60, -30), (-36, -30), (-36, -24), (-52, -24), (-52, 0), (-60, 0), (-60, -30)], float)])
IN_L_SQL = " OR ".join("(x1 >= {0} AND x0 <= {2} AND y1 >= {1} AND y0 <= {3})".format(*b) for b in (TALL, FLAT))


@QUERIES.query(f"SELECT c_custkey FROM ({BOX_SQL}) WHERE {IN_L_SQL}")
def features_in_polygon_region(spark, sf):
    """Boxes that meet a region that isn't convex."""
    return sp.filter_to_region(customer_boxes(spark, sf), sp.Region.of_polygon(L_WKB)).select("c_custkey")


@QUERIES.query(f"SELECT c_custkey AS sdb_c_custkey, CASE WHEN NOT ({IN_L_SQL}) THEN true END AS moved, NOT ({IN_L_SQL}) AS at_anchor FROM ({BOX_SQL})")
def treated_relocation_to_polygon_region(spark, sf):
    """Features off a polygon region go to its anchor, which lies inside, at the end of a treatment."""
    bundle = (("moved", "profile.json", '{"profile_name": "moved"}'),
              ("moved", "treatment.json", '{"output_adjustments": {"relocate_outside_brazil_bounds_to_centroid": true}}'))
    boxes = customer_boxes(spark, sf).select("c_custkey", "geometry", "srid")
    region = sp.Region.of_polygon(L_WKB)
    silver = treat(boxes, rule_tables(rows(spark, "profile string, component string, body string", *bundle)), "moved", ["c_custkey"], region=region).silver
    x, y = region.anchor()
    return silver.select(
        "sdb_c_custkey", F.when(F.col(sp.RELOCATED_LATITUDE).isNotNull(), F.lit(True)).alias("moved"), (F.col("geometry") == F.lit(g.point_wkb(x, y))).alias("at_anchor")
    )


@QUERIES.query(
    """SELECT 'domain' AS kind, p_brand AS profile, p_type AS "column", count(DISTINCT p_name) AS n FROM part GROUP BY ALL
       UNION ALL SELECT 'alias', p_brand, p_type, count(DISTINCT p_name) FROM part GROUP BY ALL"""
)
def rules_loaded_from_folder(spark, sf):
    """Bundles of the parts, written as files of a rules folder and read by the folder reader."""
    part = table(spark, sf, "part").select("p_brand", "p_type", "p_name").distinct()
    lists = part.groupBy("p_brand", "p_type").agg(F.array_sort(F.collect_list("p_name")).alias("names"))
    aliases = F.map_from_entries(F.transform("names", lambda n: F.struct(F.concat(F.lit("x "), n), n)))
    field = F.struct(F.col("names").alias("accepted_values"), aliases.alias("aliases"))
    # Spark names files itself, so each bundle's component is the part of the folder's name that holds its file.
    folder = staging_folder(spark)
    bodies = lists.select(
        F.col("p_brand").alias("brand"), F.col("p_type").alias("type"),
        F.to_json(F.struct(F.create_map(F.col("p_type"), field).alias("fields"))).alias("value"),
    )
    bodies.repartition("brand").write.partitionBy("brand", "type").text(folder)
    found = load_rules(spark, folder, component="domains.json", suffix=".txt")
    name = F.url_decode(F.regexp_extract("profile", "brand=([^/]*)", 1))
    count = lambda df, kind: df.groupBy(F.lit(kind).alias("kind"), name.alias("profile"), "column").agg(F.count(F.lit(1)).alias("n"))
    return count(found.domain_values, "domain").unionByName(count(found.domain_aliases, "alias"))


@QUERIES.query(
    """SELECT year, version, count(*) AS n, sum(k)::BIGINT AS keys FROM (
          SELECT 1990 + o_orderkey % 3 AS year, '00' AS version, o_orderkey AS k FROM orders
          UNION ALL SELECT 1990 + o_orderkey % 3, '01', o_orderkey FROM orders WHERE o_orderkey % 3 <> 1
          UNION ALL SELECT 1991, '01', o_orderkey * 10 FROM orders WHERE o_orderkey % 3 = 1 AND o_orderkey % 2 = 0)
       GROUP BY ALL"""
)
def versioned_silver(spark, sf):
    """Two versions in one table; rewriting part of the second leaves all others as they are."""
    path = staging_folder(spark)
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("long").alias("k"), (F.lit(1990) + F.col("o_orderkey") % 3).alias("year"), F.lit(False).alias("__internal_geom_null_safe_repair")
    )
    by = ["version", "year"]
    sinks.write_silver_versions(orders.withColumn("version", F.lit("00")), path, by)
    sinks.write_silver_versions(orders.withColumn("version", F.lit("01")), path, by)
    again = orders.filter("year = 1991 AND k % 2 = 0").withColumn("k", F.col("k") * 10).withColumn("version", F.lit("01"))
    sinks.write_silver_versions(again, path, by)
    parts = [sinks.read_silver_version(spark, path, version=v) for v in ("00", "01")]
    return parts[0].unionByName(parts[1]).groupBy(F.col("year").cast("int").alias("year"), "version").agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("keys"))

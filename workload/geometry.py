"""Geometry functions, metrics, regions, clipping and the intersects join."""

from __future__ import annotations

from pyspark.sql import functions as F

from talweg.functions import geometry as g
from talweg.operators import spatial as sp
from talweg.operators.spatial_join import assign_regions, intersecting_pairs, normalize_uf, reference_layer
from workload.inputs import (
    BOX_SQL, LAT_SQL, LON_SQL, REGION_SQL, Registry, customer_boxes, customer_corners, customer_points, nation_regions, table,
)

QUERIES = Registry()
ORACLES = QUERIES.sql
PX, PY = f"{LON_SQL.format(k='c_custkey')}::DOUBLE", f"{LAT_SQL.format(k='c_custkey')}::DOUBLE"
BOX = sp.REGION_BOX


@QUERIES.query(
    f"""SELECT c_custkey, CASE WHEN c_custkey % 11 <> 0 THEN 'Point' END AS kind, c_custkey % 11 <> 0 AS finite,
               CASE WHEN c_custkey % 11 <> 0 THEN {PX} END AS minx, CASE WHEN c_custkey % 11 <> 0 THEN {PY} END AS maxy
        FROM customer"""
)
def point_facts(spark, sf):
    return sp.with_facts(customer_points(spark, sf), "f").select("c_custkey", "f.kind", "f.finite", "f.minx", "f.maxy")


# Forward polyconic of a coordinate pair (Snyder 1987), in SQL.
E2 = "0.006694380022903416::DOUBLE"


def _meridian(phi):
    return f"""(6378137.0::DOUBLE * ((1 - {E2}/4 - 3*{E2}*{E2}/64 - 5*{E2}*{E2}*{E2}/256) * {phi}
        - (3*{E2}/8 + 3*{E2}*{E2}/32 + 45*{E2}*{E2}*{E2}/1024) * sin(2*{phi})
        + (15*{E2}*{E2}/256 + 45*{E2}*{E2}*{E2}/1024) * sin(4*{phi}) - (35*{E2}*{E2}*{E2}/3072) * sin(6*{phi})))"""


def _project(lon, lat):
    lam, phi = f"radians({lon} + 54)", f"radians({lat})"
    r = f"(6378137.0::DOUBLE / sqrt(1 - {E2} * sin({phi}) * sin({phi})) / tan({phi}))"
    flat = f"abs({phi}) < 1e-12"
    x = f"CASE WHEN {flat} THEN 6378137.0::DOUBLE * {lam} ELSE {r} * sin({lam} * sin({phi})) END"
    y = f"CASE WHEN {flat} THEN 0 ELSE {_meridian(phi)} + {r} * 2 * pow(sin({lam} * sin({phi}) / 2), 2) END"
    return x, y


PROJECTED = f"""
    SELECT c_custkey, c_nationkey, x0, y0, x1, y1, {', '.join(
        f'{_project(lon, lat)[0]} AS px{i}, {_project(lon, lat)[1]} AS py{i}'
        for i, (lon, lat) in enumerate((('x0', 'y0'), ('x1', 'y0'), ('x1', 'y1'), ('x0', 'y1'))))}
    FROM ({BOX_SQL})
"""
AREA_HA = """abs((px1-px0)*(py2-py0) - (px2-px0)*(py1-py0) + (px2-px0)*(py3-py0) - (px3-px0)*(py2-py0)) / 2 / 10000"""
LENGTH_KM = " + ".join(
    f"sqrt(pow(px{b}-px{a}, 2) + pow(py{b}-py{a}, 2))" for a, b in ((0, 1), (1, 2), (2, 3), (3, 0))
)


@QUERIES.query(
    f"""SELECT c_custkey, round(round({AREA_HA}, 6), 2) AS acm_a_ha, round(round(({LENGTH_KM}) / 1000, 6), 3) AS acm_prm_km,
               round((x0 + x1) / 2, 4) AS acm_long, round((y0 + y1) / 2, 4) AS acm_lat FROM ({PROJECTED})"""
)
def polygon_metrics(spark, sf):
    """Area, perimeter and centroid of boxes, rounded for the comparison."""
    m = sp.spatial_metrics(customer_boxes(spark, sf))
    return m.select(
        "c_custkey", F.round("acm_a_ha", 2).alias("acm_a_ha"), F.round("acm_prm_km", 3).alias("acm_prm_km"),
        F.round(F.col("acm_long") + 0.0, 4).alias("acm_long"), F.round("acm_lat", 4).alias("acm_lat"),
    )


@QUERIES.query(
    f"""SELECT c_custkey, CASE WHEN c_custkey % 4 = 1 THEN -1.0 ELSE round(round({AREA_HA}, 6), 2) END AS acm_a_ha FROM ({PROJECTED})"""
)
def missing_metrics_filled(spark, sf):
    m = sp.spatial_metrics(customer_boxes(spark, sf)).withColumn(
        "acm_a_ha", F.when(F.col("c_custkey") % 4 == 1, F.lit(-1.0)).when(F.col("c_custkey") % 4 != 2, F.col("acm_a_ha"))
    )
    return sp.fill_missing_metrics(m).select("c_custkey", F.round("acm_a_ha", 2).alias("acm_a_ha"))


@QUERIES.query(
    f"""SELECT c_custkey, round({PX}, 6) AS lon, round({PY}, 6) AS lat FROM customer"""
)
def reprojected_points(spark, sf):
    """Polyconic coordinates back to longitude and latitude."""
    from workload.inputs import lat, lon

    x, y = _project("lon", "lat")
    spark_sql = lambda e: F.expr(e.replace("::DOUBLE", "D"))
    points = table(spark, sf, "customer").withColumns({"lon": lon("c_custkey"), "lat": lat("c_custkey")})
    placed = points.withColumn("geometry", g.make_point(spark_sql(x) + 5e6, spark_sql(y) + 1e7)).withColumn("srid", F.lit(5880))
    return sp.with_facts(sp.reproject(placed), "f").select(
        "c_custkey", F.round("f.minx", 6).alias("lon"), F.round("f.miny", 6).alias("lat")
    )


@QUERIES.query(
    """SELECT count(*) FILTER (c_custkey % 3 = 0) AS forced_to_2d, count(*) AS flat FROM customer"""
)
def forced_to_2d(spark, sf):
    """Every third point carries Z; after the step none does."""
    # An EWKB Z point: little endian, type 0x80000001, three doubles.
    flat = customer_points(spark, sf).filter("geometry IS NOT NULL").select("c_custkey", "geometry", "srid").unionByName(
        customer_points(spark, sf).filter("geometry IS NULL").select("c_custkey", F.lit(g.point_wkb(1.0, 2.0)).alias("geometry"), "srid")
    )
    raised = F.unhex(F.concat(F.lit("0101000080"), F.substring(F.hex("geometry"), 11, 32), F.lit("000000000000F03F")))
    mixed = flat.withColumn("geometry", F.when(F.col("c_custkey") % 3 == 0, raised).otherwise(F.col("geometry")))
    after = sp.with_facts(sp.force_2d(mixed), "f").agg(F.count_if(F.col("f.dims") == 2).alias("flat"))
    return sp.count_3d(mixed).withColumn("k", F.lit(1)).join(after.withColumn("k", F.lit(1)), "k").drop("k")


INSIDE = "x1 >= {0} AND x0 <= {2} AND y1 >= {1} AND y0 <= {3}".format(*BOX)


@QUERIES.query(f"SELECT c_custkey FROM ({BOX_SQL}) WHERE {INSIDE}")
def features_in_region(spark, sf):
    return sp.filter_to_region(customer_boxes(spark, sf)).select("c_custkey")


RX, RY = (BOX[0] + BOX[2]) / 2, (BOX[1] + BOX[3]) / 2


@QUERIES.query(
    f"""SELECT c_custkey, CASE WHEN inside THEN round((x0 + x1) / 2, 4) ELSE round({RX}, 4) END AS lon,
               CASE WHEN NOT inside THEN round({RY}, 4) END AS moved_lat, inside
        FROM (SELECT *, {INSIDE} AS inside FROM ({BOX_SQL}))"""
)
def features_relocated(spark, sf):
    moved = sp.relocate_outside(sp.spatial_metrics(customer_boxes(spark, sf)))
    facts = sp.with_facts(moved, "f")
    return facts.select(
        "c_custkey", F.round(F.col("f.centroid_x") + 0.0, 4).alias("lon"),
        F.round(sp.RELOCATED_LATITUDE, 4).alias("moved_lat"), (F.col("f.kind") != "Point").alias("inside"),
    )


@QUERIES.query(f"SELECT count(*) FILTER (NOT ({INSIDE})) AS moved FROM ({BOX_SQL})")
def moved_geometry_count(spark, sf):
    before = customer_boxes(spark, sf).withColumn("before", F.col("geometry"))
    return sp.changed_geometry_count(sp.relocate_outside(before), "before", "geometry")


@QUERIES.query(
    f"""SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN true
               ELSE {PX} * 3 BETWEEN -180 AND 180 AND {PY} * 3 BETWEEN -90 AND 90 END AS in_range FROM customer"""
)
def geographic_range(spark, sf):
    from workload.inputs import lat, lon

    points = customer_points(spark, sf).withColumn(
        "geometry", F.when(F.col("geometry").isNotNull(), g.make_point(lon("c_custkey") * 3, lat("c_custkey") * 3))
    )
    return sp.with_facts(points, "f").select(
        "c_custkey", sp.geographic_range_ok(F.col("f"), F.col("srid")).alias("in_range")
    )


@QUERIES.query("SELECT true AS measurable, 'polygon' AS geometry_kind UNION ALL SELECT false, 'point'")
def layer_kinds(spark, sf):
    """Measurable test and geometry kind of a polygon layer and a point layer."""
    parts = []
    for layer in (customer_boxes(spark, sf), customer_points(spark, sf)):
        parts.append(
            sp.has_measurable(layer).withColumn("k", F.lit(1)).join(sp.geometry_kind(layer).withColumn("k", F.lit(1)), "k").drop("k")
        )
    return parts[0].unionByName(parts[1])


ENVELOPES = ", ".join(
    f"({i}, {b[0]}::DOUBLE, {b[1]}::DOUBLE, {b[2]}::DOUBLE, {b[3]}::DOUBLE)"
    for i, b in enumerate(sp.STATE_BOUNDS.values())
)
CLIPPED = f"""
    SELECT b.*, ex0, ey0, ex1, ey1, (x0 < ex0 OR x1 > ex1 OR y0 < ey0 OR y1 > ey1) AS beyond,
           x1 >= ex0 AND x0 <= ex1 AND y1 >= ey0 AND y0 <= ey1 AS meets
    FROM ({BOX_SQL}) b JOIN (VALUES {ENVELOPES}) e(i, ex0, ey0, ex1, ey1) ON i = c_nationkey
"""


@QUERIES.query(
    f"""SELECT c_custkey, CASE WHEN beyond AND meets THEN 'clipped' WHEN beyond THEN 'outside' ELSE 'kept' END AS clip_status,
               round(CASE WHEN beyond AND meets THEN greatest(x0, ex0) ELSE x0 END, 6) AS minx,
               round(CASE WHEN beyond AND meets THEN least(y1, ey1) ELSE y1 END, 6) AS maxy
        FROM ({CLIPPED})"""
)
def clipped_to_states(spark, sf):
    states = "array(" + ",".join(f"'{s}'" for s in sp.STATE_BOUNDS) + ")[c_nationkey]"
    clipped = sp.clip_to_states(sp.spatial_metrics(customer_boxes(spark, sf)), F.expr(states))
    return sp.with_facts(clipped, "f").select(
        "c_custkey", "clip_status", F.round("f.minx", 6).alias("minx"), F.round("f.maxy", 6).alias("maxy")
    )


HITS = f"""
    SELECT c_custkey, code, name, uf, row_number() OVER (PARTITION BY c_custkey ORDER BY code, name) AS rn
    FROM ({BOX_SQL}) b JOIN ({REGION_SQL}) r ON x1 >= rx0 AND x0 <= rx1 AND y1 >= ry0 AND y0 <= ry1
"""
POINT_HITS = f"""
    SELECT c_custkey, code, name, uf, row_number() OVER (PARTITION BY c_custkey ORDER BY code) AS rn
    FROM (SELECT *, {PX} AS px, {PY} AS py FROM customer WHERE c_custkey % 11 <> 0) b
    JOIN ({REGION_SQL}) r ON px BETWEEN rx0 AND rx1 AND py BETWEEN ry0 AND ry1
"""
UF_SQL = "['RO','AC','AM','RR','PA','AP','TO',NULL,NULL,NULL,'MA','PI','CE','RN','PB','PE','AL','SE','BA',NULL,'MG','ES','RJ',NULL,'SP'][{uf}::INT - 10]"
MARK = "'Fora do limite territorial brasileiro / zona costeira'"


@QUERIES.query(
    f"""SELECT c.c_custkey, coalesce(h.code, {MARK}) AS acm_cod_munici, CASE WHEN h.code IS NULL THEN {MARK} ELSE h.name END AS acm_municipio,
               CASE WHEN h.code IS NULL THEN {MARK} WHEN h.uf IS NULL THEN 'RS'
                    ELSE coalesce({UF_SQL.format(uf='h.uf')}, h.uf) END AS acm_uf
        FROM customer c LEFT JOIN (SELECT * FROM ({POINT_HITS}) WHERE rn = 1) h ON h.c_custkey = c.c_custkey"""
)
def regions_assigned(spark, sf):
    """Point layer against regions, the UF of unnamed regions taken from the feature."""
    points = customer_points(spark, sf).withColumn("sdb_uf", F.lit("43.0"))
    out = assign_regions(points, nation_regions(spark, sf), "c_custkey")
    return out.select("c_custkey", "acm_cod_munici", "acm_municipio", "acm_uf")


@QUERIES.query(f"SELECT c_custkey, code, name, uf FROM ({HITS})")
def region_pairs(spark, sf):
    """All intersecting pairs of boxes and regions, each once."""
    return intersecting_pairs(customer_boxes(spark, sf), reference_layer(nation_regions(spark, sf)), "c_custkey")


@QUERIES.query(f"SELECT c_custkey, code, name, uf FROM ({HITS})")
def region_pairs_shuffled(spark, sf):
    """The same pairs with the salted shuffle join that replaces an oversized broadcast."""
    return intersecting_pairs(
        customer_boxes(spark, sf), reference_layer(nation_regions(spark, sf)), "c_custkey", broadcast_cells=0, hot_rows=2
    )


@QUERIES.query(
    f"""SELECT c_custkey, code, name, uf FROM (
          SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 1e9 ELSE x1 END AS x1, CASE c_custkey % 5 WHEN 1 THEN -8e7 ELSE x0 END AS x0,
                 y0, y1 FROM ({BOX_SQL})) b
        JOIN ({REGION_SQL}) r ON x1 >= rx0 AND x0 <= rx1 AND y1 >= ry0 AND y0 <= ry1"""
)
def region_pairs_of_stray_boxes(spark, sf):
    """The pairs where two boxes in five have a corner far off the map, as unprojected coordinates give it."""
    key = F.col("c_custkey")
    wide = customer_corners(spark, sf).select(
        "c_custkey",
        g.make_box(F.when(key % 5 == 1, F.lit(-8e7)).otherwise(F.col("x0")), F.col("y0"),
                   F.when(key % 5 == 0, F.lit(1e9)).otherwise(F.col("x1")), F.col("y1")).alias("geometry"),
    )
    return intersecting_pairs(wide, reference_layer(nation_regions(spark, sf)), "c_custkey")


@QUERIES.query(
    f"""SELECT s_suppkey, coalesce({UF_SQL.format(uf='(CASE WHEN k BETWEEN 11 AND 35 THEN k END)')},
               CASE WHEN s_suppkey % 2 = 0 THEN upper(x) ELSE x END) AS uf
        FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE 11 + s_suppkey % 24 END AS k,
                     CASE WHEN s_suppkey % 2 = 0 THEN 'rs' ELSE concat(11 + s_suppkey % 24, '.0') END AS x FROM supplier)"""
)
def uf_codes(spark, sf):
    x = F.when(F.col("s_suppkey") % 2 == 0, F.lit(" rs ")).otherwise(
        F.concat((F.lit(11) + F.col("s_suppkey") % 24).cast("string"), F.lit(".0"))
    )
    return table(spark, sf, "supplier").select("s_suppkey", normalize_uf(x).alias("uf"))

"""Duplicates and output quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from talweg.functions import geometry as g
from talweg.operators import duplicates as dup
from talweg.operators import quality as q
from talweg.operators.spatial import repair_geometries
from workload.inputs import Registry, spread_table, table

QUERIES = Registry()
ORACLES = QUERIES.sql
LOW = 2  # treat groups of two and more as hot, so small data takes the salted path too


@QUERIES.query(
    """SELECT doc_id, count(*) OVER (PARTITION BY text, lang) > 1 AS dup_attributes FROM documents"""
)
def attribute_duplicates(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    return dup.flag_attribute_duplicates(docs, ["text", "lang"], row_key=["doc_id"]).select("doc_id", "dup_attributes")


@QUERIES.query(
    """SELECT event_id, count(*) OVER (PARTITION BY user_id, event_type, k) > 1 AS dup_attributes
       FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN NULL ELSE props END AS k FROM events)"""
)
def attribute_duplicates_of_hot_groups(spark, sf):
    """Groups with nulls, a third of all rows sharing the null, every group salted."""
    events = table(spark, sf, "events").selectExpr(
        "event_id", "user_id", "event_type", "CASE WHEN event_id % 3 = 0 THEN NULL ELSE props END AS k"
    )
    return dup.flag_attribute_duplicates(
        events, ["user_id", "event_type", "k"], row_key=["event_id"], hot_rows=LOW
    ).select("event_id", "dup_attributes")


@QUERIES.query(
    """SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1 AS repeat FROM documents"""
)
def repeats_after_first(spark, sf):
    return dup.flag_repeats(table(spark, sf, "documents").select("doc_id", "text"), ["text"], "doc_id").select(
        "doc_id", "repeat"
    )


# Orders placed at a coarse point of their customer; every 13th has none.
POINT_SQL = "CASE WHEN o_orderkey % 13 <> 0 THEN concat(o_custkey % 300, '/', o_custkey % 7) END"


def order_points(spark, sf):
    point = g.make_point((F.col("o_custkey") % 300).cast("double"), (F.col("o_custkey") % 7).cast("double"))
    return spread_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("acm_id"), "o_orderstatus", "o_orderpriority",
        F.when(F.col("o_orderkey") % 13 != 0, point).alias("geometry"), F.lit(4326).alias("srid"),
    )


@QUERIES.query(
    f"SELECT o_orderkey AS acm_id, count(*) OVER (PARTITION BY {POINT_SQL}) > 1 AS dup_geometry FROM orders"
)
def geometric_duplicates(spark, sf):
    return dup.flag_geometric_duplicates(order_points(spark, sf)).select("acm_id", "dup_geometry")


@QUERIES.query(
    f"""SELECT acm_id, dup_registro FROM (
          SELECT o_orderkey AS acm_id, count(*) OVER (PARTITION BY {POINT_SQL}) AS n,
                 count(*) OVER (PARTITION BY o_orderstatus, o_orderpriority, o_custkey % 100) > 1 AS dup_registro
          FROM orders) WHERE n > 1"""
)
def geometric_duplicate_report(spark, sf):
    """Members of geometric groups, with the whole-record flag."""
    points = order_points(spark, sf).join(
        table(spark, sf, "orders").select(F.col("o_orderkey").alias("acm_id"), (F.col("o_custkey") % 100).alias("c")), "acm_id"
    )
    config = q.QualityConfig(attribute_duplicates=False, ogc_invalid_geometries=False)
    return q.quality_reports(points, config).geometric_duplicates.select("acm_id", "dup_registro")


@QUERIES.query(
    f"""SELECT 'attribute_duplicates' AS "check", coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS n
        FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderstatus, o_orderpriority)
        UNION ALL SELECT 'geometric_duplicates', coalesce(sum(n) FILTER (n > 1), 0)::BIGINT
        FROM (SELECT count(*) AS n FROM orders GROUP BY {POINT_SQL})
        UNION ALL SELECT 'ogc_invalid', count(*) FROM orders
        WHERE o_orderkey % 13 = 0 OR o_custkey % 300 > 180
        UNION ALL SELECT 'safe_null', count(*) FILTER (o_orderkey % 13 = 0) FROM orders"""
)
def quality_summary(spark, sf):
    flagged = order_points(spark, sf).withColumn("__internal_geom_null_safe_repair", F.col("acm_id") % 13 == 0)
    return q.quality_summary(flagged)


@QUERIES.query(
    """SELECT * FROM (VALUES ('attribute_duplicates', 0::BIGINT), ('geometric_duplicates', 0), ('ogc_invalid', 0)) t("check", n)
       UNION ALL SELECT 'safe_null', count(*) FILTER (o_orderkey % 13 = 0) FROM orders"""
)
def quality_switched_off(spark, sf):
    config = q.QualityConfig.from_profile(
        {"attribute_duplicates": False, "geometric_duplicates": False, "ogc_invalid_geometries": False, "other": 1}
    )
    flagged = order_points(spark, sf).withColumn("__internal_geom_null_safe_repair", F.col("acm_id") % 13 == 0)
    return q.quality_summary(flagged, config)


# Rings of orders by case: good, bow-tie, open, short, NaN, spike, empty, null.
def ring_cases(spark, sf):
    x, y = (F.col("o_custkey") % 100).cast("double"), (F.col("o_custkey") % 50).cast("double")
    case = F.col("o_orderkey") % 9
    nan = F.lit(float("nan"))

    def pick(square, bow, opened, short, bad, spike, far):
        return F.when(case == 1, bow).when(case == 2, opened).when(case == 3, short).when(case == 4, bad).when(
            case == 5, spike
        ).when(case == 6, F.array().cast("array<double>")).when(case == 8, far).otherwise(square)

    xs = pick(
        F.array(x, x + 1, x + 1, x, x), F.array(x, x + 1, x + 1, x, x), F.array(x, x + 1, x + 1, x),
        F.array(x, x + 1, x), F.array(x, nan, x + 1, x, x), F.array(x, x + 1, x + 2, x + 1, x + 1, x),
        F.array(x + 200, x + 201, x + 201, x + 200, x + 200),
    )
    ys = pick(
        F.array(y, y, y + 1, y + 1, y), F.array(y, y + 1, y, y + 1, y), F.array(y, y, y + 1, y + 1),
        F.array(y, y, y), F.array(y, y, y + 1, y + 1, y), F.array(y, y, y, y, y + 1, y),
        F.array(y, y, y + 1, y + 1, y),
    )
    return spread_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("acm_id"), case.alias("kind"),
        F.when(case != 7, g.make_polygon(xs, ys)).alias("geometry"), F.lit(4326).alias("srid"),
        x.alias("x"), y.alias("y"),
    )


REASONS_SQL = """
WITH o AS (SELECT o_orderkey AS acm_id, o_orderkey % 9 AS kind, (o_custkey % 100)::BIGINT AS x, (o_custkey % 50)::BIGINT AS y FROM orders),
reasons AS (SELECT acm_id, CASE kind
    WHEN 1 THEN [concat('Geometria invalida segundo OGC: Self-intersection[', x, '.5 ', y, '.5].')]
    WHEN 2 THEN ['Polygon - anel externo: anel nao esta fechado.', concat('Geometria invalida segundo OGC: Ring is not closed[', x, ' ', y, '].'),
                 'Polygon: anel externo nao esta fechado.']
    WHEN 3 THEN ['Polygon - anel externo: quantidade insuficiente de pontos (3).',
                 concat('Geometria invalida segundo OGC: Too few points in geometry component[', x, ' ', y, '].')]
    WHEN 4 THEN ['Polygon - anel externo: eixo 0 com valor invalido (nan).',
                 concat('Polygon: bounds incompativeis com o CRS geografico EPSG:4326 (minx=nan, miny=', y, '.0, maxx=nan, maxy=', y + 1, '.0).'),
                 concat('Geometria invalida segundo OGC: Invalid Coordinate[nan ', y, '].')]
    WHEN 5 THEN [concat('Geometria invalida segundo OGC: Self-intersection[', x + 2, ' ', y, '].')]
    WHEN 6 THEN ['Geometria vazia.', 'Geometria vazia.']
    WHEN 7 THEN ['Geometria nula.', 'Geometria nula.', 'Geometria nula.', 'Geometria nula.']
    WHEN 8 THEN [concat('Polygon: bounds incompativeis com o CRS geografico EPSG:4326 (minx=', x + 200, '.0, miny=', y, '.0, maxx=', x + 201, '.0, maxy=', y + 1, '.0).')]
  END AS errors FROM o WHERE kind <> 0)
"""


@QUERIES.query(REASONS_SQL + "SELECT acm_id, array_to_string(errors, ' | ') AS ogc_motivo FROM reasons")
def ogc_invalid_reasons(spark, sf):
    """Reason texts of every kind of invalid ring."""
    return q.ogc_invalid_records(ring_cases(spark, sf)).select("acm_id", "ogc_motivo")


@QUERIES.query(REASONS_SQL + "SELECT error, count(*) AS n FROM (SELECT unnest(errors) AS error FROM reasons) GROUP BY error")
def ogc_error_histogram(spark, sf):
    """Counts of all reasons."""
    return q.error_histogram(q.with_ogc_errors(ring_cases(spark, sf)))


@QUERIES.query(
    "SELECT o_orderkey AS acm_id, true AS kept, o_orderkey % 9 IN (3, 4) AS nulled FROM orders"
)
def geometries_repaired(spark, sf):
    """Bow-ties, spikes and open rings become valid; short and NaN rings become null and flagged."""
    fixed = repair_geometries(ring_cases(spark, sf))
    valid = F.size(g.ogc_errors(F.col("geometry"), F.lit(None).cast("int"))) == 0
    empty = g.geometry_facts(F.col("geometry"))["is_empty"]
    return fixed.select(
        "acm_id",
        F.coalesce(valid | empty | F.col("geometry").isNull(), F.lit(False)).alias("kept"),
        F.col("__internal_geom_null_safe_repair").alias("nulled"),
    )


def ring(x0, y0, x1, y1, back=False):
    """Corners of a box as x, y, x, y and so on, counter-clockwise or back."""
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    return F.array(*[v for c in (corners[::-1] if back else corners) for v in c])


def multi(*parts):
    return F.array(*[F.array(*part) for part in parts])


# Areas of orders by case: boxes that overlap, share an edge, are equal, hold a hole across the shell, a hole in a hole, a bow-tie beside a box.
def area_cases(spark, sf):
    x, y = (F.col("o_custkey") % 100).cast("double"), (F.col("o_custkey") % 50).cast("double")
    w = (F.col("o_orderkey") % 4 + 2).cast("double")
    d = (F.col("o_orderkey") % 7 + 1).cast("double") / 8 * w
    case = F.col("o_orderkey") % 6
    bow = F.array(x, y, x + w, y + w, x + w, y, x, y + w, x, y)
    shapes = (
        multi([ring(x, y, x + w, y + w)], [ring(x + d, y + d, x + d + w, y + d + w)]),
        multi([ring(x, y, x + w, y + w)], [ring(x + w, y, x + 2 * w, y + w, True)]),
        multi([ring(x, y, x + w, y + w)], [ring(x, y, x + w, y + w)], [ring(x + 20, y, x + 21, y + 1)]),
        multi([ring(x, y, x + w, y + w), ring(x + d, y + d, x + d + w, y + d + w)]),
        multi([ring(x, y, x + 8, y + 8), ring(x + 1, y + 1, x + 7, y + 7), ring(x + 2, y + 2, x + 3, y + 3)]),
        multi([bow], [ring(x + 10, y, x + 11, y + 1)]),
    )
    pick = F.when(case == 0, shapes[0])
    for k in range(1, 6):
        pick = pick.when(case == k, shapes[k])
    return spread_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("acm_id"), g.make_multipolygon(pick).alias("geometry"), F.lit(4326).alias("srid"),
        ((w - d) * 8).cast("int").alias("side"),
    )


@QUERIES.query(
    """SELECT acm_id, CASE k WHEN 0 THEN 2 * w * w - (w - d) * (w - d) WHEN 1 THEN 2 * w * w WHEN 2 THEN w * w + 1
                             WHEN 3 THEN w * w - (w - d) * (w - d) WHEN 4 THEN 64 - 36 ELSE w * w / 4 + 1 END::DOUBLE AS area,
              CASE k WHEN 0 THEN w + d WHEN 1 THEN 2 * w WHEN 2 THEN 21 WHEN 3 THEN w WHEN 4 THEN 8 ELSE 11 - w / 2 END::DOUBLE AS width, true AS sound, false AS nulled
       FROM (SELECT o_orderkey AS acm_id, o_orderkey % 6 AS k, (o_orderkey % 4 + 2)::DOUBLE AS w,
                    (o_orderkey % 7 + 1)::DOUBLE / 8 * (o_orderkey % 4 + 2) AS d FROM orders)"""
)
def areas_repaired(spark, sf):
    """Area, width and soundness of repaired multipolygons: unions count once, holes are cut out, of a bow-tie the lobe with the top corner stays."""
    fixed = repair_geometries(area_cases(spark, sf))
    facts = g.geometry_facts(F.col("geometry"))
    return fixed.select(
        "acm_id", F.round(g.planar_area("geometry"), 9).alias("area"), (facts["maxx"] - facts["minx"]).alias("width"),
        (F.size(g.ogc_errors(F.col("geometry"), F.lit(None).cast("int"))) == 0).alias("sound"),
        F.col("__internal_geom_null_safe_repair").alias("nulled"),
    )


# Multipolygons with holes of orders: most are valid, one in twenty has a hole outside, a shell inside another or holes inside each other.
def multipart_cases(spark, sf):
    x, y = (F.col("o_custkey") % 100).cast("double"), (F.col("o_custkey") % 50).cast("double")
    shell, hole, island = ring(x, y, x + 8, y + 8), ring(x + 1, y + 1, x + 5, y + 5), ring(x + 2, y + 2, x + 4, y + 4)
    far, beside = ring(x + 10, y, x + 12, y + 2), ring(x + 6, y + 1, x + 7, y + 2)
    case = F.col("o_orderkey") % 60
    shape = F.when(case == 0, multi([shell, far], [ring(x + 20, y, x + 21, y + 1)])).when(
        case == 20, multi([shell, beside], [island])
    ).when(case == 40, multi([far], [shell, hole, island])).when(
        F.col("o_orderkey") % 2 == 0, multi([shell, hole, beside], [island], [far])
    ).otherwise(multi([shell, hole], [far]))
    return spread_table(spark, sf, "orders").select(F.col("o_orderkey").alias("acm_id"), g.make_multipolygon(shape).alias("geometry"), F.lit(4326).alias("srid"))


@QUERIES.query(
    """WITH o AS (SELECT o_orderkey AS acm_id, o_orderkey % 60 AS k, (o_custkey % 100)::BIGINT AS x, (o_custkey % 50)::BIGINT AS y FROM orders),
            r AS (SELECT acm_id, k, CASE k WHEN 0 THEN concat('Hole lies outside shell[', x + 10, ' ', y, ']')
                                           WHEN 20 THEN concat('Nested shells[', x + 2, ' ', y + 2, ']')
                                           WHEN 40 THEN concat('Holes are nested[', x + 2, ' ', y + 2, ']') END AS reason FROM o WHERE k % 20 = 0)
       SELECT acm_id, concat('Geometria invalida segundo OGC: ', reason, '.',
                             CASE k WHEN 0 THEN concat(' | MultiPolygon[1]: Geometria invalida segundo OGC: ', reason, '.')
                                    WHEN 40 THEN concat(' | MultiPolygon[2]: Geometria invalida segundo OGC: ', reason, '.') ELSE '' END) AS ogc_motivo FROM r"""
)
def multipart_invalid_reasons(spark, sf):
    """Reasons of the few multipolygons whose rings are misplaced."""
    return q.ogc_invalid_records(multipart_cases(spark, sf)).select("acm_id", "ogc_motivo")


@QUERIES.query(
    """SELECT o_orderkey AS acm_id, array_to_string(list_filter([
           CASE WHEN s = 0 THEN 'SRID ausente. Esperado: 4674.' WHEN s <> 4674 THEN concat('SRID incompativel. Atual: ', s, '. Esperado: 4674.') END,
           CASE WHEN n THEN 'CRS ausente. Esperado: EPSG:4674.' WHEN s <> 4674 THEN concat('CRS incompativel. Atual: EPSG:', s, '. Esperado: EPSG:4674.') END],
           lambda e: e IS NOT NULL), ' | ') AS ogc_motivo
       FROM (SELECT *, CASE o_orderkey % 4 WHEN 0 THEN 4674 WHEN 1 THEN 4326 WHEN 2 THEN 0 ELSE 0 END AS s, o_orderkey % 4 = 3 AS n FROM orders)
       WHERE o_orderkey % 4 <> 0 AND o_orderkey % 13 <> 0
       UNION ALL SELECT o_orderkey, 'Geometria nula. | Geometria nula. | Geometria nula. | Geometria nula.' FROM orders WHERE o_orderkey % 13 = 0"""
)
def reference_system_expectations(spark, sf):
    """Points in the expected system, another one, the unset one and none."""
    points = order_points(spark, sf).withColumn("geometry", F.when(F.col("geometry").isNotNull(), g.make_point(F.lit(1.0), F.lit(1.0))))
    case = F.col("acm_id") % 4
    srids = points.withColumn("srid", F.when(case == 0, F.lit(4674)).when(case == 1, F.lit(4326)).when(case == 2, F.lit(0)))
    return q.ogc_invalid_records(srids, expected_srid=4674, expected_crs="EPSG:4674").select("acm_id", "ogc_motivo")


@QUERIES.query("SELECT o_orderkey AS acm_id, o_orderkey % 3 = 0 AS turned, true AS standard FROM orders")
def rings_oriented(spark, sf):
    """Boxes with a hole, in three orientations, all end counter-clockwise with clockwise holes."""
    x, y = (F.col("o_custkey") % 100).cast("double"), (F.col("o_custkey") % 50).cast("double")

    def shape(shell_back, hole_back):
        return g.make_multipolygon(multi([ring(x, y, x + 4, y + 4, shell_back), ring(x + 1, y + 1, x + 2, y + 2, hole_back)]))

    case = F.col("o_orderkey") % 3
    cases = spread_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("acm_id"), shape(False, True).alias("standard"),
        F.when(case == 0, shape(True, False)).when(case == 1, shape(False, True)).otherwise(shape(False, True)).alias("geometry"),
    )
    return cases.select(
        "acm_id", (F.col("geometry") != F.col("standard")).alias("turned"), (g.normalize_geometry("geometry") == F.col("standard")).alias("standard")
    )

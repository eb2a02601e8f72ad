"""Feature tables, rules and control rows derived from the given tables.

Every derivation is row by row over a whole table; the same expressions appear in
the SQL texts, so both sides see the same input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talweg.functions import geometry as g
from talweg.sources.tables import scan


class Registry(dict):
    """Collects query functions by name, and their SQL texts."""

    def __init__(self):
        super().__init__()
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None):
        def add(function):
            self[function.__name__] = function
            if sql is not None:
                self.sql[function.__name__] = sql
            return function

        return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan(spark, f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table about to carry geometries: over all cores even when it is one small file."""
    return scan(spark, f"{sf_dir}/{name}.parquet", spread=True)


def rows(spark: SparkSession, ddl: str, *values) -> DataFrame:
    """A small rule table."""
    return spark.createDataFrame(list(values), ddl)


# Longitude and latitude of a key, over (and beyond) the region of interest.
LON_SQL = "(-76 + (({k} * 37) % 5300) / 100.0)"
LAT_SQL = "(-38 + (({k} * 53) % 4900) / 100.0)"


def lon(key: str) -> Column:
    return F.expr("cast(" + LON_SQL.format(k=key).replace("100.0", "100.0D") + " as double)")


def lat(key: str) -> Column:
    return F.expr("cast(" + LAT_SQL.format(k=key).replace("100.0", "100.0D") + " as double)")


def customer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as points; every 11th has no geometry."""
    points = g.make_point(lon("c_custkey"), lat("c_custkey"))
    return spread_table(spark, sf_dir, "customer").withColumn(
        "geometry", F.when(F.col("c_custkey") % 11 != 0, points)
    ).withColumn("srid", F.lit(4326))


# Boxes of customers: lower-left corner at the point, sides of 0.05 to 1 degree.
BOX_SQL = """
    SELECT c.*, x0, y0, x0 + (1 + c_custkey % 20) / 20.0::DOUBLE AS x1,
           y0 + (1 + c_custkey % 13) / 20.0::DOUBLE AS y1
    FROM (SELECT *, {lon}::DOUBLE AS x0, {lat}::DOUBLE AS y0 FROM customer) c
""".format(lon=LON_SQL.format(k="c_custkey"), lat=LAT_SQL.format(k="c_custkey"))


def customer_corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    corners = spread_table(spark, sf_dir, "customer").withColumns({"x0": lon("c_custkey"), "y0": lat("c_custkey")})
    return corners.withColumns(
        {
            "x1": F.expr("x0 + (1 + c_custkey % 20) / 20.0D"),
            "y1": F.expr("y0 + (1 + c_custkey % 13) / 20.0D"),
        }
    )


def customer_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = customer_corners(spark, sf_dir)
    shape = g.make_box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
    return boxes.withColumn("geometry", shape).withColumn("srid", F.lit(4326))


# Nations as a 5 x 5 grid of boxes that leaves the south-east free.
def nation_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    x = F.expr("cast(-74 + (n_nationkey % 5) * 9 as double)")
    y = F.expr("cast(-34 + floor(n_nationkey / 5) * 8 as double)")
    return n.select(
        F.format_string("%07d", "n_nationkey").alias("cd_mun"), F.col("n_name").alias("nm_mun"),
        F.when(F.col("n_nationkey") % 4 != 0, (F.col("n_nationkey") + 11).cast("string")).alias("cd_uf"),
        g.make_box(x, y, x + 8.5, y + 8.0).alias("geometry"),
    )


REGION_SQL = """
    SELECT printf('%07d', n_nationkey) AS code, n_name AS name,
           CASE WHEN n_nationkey % 4 <> 0 THEN (n_nationkey + 11)::VARCHAR END AS uf,
           (-74 + (n_nationkey % 5) * 9)::DOUBLE AS rx0, (-34 + (n_nationkey // 5) * 8)::DOUBLE AS ry0,
           (-74 + (n_nationkey % 5) * 9)::DOUBLE + 8.5 AS rx1, (-34 + (n_nationkey // 5) * 8)::DOUBLE + 8.0 AS ry1
    FROM nation
"""


# Lowest region code at the position of a customer key.
POINT_BOXES_SQL = (
    "SELECT k, min(code) AS code FROM (SELECT DISTINCT o_custkey AS k, {x} AS px, {y} AS py FROM orders) p JOIN ("
    + REGION_SQL
    + ") r ON px BETWEEN rx0 AND rx1 AND py BETWEEN ry0 AND ry1 GROUP BY k"
)


def control_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as control rows with good and bad statuses, paths, themes and metadata."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "cast(s_suppkey as int) AS ID",
        f"{THEME_CASE} AS theme_folder",
        f"{STATUS_CASE} AS status",
        f"{PATH_CASE} AS path_shapefile_temp",
        "CASE WHEN s_suppkey % 17 = 3 THEN ' ' ELSE 'restricted' END AS access_constraints",
        "'pcd' AS category_acronym",
        "CASE WHEN s_suppkey % 19 = 4 THEN 'A/B' ELSE concat('SRC_', cast(s_nationkey as string)) END AS citation",
        f"{DATE_CASE} AS date",
    )


THEME_CASE = """CASE s_suppkey % 7
    WHEN 0 THEN 'app_car_ac' WHEN 1 THEN ' RL  Car_am ' WHEN 2 THEN 'estado' WHEN 3 THEN 'unknown_theme'
    WHEN 4 THEN 'shared' WHEN 5 THEN 'autos_infracao' ELSE 'loc_br' END"""
STATUS_CASE = """CASE s_suppkey % 6
    WHEN 0 THEN 'treatment' WHEN 1 THEN 'Download-Treatment-publish' WHEN 2 THEN 'download'
    WHEN 3 THEN 'download-review' WHEN 4 THEN 'treatment; schedule 2026-05-13 18:49'
    ELSE 'publish, treatment' END"""
PATH_CASE = """CASE s_suppkey % 5
    WHEN 0 THEN '/in/a.gpkg' WHEN 1 THEN '/in/b.ZIP' WHEN 2 THEN '  ' ELSE concat('/in/', s_name, '.gpkg') END"""
DATE_CASE = """CASE s_suppkey % 4
    WHEN 0 THEN '20210915' WHEN 1 THEN '2021-09-15' WHEN 2 THEN '31/12/2020' ELSE '05/06/2020' END"""

CONTROL_SQL = f"""
    SELECT s_suppkey::INT AS ID, {THEME_CASE} AS theme_folder, {STATUS_CASE} AS status,
           {PATH_CASE} AS path,
           CASE WHEN s_suppkey % 17 = 3 THEN ' ' ELSE 'restricted' END AS access_constraints,
           'pcd' AS category_acronym,
           CASE WHEN s_suppkey % 19 = 4 THEN 'A/B' ELSE concat('SRC_', s_nationkey::VARCHAR) END AS citation,
           {DATE_CASE} AS date
    FROM supplier
"""
THEME_KEY_SQL = r"lower(regexp_replace(regexp_replace(trim({c}), '[\s_]+', '_', 'g'), '^_+|_+$', '', 'g'))"

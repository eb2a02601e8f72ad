"""What has to stay small while tables grow: plans, candidates, Python workers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from talweg.functions import geometry as g
from talweg.functions import shapes as sh
from talweg.operators import spatial as sp
from talweg.operators import spatial_join as sj
from talweg.operators.dictionary import attribute_types
from talweg.operators.fuzzy import candidate_pairs
from talweg.operators.mining import generate_domain
from talweg.operators.scale import stage
from talweg.plans.treatment import mandatory_treatments, treat
from talweg.sources.rules import rule_tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_attribute_types_send_no_side_through_the_driver(spark):
    fields = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (None, "a"), (3, "b")], "layer long, field string")
    types = spark.createDataFrame(
        [(1, "x_a", "t"), (2, "x_a", "t"), (2, "y_a", "u"), (None, "a", "v"), (3, "sdb_b", "w"), (3, "b", None), (4, "a", "z")],
        "layer long, name string, type string",
    )
    out = attribute_types(fields, types)
    assert sorted(out.collect(), key=str) == sorted([(1, "a", "t"), (2, "a", ""), (None, "a", ""), (3, "b", "")], key=str)
    layers = spark.range(50).selectExpr("id AS layer")  # of known size, so the planner would broadcast it
    few = attribute_types(layers.selectExpr("layer", "explode(array('a', 'b')) AS field"), layers.selectExpr("layer", "'x_a' AS name", "'t' AS type"))
    assert "BroadcastExchange" not in plan(few)
    assert few.filter("type = 't'").count() == 50 and few.count() == 100


def test_candidates_of_texts_over_few_letters_stay_near_the_number_of_texts(spark):
    """Hashes hold every gram of two digits, so grams alone made nearly all pairs candidates."""
    names = spark.range(3000).selectExpr("id", "upper(md5(cast(id div 3 AS string)) || substring('XY', 1, cast(id % 3 AS int))) AS text")
    pairs = {(r.a_id, r.b_id) for r in candidate_pairs(names).collect()}
    own = {(3 * k + i, 3 * k + j) for k in range(1000) for i, j in ((0, 1), (0, 2), (1, 2))}
    assert own <= pairs and len(pairs) < 1.01 * len(own)


def test_a_geometry_takes_one_python_worker_in_the_mandatory_treatments(spark):
    layer = spark.range(3).select(g.make_point(F.col("id") * 1.0, F.col("id") * 1.0).alias("geometry"), F.lit(4674).alias("srid"))
    staged = stage(layer)
    assert plan(mandatory_treatments(staged)).count("ArrowEvalPython") == 1


def test_inputs_are_spread_by_bytes(spark, monkeypatch):
    from talweg.sources import tables

    monkeypatch.setattr(tables, "SPREAD_BYTES", 1024, raising=False)
    df = tables.scan(spark, "/root/testdata/sf0.001/orders.parquet", spread=True)
    assert df.rdd.getNumPartitions() > spark.sparkContext.defaultParallelism


def test_canonical_texts_are_tested_once_for_each_distinct_text(spark):
    names = spark.range(10).selectExpr("concat('x ', id % 2) AS v")
    found = generate_domain(names, "v")
    assert "Range" not in plan(found)  # only the written distinct texts are read
    assert sorted(r.value for r in found.collect()) == ["x 0", "x 1"]


def test_polygons_of_a_batch_meet_without_a_look_at_each_row(monkeypatch):
    rng = np.random.default_rng(3)
    corners = lambda n: [g.box_wkb(x, y, x + w, y + h) for x, y, w, h in rng.integers(0, 12, (n, 4)) + [0, 0, 1, 1]]
    hole = sh.write_tree(sh.POLYGON, [np.array([[0, 0], [12, 0], [12, 12], [0, 12], [0, 0.0]]), np.array([[1, 1], [1, 11], [11, 11], [11, 1], [1, 1.0]])])
    left = [None, g.point_wkb(5, 5), g.point_wkb(0, 6), sh.write_tree(sh.POLYGON, []), *corners(400)]
    right = [hole if i % 7 < 4 else w for i, w in enumerate(corners(len(left)))]
    wanted = [None if w is None else bool(g.trees_intersect(sh.read_tree(w)[0], sh.read_tree(r)[0])) for w, r in zip(left, right)]
    columns = pa.array(left, pa.binary()), pa.array(right, pa.binary())
    assert len(set(wanted)) == 3
    monkeypatch.setattr(g, "PAIRS", 10, raising=False)  # each row is too large
    assert g.intersects.func(*columns).to_pylist() == wanted
    monkeypatch.setattr(g, "PAIRS", 100)
    monkeypatch.setattr(g, "trees_intersect", None)
    assert g.intersects.func(*columns).to_pylist() == wanted


def test_equal_geometries_of_a_batch_are_checked_once(monkeypatch):
    bow = sh.write_tree(sh.POLYGON, [np.array([[0, 0], [1, 1], [1, 0], [0, 1], [0, 0.0]])])
    rows = [bow, g.box_wkb(0, 0, 1, 1), None, bow, g.box_wkb(300, 0, 301, 1), bow, None, g.box_wkb(300, 0, 301, 1)]
    crs, geographic = ["EPSG:4326"] * 5 + ["EPSG:5880", None, "EPSG:5880"], [True] * 5 + [False] * 3
    plain, looked = g.validity.ogc_errors, []
    wanted = [plain(*row) for row in zip(rows, crs, geographic)]
    monkeypatch.setattr(g.validity, "ogc_errors", lambda *row: looked.append(row) or plain(*row))
    assert g._errors(pa.array(rows, pa.binary()), pa.array(crs), pa.array(geographic)).to_pylist() == wanted
    assert wanted[1] == wanted[7] == [] and len(looked) == len(set(looked)) == 5


def test_a_treatment_computes_its_input_once(spark):
    """Schema tests, sampling and the shuffle of the order each computed it again."""
    looked = spark.sparkContext.accumulator(0)

    def counted(x: pa.Array) -> pa.Array:
        looked.add(len(x))
        return sh.write_points(np.asarray(x.cast(pa.float64())), np.zeros(len(x)))

    layer = spark.range(200).select(F.col("id").alias("k"), F.arrow_udf(counted, "binary")("id").alias("geometry"), F.lit(4674).alias("srid"))
    rules = rule_tables(spark.createDataFrame([("p", "profile.json", '{"profile_name": "p"}')], "profile string, component string, body string"))
    result = treat(layer, rules, "p", ["k"])
    assert result.data.count() == 200 and looked.value == 200
    assert "ArrowEvalPython" not in plan(result.data)  # no row lacks a metric


def test_a_clip_takes_one_python_function(spark):
    layer = stage(spark.range(3).select(g.make_point(F.col("id") - 45.0, F.col("id") * 1.0).alias("geometry"), F.lit(0.5).alias("acm_long")))
    assert plan(sp.clip_to_states(layer, "ma")).count("ArrowEvalPython") == 1


def test_features_in_one_cell_find_their_region_there(spark, monkeypatch):
    rng = np.random.default_rng(11)
    corners = np.array([[0, 0], [8, 0], [8, 2.5], [2.5, 2.5], [2.5, 7], [0, 7], [0, 0.0]])
    shapes = [sh.write_tree(sh.POLYGON, [corners]), g.box_wkb(1.25, 1.25, 7.5, 9), g.box_wkb(-9, -9, -1, 1), g.box_wkb(6.3, 6.1, 6.4, 6.2), g.box_wkb(-30, -30, 30, -8)]
    codes = ["3", "2", None, "1", "4"]
    schema = "cd_mun string, nm_mun string, cd_uf string, geometry binary"
    regions = spark.createDataFrame([(c, f"n{i}", None, w) for i, (c, w) in enumerate(zip(codes, shapes))], schema)
    at = rng.uniform(-12, 12, (600, 2)).round(1)
    sizes = rng.choice([0.01, 0.3, 5.0], (600, 2))
    features = [g.point_wkb(x, y) if i % 2 else g.box_wkb(x, y, x + w, y + h) for i, ((x, y), (w, h)) in enumerate(zip(at, sizes))]
    features += [None, sh.write_tree(sh.POLYGON, []), g.point_wkb(float("nan"), 1.0), g.point_wkb(2.5, 2.5), g.point_wkb(0, 0), g.box_wkb(-40, -40, 40, 40)]
    layer = spark.createDataFrame(list(enumerate(features)), "id int, geometry binary")
    columns = ["id", "acm_cod_munici", "acm_municipio", "acm_uf"]
    wanted = sj.assign_regions(layer, regions, "id", broadcast_cells=0).select(columns).orderBy("id").collect()
    paired, plain = [], sj._touching_tiles
    monkeypatch.setattr(sj, "_touching_tiles", lambda rows, *rest: paired.append(rows.count()) or plain(rows, *rest))
    assert sj.assign_regions(layer, regions, "id").select(columns).orderBy("id").collect() == wanted
    assert paired[0] < 0.7 * len(features) and len({r.acm_municipio for r in wanted}) == 5  # a region without code counts as none

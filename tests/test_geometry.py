import math
import random
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from talweg.functions import geometry as g
from talweg.functions import projection as pr
from talweg.functions import shapes as sh
from talweg.functions import topology as tp
from talweg.functions import validity as va
from talweg.operators import spatial as sp
from talweg.operators import spatial_join as sj


def polygon(*rings):
    return sh.write_tree(sh.POLYGON, [np.array(r, float) for r in rings])


def multi(*polygons):
    return sh.write_tree(sh.MULTIPOLYGON, [sh.read_tree(p)[0] for p in polygons])


def line(*points):
    return sh.write_tree(sh.LINE, np.array(points, float))


SQUARE = g.box_wkb(0, 0, 4, 4)
HOLED = polygon([(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (1, 3), (3, 3), (3, 1), (1, 1)])
BOWTIE = polygon([(0, 0), (1, 1), (1, 0), (0, 1), (0, 0)])


def frame(spark, *wkbs, srid=4326):
    return spark.createDataFrame([(i, w, srid) for i, w in enumerate(wkbs)], "id int, geometry binary, srid int")


def test_facts_of_every_kind(spark):
    ewkb_z = struct.pack("<BI3d", 1, 0x80000001, 1.0, 2.0, 3.0)
    big_endian = struct.pack(">BI2d", 0, 1, 5.0, 6.0)
    rows = sp.with_facts(frame(spark, SQUARE, HOLED, None, ewkb_z, big_endian, polygon(), line((0, 0), (3, 4)),
                               multi(SQUARE, g.box_wkb(10, 0, 12, 2)), g.point_wkb(float("inf"), 0)), "f").orderBy("id").collect()
    facts = [r.f for r in rows]
    assert [f.kind for f in facts] == ["Polygon", "Polygon", None, "Point", "Point", "Polygon", "LineString", "MultiPolygon", "Point"]
    assert facts[3].dims == 3 and (facts[4].minx, facts[4].maxy) == (5.0, 6.0)
    assert facts[5].is_empty and not facts[5].finite and facts[5].minx is None
    assert not facts[2].finite and facts[2].is_empty is None and not facts[8].finite
    assert (facts[1].centroid_x, facts[6].centroid_x, facts[6].centroid_y) == (2.0, 1.5, 2.0)
    assert facts[7].centroid_x == pytest.approx((2 * 16 + 11 * 4) / 20)


def test_projection_matches_scale_and_inverts():
    rng = np.random.default_rng(1)
    lonlat = np.stack([rng.uniform(-74, -30, 200), rng.uniform(-34, 6, 200)], axis=1)
    assert np.abs(pr.inverse_polyconic(pr.polyconic(lonlat)) - lonlat).max() < 1e-9
    metre = pr.polyconic(np.array([[-54.0, -10.0], [-54.0, -10.0 + 1e-4]]))
    radius = pr.SEMI_MAJOR * (1 - pr._E2) / (1 - pr._E2 * math.sin(math.radians(10)) ** 2) ** 1.5
    assert metre[1, 1] - metre[0, 1] == pytest.approx(math.radians(1e-4) * radius, rel=1e-6)


def test_metrics_only_for_shapes_with_extent(spark):
    box = g.box_wkb(-47, -15, -46.9, -14.9)
    row = sp.spatial_metrics(frame(spark, box)).first()
    sphere = (0.1 * 111.32) ** 2 * math.cos(math.radians(14.95)) * 100
    assert row.acm_a_ha == pytest.approx(sphere, rel=0.02)
    assert (row.acm_long, row.acm_lat) == (-46.95, -14.95)
    point = frame(spark, g.point_wkb(-47, -15))
    assert not sp.has_measurable(point).first().measurable
    assert "acm_a_ha" not in sp.spatial_metrics(point, measure=False).columns


def test_reasons(spark):
    cases = {
        BOWTIE: "Geometria invalida segundo OGC: Self-intersection[0.5 0.5].",
        polygon([(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(5, 5), (6, 5), (6, 6), (5, 5)]):
            "Geometria invalida segundo OGC: Hole lies outside shell[5 5].",
        multi(SQUARE, g.box_wkb(1, 1, 2, 2)): "Geometria invalida segundo OGC: Nested shells[1 1].",
        line((1, 1), (1, 1)): "LineString: precisa de pelo menos 2 pontos distintos.",
        g.point_wkb(float("nan"), 1.0): "Point: eixo 0 com valor invalido (nan).",
        g.box_wkb(170, 0, 190, 1): "Polygon: bounds incompativeis com o CRS geografico EPSG:4326 (minx=170.0, miny=0.0, maxx=190.0, maxy=1.0).",
    }
    rows = frame(spark, *cases).select("id", g.ogc_errors(F.col("geometry"), F.col("srid")).alias("e")).orderBy("id").collect()
    for row, wanted in zip(rows, cases.values()):
        assert wanted in row.e
    good = frame(spark, SQUARE, HOLED, multi(SQUARE, g.box_wkb(4, 4, 5, 5)), line((0, 0), (1, 1)), g.point_wkb(0, 0))
    assert all(not r.e for r in good.select(g.ogc_errors(F.col("geometry"), F.col("srid")).alias("e")).collect())
    expected = frame(spark, SQUARE).select(g.ogc_errors(F.col("geometry"), F.col("srid"), 4674, "EPSG:4674").alias("e")).first().e
    assert expected == ["SRID incompativel. Atual: 4326. Esperado: 4674.", "CRS incompativel. Atual: EPSG:4326. Esperado: EPSG:4674."]


def star(rng, n, centre=(0, 0)):
    """A random simple polygon: vertices sorted by angle."""
    angles = np.sort(rng.uniform(0, 2 * np.pi, n))
    radius = rng.uniform(1, 3, n)
    ring = np.stack([centre[0] + radius * np.cos(angles), centre[1] + radius * np.sin(angles)], axis=1)
    return np.concatenate([ring, ring[:1]])


def test_batch_and_single_validity_agree():
    rng = np.random.default_rng(3)
    rings = [star(rng, int(rng.integers(3, 90))) for _ in range(60)]
    rings += [rng.uniform(0, 1, (int(rng.integers(4, 9)), 2)) for _ in range(120)]
    rings = [r if (r[0] == r[-1]).all() else np.concatenate([r, r[:1]]) for r in rings]
    batch = sh.read_shapes(pa.array([polygon(r) for r in rings]))
    quick = va.quick_valid(batch, np.zeros(len(rings), bool))
    single = [va.invalid_reason((sh.POLYGON, 2, [r])) is None for r in rings]
    assert [q for q in quick] == single


def test_clip_keeps_exactly_the_part_inside():
    rng = np.random.default_rng(5)
    probes = rng.uniform(-3, 3, (800, 2))
    for _ in range(80):
        ring = star(rng, int(rng.integers(4, 20)))
        low = rng.uniform(-3, 1, 2)
        box = (*low, *(low + rng.uniform(0.5, 3, 2)))
        parts = tp.clip_polygon([ring], box)
        inside = (tp.locate(probes, [ring]) > 0) & (probes[:, 0] > box[0]) & (probes[:, 0] < box[2]) & (
            probes[:, 1] > box[1]) & (probes[:, 1] < box[3])
        got = np.zeros(len(probes), bool)
        for part in parts:
            got |= tp.locate(probes, part) > 0
        assert (got == inside).all()
    holed = tp.clip_polygon([r for r in sh.read_tree(HOLED)[0][2]], (-1, -1, 2, 5))
    assert sum(tp.ring_area(r) for part in holed for r in part) == pytest.approx(6.0)


def test_clip_to_states(spark):
    inside_and_far = multi(g.box_wkb(-45, -5, -44, -4), g.box_wkb(-45, 83, -44, 84))
    layer = frame(spark, inside_and_far, g.box_wkb(0, 50, 1, 51), g.box_wkb(-45, -5, -44, -4), None)
    rows = sp.with_facts(sp.clip_to_states(layer, "ma"), "f").orderBy("id").collect()
    assert [r.clip_status for r in rows] == ["clipped", "outside", "kept", "kept"]
    assert rows[0].f.maxy == -4 and rows[0].f.kind == "Polygon" and rows[1].f.maxy == 51
    assert [r.clip_status for r in sp.clip_to_states(layer, "zz").collect()] == ["kept"] * 4


def test_repair(spark):
    spike = polygon([(0, 0), (2, 0), (4, 0), (2, 0), (2, 2), (0, 0)])
    crossing = polygon([(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(3, 1), (6, 1), (6, 2), (3, 2), (3, 1)])
    broken = g.point_wkb(float("nan"), 1.0)
    touching = polygon([(0, 0), (0, 2), (1, 1), (2, 2), (2, 0), (1, 1), (0, 0)])
    layer = frame(spark, SQUARE, BOWTIE, spike, crossing, broken, None, touching)
    rows = sp.repair_geometries(layer).orderBy("id").collect()
    flags = [r["__internal_geom_null_safe_repair"] for r in rows]
    assert flags == [False, False, False, False, True, False, False]
    assert bytes(rows[0].geometry) == SQUARE and rows[4].geometry is None and rows[5].geometry is None
    assert sum(tp.ring_area(r) for r in sh.read_tree(bytes(rows[3].geometry))[0][2]) == 15.0
    for i in (1, 2, 3, 6):
        assert va.invalid_reason(sh.read_tree(bytes(rows[i].geometry))[0]) is None
    assert sh.read_tree(bytes(rows[6].geometry))[0][0] == sh.MULTIPOLYGON
    again = sp.repair_geometries(sp.repair_geometries(layer).drop("__internal_geom_null_safe_repair"))
    assert [r.geometry for r in again.orderBy("id").collect()] == [r.geometry for r in rows]


def test_normalize_orients(spark):
    clockwise = polygon([(0, 0), (0, 1), (1, 1), (1, 0), (0, 0)])
    out = frame(spark, clockwise).select(g.normalize_geometry(F.col("geometry")).alias("w")).first().w
    assert tp.ring_area(sh.read_tree(bytes(out))[0][2][0]) == 1.0


def test_region_filter_and_relocation(spark):
    layer = frame(spark, g.point_wkb(-70, -9), g.point_wkb(0, 50), None)
    assert [r.id for r in sp.filter_to_region(layer).collect()] == [0]
    rows = sp.relocate_outside(sp.spatial_metrics(layer, measure=False)).orderBy("id").collect()
    x, y = sp.Region().anchor()
    assert rows[0].acm_long == -70 and rows[0].acm_long_centroide_brasil is None
    assert rows[1].acm_long == rows[1].acm_long_centroide_brasil == round(x, 6)
    assert bytes(rows[1].geometry) == g.point_wkb(x, y) and rows[2].geometry is None
    letter_c = polygon([(0, 0), (6, 0), (6, 1), (1, 1), (1, 5), (6, 5), (6, 6), (0, 6), (0, 0)])
    region = sp.Region.of_polygon(letter_c)
    assert tp.locate(np.array([region.anchor()]), [sh.read_tree(letter_c)[0][2][0]])[0] > 0
    picked = sp.filter_to_region(frame(spark, g.point_wkb(3, 3), g.point_wkb(0.5, 3), g.box_wkb(2, 2, 9, 9)), region)
    assert sorted(r.id for r in picked.collect()) == [1, 2]


def regions(spark, *rows):
    return spark.createDataFrame(list(rows), "sdb_cd_mun string, sdb_nm_mun string, sdb_cd_uf string, geometry binary")


def test_region_join_cases(spark):
    unit = g.box_wkb(0, 0, 1, 1)
    layer = frame(spark, g.point_wkb(0.5, 0.5), g.point_wkb(10, 10), g.point_wkb(1, 1)).withColumn("sdb_uf", F.lit("RS"))
    rows = sj.assign_regions(layer, regions(spark, ("1234567", "Certo", "11", unit)), "id").orderBy("id").collect()
    assert (rows[0].acm_cod_munici, rows[0].acm_municipio, rows[0].acm_uf) == ("1234567", "Certo", "RO")
    assert rows[1].acm_cod_munici == rows[1].acm_municipio == rows[1].acm_uf == sj.NO_MATCH
    assert rows[2].acm_cod_munici == "1234567"
    no_uf = sj.assign_regions(layer, regions(spark, ("1", "x", None, unit)), "id").orderBy("id").first()
    assert no_uf.acm_uf == "RS"
    with pytest.raises(ValueError, match="'code'.*'uf'"):
        sj.reference_layer(spark.createDataFrame([("x", b"")], "nm_mun string, geometry binary"))


@pytest.mark.parametrize("options", [{}, {"broadcast_cells": 0, "hot_rows": 2}])
def test_region_pairs_equal_brute_force(spark, options):
    rng = np.random.default_rng(11)
    areas = [polygon(star(rng, 9, rng.uniform(-20, 20, 2))) for _ in range(25)] + [polygon(star(rng, 30) * 9)]
    shapes = [g.point_wkb(*rng.uniform(-20, 20, 2)) for _ in range(120)]
    shapes += [polygon(star(rng, 6, rng.uniform(-20, 20, 2))) for _ in range(40)]
    shapes += [line(*rng.uniform(-20, 20, (3, 2))) for _ in range(20)] + [g.box_wkb(-40, -40, 40, 40)]
    trees, targets = [sh.read_tree(w)[0] for w in shapes], [sh.read_tree(w)[0] for w in areas]
    wanted = {(i, f"{j:03d}") for i, a in enumerate(trees) for j, b in enumerate(targets) if g.trees_intersect(a, b)}
    reference = sj.reference_layer(regions(spark, *[(f"{j:03d}", "n", "11", w) for j, w in enumerate(areas)]))
    pairs = sj.intersecting_pairs(frame(spark, *shapes), reference, "id", **options).collect()
    assert len(pairs) == len(wanted) and {(p.id, p.code) for p in pairs} == wanted


def test_points_in_areas_by_sampling():
    """The exact test agrees with an independent winding-number test."""
    rng = random.Random(2)
    ring = star(np.random.default_rng(9), 40)
    for _ in range(300):
        p = (rng.uniform(-3, 3), rng.uniform(-3, 3))
        angle = 0.0
        for a, b in zip(ring[:-1], ring[1:]):
            angle += math.remainder(math.atan2(b[1] - p[1], b[0] - p[0]) - math.atan2(a[1] - p[1], a[0] - p[0]), 2 * math.pi)
        assert (abs(angle) > math.pi) == (tp.locate(np.array([p]), [ring])[0] > 0)

"""Whole-batch geometry work against row-by-row versions: reading, writing, validity, repair, clipping, projection."""

import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from talweg.functions import arrange, sweep
from talweg.functions import geometry as g
from talweg.functions import shapes as sh
from talweg.functions import topology as tp
from talweg.functions import validity as va
from talweg.functions.prepared import Prepared
from talweg.functions.projection import inverse_polyconic
from talweg.operators import identifiers as ids
from talweg.operators import scale
from talweg.operators import spatial_join as sj
from talweg.sources import sinks


def wkb(tree, order="<", style="iso", top=True):
    """Any byte order, ISO or extended codes, with an SRID on request."""
    kind, dims, payload = tree
    code = kind + 1000 * (dims - 2 + (dims == 4)) if style == "iso" else kind | {2: 0, 3: 0x80000000, 4: 0xC0000000}[dims]
    srid = style == "srid" and top
    head = struct.pack(order + "BI", order == "<", code | 0x20000000 * srid) + (struct.pack(order + "I", 4326) if srid else b"")
    flat = lambda c: c.astype(order + "f8").tobytes()
    if kind == sh.POINT:
        return head + flat(payload)
    head += struct.pack(order + "I", len(payload))
    if kind == sh.LINE:
        return head + flat(payload)
    if kind == sh.POLYGON:
        return head + b"".join(struct.pack(order + "I", len(r)) + flat(r) for r in payload)
    return head + b"".join(wkb(p, order, style, False) for p in payload)


def some_tree(rng, kind, dims, depth=0):
    points = lambda n: rng.integers(-9, 9, (n, dims)).astype(float)
    if kind == sh.POINT:
        return kind, dims, points(1) if rng.random() < 0.9 else np.full((1, dims), np.nan)
    if kind == sh.LINE:
        return kind, dims, points(rng.integers(0, 5))
    if kind == sh.POLYGON:
        return kind, dims, [points(rng.integers(0 if rng.random() < 0.1 else 3, 7)) for _ in range(rng.integers(0, 4))]
    if kind < sh.COLLECTION:
        return kind, dims, [some_tree(rng, kind - 3, dims) for _ in range(rng.integers(0, 4))]
    return kind, dims, [some_tree(rng, int(rng.integers(1, 7 + (depth < 1))), dims, depth + 1) for _ in range(rng.integers(0, 4))]


def paths(tree):
    kind, _, payload = tree
    if kind in (sh.POINT, sh.LINE):
        return [payload[:, :2]] if len(payload) else []
    if kind == sh.POLYGON:
        return [r[:, :2] for r in payload if len(r)]
    return [p for part in payload for p in paths(part)]


def test_reading_and_writing_whole_batches():
    rng = np.random.default_rng(0)
    raws = [
        None if rng.random() < 0.05 else wkb(
            some_tree(rng, int(rng.integers(1, 8)), int(rng.choice([2, 2, 3, 4]))),
            "<" if rng.random() < 0.9 else ">", ("iso", "extended", "srid")[rng.integers(3)],
        ) for _ in range(3000)
    ]
    array = pa.array(raws, pa.binary()).slice(7)
    s, trees = sh.read_shapes(array), [None if r is None else sh.read_tree(r)[0] for r in raws[7:]]
    assert [t is None for t in trees] == s.null.tolist()
    wanted = [(i, p) for i, t in enumerate(trees) if t for p in paths(t)]
    assert [i for i, _ in wanted] == s.ring_geom.tolist()
    assert np.array_equal(s.xy, np.concatenate([p for _, p in wanted]), equal_nan=True)
    assert [len(p) for _, p in wanted] == s.ring_size.tolist()
    for tree, whole, kind, out in zip(trees, s.whole, s.kind, sh.write_shapes(s).to_pylist()):
        assert (out is not None) == bool(whole)
        if whole:
            assert out == sh.write_tree(tree[0], tree[2]) and kind == tree[0]
    some = np.flatnonzero(s.whole)[::3]
    assert sh.write_shapes(s.take(some)).to_pylist() == [sh.write_shapes(s)[int(i)].as_py() for i in some]
    assert len(sh.write_shapes(sh.read_shapes(pa.array([], pa.binary())))) == 0


def box(x0, y0, x1, y1, back=False):
    ring = np.array([[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]], float)
    return ring[::-1] if back else ring


def random_areas(rng, count):
    """Multipolygons of boxes and triangles on a small grid, with holes: valid ones, touching ones and broken ones."""
    out = []
    for _ in range(count):
        parts = []
        for _ in range(rng.integers(1, 4)):
            x, y = rng.integers(0, 12, 2)
            w, h = rng.integers(2, 7, 2)
            rings = [box(x, y, x + w, y + h, rng.random() < 0.5)]
            for _ in range(rng.integers(0, 3)):
                hx, hy = x + rng.integers(0, w), y + rng.integers(0, h)
                rings.append(box(hx, hy, hx + 1, hy + 1) if rng.random() < 0.6 else np.array([[hx, hy], [hx + 1, hy], [hx, hy + 1], [hx, hy]], float))
            parts.append((sh.POLYGON, 2, rings))
        out.append(parts[0] if len(parts) == 1 else (sh.MULTIPOLYGON, 2, parts))
    return out


def test_states_agree_with_single_geometries():
    rng = np.random.default_rng(2)
    trees = random_areas(rng, 1500)
    state = va.states(sh.read_shapes(pa.array([wkb(t) for t in trees])))
    single = np.array([va.invalid_reason(t) is None for t in trees])
    assert single[state == va.SOUND].all() and not single[state == va.BROKEN].any()
    assert (state == va.SOUND).sum() > 50 and (state == va.BROKEN).sum() > 50


def test_nearly_all_valid_multipolygons_with_holes_are_settled_by_arrays():
    rng = np.random.default_rng(3)
    trees = []
    for _ in range(400):
        parts = []
        for k in range(rng.integers(1, 5)):
            x = 20.0 * k + rng.random()
            rings = [box(x, 0, x + 15, 10)] + [box(x + 1 + 3 * i, 1, x + 2 + 3 * i, 1 + rng.integers(1, 8)) for i in range(rng.integers(0, 4))]
            parts.append((sh.POLYGON, 3, [np.column_stack([r, np.full(len(r), 7.0)]) for r in rings]))
            if len(rings) > 1 and rng.random() < 0.5:  # an island in a hole
                low, high = rings[1].min(axis=0), rings[1].max(axis=0)
                island = box(low[0] + 0.2, low[1] + 0.2, high[0] - 0.2, high[1] - 0.2)
                parts.append((sh.POLYGON, 3, [np.column_stack([island, np.zeros(5)])]))
        trees.append((sh.MULTIPOLYGON, 3, parts))
    s = sh.read_shapes(pa.array([wkb(t) for t in trees]))
    assert all(va.invalid_reason(t) is None for t in trees)
    assert va.quick_valid(s, np.zeros(len(s), bool)).mean() >= 0.95


def test_third_ordinate_counts():
    open_z = np.column_stack([box(0, 0, 1, 1), [0, 0, 0, 0, 1.0]])
    nan_z = np.column_stack([box(0, 0, 1, 1), [0, np.nan, 0, 0, 0]])
    good = np.column_stack([box(0, 0, 1, 1), [1.0] * 5])
    s = sh.read_shapes(pa.array([wkb((sh.POLYGON, 3, [r])) for r in (open_z, nan_z, good)]))
    assert va.quick_valid(s, np.zeros(3, bool)).tolist() == [False, False, True]


def winding(points, rings):
    """Summed winding numbers of rings, shells counter-clockwise by their topmost point, holes the other way."""
    total = np.zeros(len(points), int)
    for hole, ring in rings:
        v = tp.drop_repeats(ring)
        if len(v) < 4:
            continue
        a, b, p = v[None, :-1], v[None, 1:], points[:, None]
        turn = tp._orient(a, b, p)
        up = (a[..., 1] <= p[..., 1]) & (b[..., 1] > p[..., 1]) & (turn > 0)
        down = (b[..., 1] <= p[..., 1]) & (a[..., 1] > p[..., 1]) & (turn < 0)
        top = np.lexsort((v[1:, 0], v[1:, 1]))[-1] + 1  # of several visits the last one
        sign = np.sign(tp._orient(v[top - 1], v[top], v[top % (len(v) - 1) + 1])) or np.sign(tp.ring_area(v))
        total += int(sign) * (up.sum(axis=1) - down.sum(axis=1)) * (-1 if hole else 1)
    return total


@pytest.mark.parametrize("whole", [True, False])
@pytest.mark.parametrize("least", [1, 2])
def test_arrangement_equals_winding_numbers(whole, least):
    rng = np.random.default_rng(7)
    geoms = []
    for _ in range(250):
        rings = []
        for _ in range(rng.integers(1, 5)):
            k = rng.integers(3, 9)
            p = rng.integers(0, 30, (k, 2)).astype(float) if whole else rng.random((k, 2)) * 30
            rings.append((bool(rings) and rng.random() < 0.3, np.concatenate([p, p[:1]])))
        geoms.append(rings)
    flat = [(i, hole, r) for i, rings in enumerate(geoms) for hole, r in rings]
    sizes = np.array([len(r) for *_, r in flat])
    found, failed = arrange.areas(
        np.concatenate([r for *_, r in flat]), np.cumsum(sizes) - sizes, sizes, np.array([i for i, *_ in flat]), np.array([h for _, h, _ in flat]), least
    )
    assert not failed
    probes = rng.random((1500, 2)) * 30
    for i, rings in enumerate(geoms):
        inside = np.zeros(len(probes), bool)
        for part in found.get(i, []):
            inside |= tp.locate(probes, part) > 0
        assert (inside == (winding(probes, rings) >= least)).mean() > 0.998, i
    s = va.polygonal(len(geoms), found)
    state = va.states(s)
    for i in np.flatnonzero(state != va.SOUND):
        assert va.invalid_reason(sh.read_tree(sh.write_shapes(s)[int(i)].as_py())[0]) is None, i


def repaired(*trees):
    out, changed = va.repair(pa.array([None if t is None else wkb(t) for t in trees], pa.binary()))
    return [None if r is None else sh.read_tree(r)[0] for r in out.to_pylist()], changed.tolist()


def area(tree):
    kind, _, payload = tree
    if kind != sh.POLYGON:
        return sum(map(area, payload))
    return sum(abs(tp.ring_area(r)) * (-1 if i else 1) for i, r in enumerate(payload))


def test_repair_keeps_the_area():
    polygon = lambda *rings: (sh.POLYGON, 2, list(rings))
    multi = lambda *parts: (sh.MULTIPOLYGON, 2, [polygon(*p) if isinstance(p, tuple) else polygon(p) for p in parts])
    line = (sh.LINE, 2, np.zeros((3, 2)))
    trees, changed = repaired(
        multi(box(0, 0, 2, 2), box(1, 1, 3, 3)), multi(box(0, 0, 1, 1), box(1, 0, 2, 1)), polygon(box(0, 0, 4, 4), box(3, 1, 6, 2)),
        polygon(box(0, 0, 4, 4), box(1, 1, 2, 2), box(1, 1, 3, 3)), multi(box(0, 0, 9, 9), box(1, 1, 2, 2)), multi((box(0, 0, 9, 9), box(1, 1, 5, 5)), box(2, 2, 3, 3)),
        polygon(box(0, 0, 4, 4), box(9, 9, 10, 10)), polygon(box(0, 0, 1, 1)[:4]), polygon(box(0, 0, 1, 1)[:2]), multi(box(0, 0, 1, 1)[:2], box(0, 0, 1, 1), box(0, 0, 1, 1)),
        line, polygon(np.array([[0, 0], [1, np.inf], [1, 1], [0, 0]])), None, (sh.POLYGON, 2, []),
        (sh.COLLECTION, 2, [polygon(np.array([[0, 0], [1, 1], [1, 0], [0, 1], [0, 0]], float)), (sh.POINT, 2, np.ones((1, 2)))]),
    )
    assert changed == [True] * 5 + [False] + [True] * 6 + [False, False, True]
    assert [area(t) for t in trees[:8]] == [7, 2, 15, 12, 81, 66, 16, 1]
    assert trees[8] is None and area(trees[9]) == 1 and trees[10][2] == [] and trees[11] is None and trees[12] is None
    assert area(trees[14]) == 0.25
    assert all(t is None or va.invalid_reason(t) is None for t in trees)


def test_clipping_whole_batches_equals_single_geometries():
    rng = np.random.default_rng(6)
    trees = random_areas(rng, 500)
    trees += [(sh.LINE, 2, rng.integers(0, 18, (rng.integers(2, 7), 2)).astype(float)) for _ in range(300)]
    trees += [(sh.MULTILINE, 2, [(sh.LINE, 2, rng.random((4, 2)) * 18) for _ in range(3)]) for _ in range(60)]
    trees += [(sh.POINT, 2, rng.integers(0, 18, (1, 2)).astype(float)) for _ in range(40)]
    trees += [(sh.COLLECTION, 2, [trees[i], trees[600]]) for i in range(10)]
    low = rng.integers(0, 12, (len(trees), 2)).astype(float)
    boxes = np.concatenate([low, low + rng.integers(1, 8, low.shape)], axis=1)
    out = g.clip_to_box.func(pa.array([wkb(t) for t in trees]), *[pa.array(boxes[:, k]) for k in range(4)]).to_pylist()

    def measure(raw):
        if raw is None:
            return None
        s = sh.read_shapes(pa.array([raw]))
        got, length = sh.measures(s, s.xy)
        return round(float(got[0]), 6), round(float(length[0] if not got[0] else 0), 6), sh.bounds(s)[0].round(6).tolist()

    for tree, b, raw in zip(trees, boxes, out):
        if tree[0] in (sh.POLYGON, sh.MULTIPOLYGON) and va.invalid_reason(tree):
            continue
        assert measure(raw) == measure(g._assemble(*g._clip(tree, b))), (tree, b)


def test_third_ordinate_and_projection_of_whole_batches():
    rng = np.random.default_rng(4)
    trees = [some_tree(rng, int(rng.integers(1, 8)), int(rng.choice([2, 3, 4]))) for _ in range(300)]
    raws = [wkb(t) for t in trees] + [None]
    flat = g.force_2d.func(pa.array(raws, pa.binary())).to_pylist()
    deepest = lambda t: max([t[1], *(deepest(p) for p in t[2])]) if t[0] > sh.POLYGON else t[1]
    assert flat == [sh.write_tree(t[0], t[2]) if deepest(t) > 2 else r for t, r in zip(trees, raws)] + [None]
    codes = [5880 if i % 2 else 4674 for i in range(301)]
    moved = g.to_geographic.func(pa.array(raws, pa.binary()), pa.array(codes)).to_pylist()
    for t, raw, code, out in zip([*trees, None], raws, codes, moved):
        if raw is None or code == 4674:
            assert out == raw
        else:
            kind, _, payload = g._moved(t, inverse_polyconic)
            assert out == sh.write_tree(kind, payload)
    with pytest.raises(ValueError):
        g.to_geographic.func(pa.array(raws[:1]), pa.array([31983]))


def test_normalized_orientation_with_holes():
    holed = (sh.MULTIPOLYGON, 3, [(sh.POLYGON, 3, [np.column_stack([r, np.ones(5)]) for r in (box(0, 0, 4, 4, True), box(1, 1, 2, 2))])])
    tree = sh.read_tree(va.normalized(pa.array([wkb(holed)]))[0].as_py())[0]
    assert tree[1] == 2 and [tp.ring_area(r) for r in tree[2][0][2]] == [16.0, -1.0]


def test_overlapping_pairs_in_small_blocks(monkeypatch):
    rng = np.random.default_rng(8)
    low = rng.random((300, 2)) * 10
    boxes, group = np.concatenate([low, low + rng.random((300, 2)) * 3], axis=1), rng.integers(0, 4, 300)
    wanted = {
        (i, j) for i in range(300) for j in range(i) if group[i] == group[j] and (boxes[i, :2] <= boxes[j, 2:]).all() and (boxes[j, :2] <= boxes[i, 2:]).all()
    }
    for block in (7, 2_000_000):
        monkeypatch.setattr(sweep, "BLOCK", block)
        pairs = [(max(p), min(p)) for i, j in sweep.overlapping(boxes, group) for p in zip(i.tolist(), j.tolist())]
        assert len(pairs) == len(wanted) and set(pairs) == wanted


def test_batch_functions_through_spark(spark):
    raws = [wkb((sh.MULTIPOLYGON, 2, [(sh.POLYGON, 2, [box(0, 0, 2, 2)]), (sh.POLYGON, 2, [box(2, 0, 3, 2)])])), None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "id int, geometry binary")
    rows = df.select("id", g.repair_geometry("geometry").alias("r"), g.normalize_geometry("geometry").alias("n")).orderBy("id").collect()
    assert rows[0].r.changed and area(sh.read_tree(bytes(rows[0].r.geometry))[0]) == 6
    assert bytes(rows[0].n) == bytes(rows[0].r.geometry)
    assert not rows[1].r.changed and rows[1].r.geometry is None and rows[1].n is None
    assert df.select(F.size(g.ogc_errors(F.col("geometry"), F.lit(4326))).alias("n")).orderBy("n").first().n == 1


def test_multipolygons_from_nested_arrays(spark):
    square, hole, other = ([float(v) for v in text.split()] for text in ("0 0 4 0 4 4 0 4 0 0", "1 1 1 2 2 2 2 1 1 1", "9 9 10 9 10 10 9 9"))
    rows = [(0, [[square, hole], [other]]), (1, None), (2, []), (3, [[square]])]
    df = spark.createDataFrame(rows, "id int, parts array<array<array<double>>>").coalesce(1)
    got = [r.g for r in df.select("id", g.make_multipolygon("parts").alias("g")).orderBy("id").collect()]
    ring = lambda flat: np.array(flat, float).reshape(-1, 2)
    polygon = lambda *rings: (sh.POLYGON, 2, [ring(r) for r in rings])
    wanted = [[polygon(square, hole), polygon(other)], None, [], [polygon(square)]]
    assert [None if b is None else bytes(b) for b in got] == [None if p is None else sh.write_tree(sh.MULTIPOLYGON, p) for p in wanted]


def star(rng, n, centre=(0.0, 0.0), scale=1.0):
    angles = np.sort(rng.uniform(0, 2 * np.pi, n))
    radius = rng.uniform(1, 3, n) * scale
    out = np.stack([centre[0] + radius * np.cos(angles), centre[1] + radius * np.sin(angles)], axis=1)
    return np.concatenate([out, out[:1]])


def test_prepared_polygon_equals_single_tests():
    rng = np.random.default_rng(12)
    outline, hole = star(rng, 400), star(rng, 60, scale=0.2)
    island = star(rng, 9, (8.0, 0.0), 0.1)
    region = sh.write_tree(sh.MULTIPOLYGON, [(sh.POLYGON, 2, [outline, hole]), (sh.POLYGON, 2, [island])])
    trees = [(sh.POINT, 2, rng.uniform(-4, 4, (1, 2))) for _ in range(300)] + [(sh.LINE, 2, rng.uniform(-9, 9, (3, 2))) for _ in range(150)]
    trees += [(sh.POLYGON, 2, [star(rng, 6, rng.uniform(-5, 9, 2), rng.choice([0.05, 0.4, 4.0]))]) for _ in range(150)]
    trees += [(sh.POINT, 2, outline[:1]), (sh.POLYGON, 2, [box(7, -1, 9, 1)]), (sh.POLYGON, 2, [box(-20, -20, 20, 20), box(-9, -9, 15, 9, True)])]
    s = sh.read_shapes(pa.array([wkb(t) for t in trees]))
    wanted = [g.trees_intersect(t, sh.read_tree(region)[0]) for t in trees]
    assert Prepared(region).meets(s).tolist() == wanted
    assert 0 < sum(wanted) < len(wanted)


def test_tiles_hold_all_of_a_region_in_short_pieces():
    rng = np.random.default_rng(13)
    outline = star(rng, 5000, scale=10)
    raw = sh.write_tree(sh.POLYGON, [outline, star(rng, 50, scale=0.9)])
    tiles = g._tiles(raw, 2.0)
    pieces = [sh.read_tree(t["piece"])[0] for t in tiles]
    assert sum(map(area, pieces)) == pytest.approx(area(sh.read_tree(raw)[0]))
    assert len({(t["i"], t["j"]) for t in tiles}) == len(tiles) and any(t["inside"] for t in tiles)
    for t, piece in zip(tiles, pieces):
        xy = np.concatenate(paths(piece))
        assert (xy >= [t["i"] * 2.0, t["j"] * 2.0]).all() and (xy <= [t["i"] * 2.0 + 2, t["j"] * 2.0 + 2]).all()
        assert len(xy) < 1500
        if t["inside"]:
            assert area(piece) == 4.0
    # What is no sound area is kept whole in every cell that its bounds meet.
    assert {t["piece"] for t in g._tiles(wkb((sh.LINE, 2, np.array([[0, 0], [3.0, 1.0]]))), 2.0)} == {wkb((sh.LINE, 2, np.array([[0, 0], [3.0, 1.0]])))}


def test_a_region_of_many_vertices_does_not_enlarge_pairs(spark):
    rng = np.random.default_rng(14)
    angle = np.linspace(0, 2 * np.pi, 100_001)[:-1]
    radius = 20 + 7 * np.sin(7 * angle) + rng.uniform(0, 1e-4, len(angle))
    outline = np.stack([radius * np.cos(angle), radius * np.sin(angle)], axis=1)
    outline = np.concatenate([outline, outline[:1]])
    raw = sh.write_tree(sh.POLYGON, [outline])
    regions = spark.createDataFrame([("1", "n", "11", raw)], "cd_mun string, nm_mun string, cd_uf string, geometry binary")
    layer = sj.reference_layer(regions)
    tiled = sj.region_tiles(layer, sj.Grid.of(layer))
    longest = tiled.select(F.max(F.aggregate("tiles", F.lit(0), lambda n, t: F.greatest(n, F.length(t["piece"]))))).first()[0]
    assert longest < len(raw) / 20
    points = spark.range(3000).select(F.col("id"), g.make_point(F.rand(1) * 60 - 30, F.rand(2) * 60 - 30).alias("geometry"))
    found = {r.id for r in sj.intersecting_pairs(points, layer, "id").collect()}
    xy = {r.id: np.frombuffer(bytes(r.geometry)[5:], "<f8") for r in points.collect()}
    inside = Prepared(raw).locate(np.array([xy[i] for i in range(3000)])) >= 0
    assert found == set(np.flatnonzero(inside).tolist())


def test_ids_of_tied_keys_spread_over_partitions(spark, monkeypatch):
    staged = []
    monkeypatch.setattr(ids, "stage", lambda df: staged.append(scale.stage(df)) or staged[-1])
    df = spark.range(0, 40_000, 1, 8).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(F.lit(5)).alias("key"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = ids.add_sequential_id(df, ["key"])
        sizes = [r["count"] for r in staged[0].groupBy(F.shiftright("_at", 33)).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(sizes) < 2 * np.median(sizes)
    rows = out.orderBy("acm_id").collect()
    assert [r.acm_id for r in rows] == list(range(1, 40_001))
    assert [(r.key, r.id) for r in rows] == sorted((r.key, r.id) for r in rows)


def test_versioned_silver_reads_only_its_version(spark, tmp_path):
    df = spark.range(30).select("id", (F.col("id") % 3).alias("year"))
    path = str(tmp_path / "silver")
    for v in ("00", "01"):
        sinks.write_silver_versions(df.withColumn("version", F.lit(v)), path, ["version", "year"])
    sinks.write_silver_versions(df.filter("year = 1").withColumn("id", -F.col("id")).withColumn("version", F.lit("01")), path, ["version", "year"])
    old, new = (sinks.read_silver_version(spark, path, version=v) for v in ("00", "01"))
    assert old.agg(F.sum("id")).first()[0] == sum(range(30))
    assert new.agg(F.sum("id")).first()[0] == sum(i if i % 3 != 1 else -i for i in range(30))
    assert "PartitionFilters: [isnotnull(version" in new._jdf.queryExecution().toString()
    assert {f.name for f in new.schema} == {"id", "version", "year"}


def test_regions_without_geometry_meet_nothing(spark):
    schema = "cd_mun string, nm_mun string, cd_uf string, geometry binary"
    points = spark.createDataFrame([(1, g.point_wkb(0.5, 0.5)), (2, None)], "id long, geometry binary")
    for rows in ([], [("1", "n", "11", None)], [("1", "n", "11", sh.write_tree(sh.POLYGON, []))]):
        assert sj.intersecting_pairs(points, sj.reference_layer(spark.createDataFrame(rows, schema)), "id").count() == 0
        out = sj.assign_regions(points, spark.createDataFrame(rows, schema), "id").collect()
        assert [r.acm_cod_munici for r in out] == [sj.NO_MATCH] * 2

"""Geometry column functions: one Arrow pass per question, never row-at-a-time UDFs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talweg.functions import arrange
from talweg.functions import shapes as sh
from talweg.functions import topology as topo
from talweg.functions import validity
from talweg.functions.prepared import Prepared
from talweg.functions.projection import (
    BRAZIL_POLYCONIC, GEOGRAPHIC, WGS84, inverse_polyconic, polyconic,
)

FACTS = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("dims", T.IntegerType()),
        T.StructField("is_empty", T.BooleanType()),
        T.StructField("finite", T.BooleanType()),
        *[
            T.StructField(name, T.DoubleType())
            for name in ("minx", "miny", "maxx", "maxy", "centroid_x", "centroid_y", "area_m2", "length_m")
        ],
        T.StructField("vertices", T.IntegerType()),
    ]
)
REPAIRED = T.StructType(
    [T.StructField("geometry", T.BinaryType()), T.StructField("changed", T.BooleanType())]
)


def _doubles(values, valid):
    return pa.array(values, pa.float64(), mask=~valid)


def _facts(wkb: pa.Array) -> pa.Array:
    """Type, dimension, bounds, centroid, and projected area and length of geographic geometries."""
    s = sh.read_shapes(wkb)
    box = sh.bounds(s)
    present = ~s.null & ~s.empty
    finite = present & np.isfinite(box).all(axis=1)
    centre = sh.centroids(s)
    with np.errstate(invalid="ignore"):
        area, length = sh.measures(s, polyconic(s.xy))
    facts = {
        "kind": pa.array(sh.KINDS, pa.string()).take(pa.array(s.kind)),
        "dims": pa.array(s.dims, pa.int32(), mask=s.null),
        "is_empty": pa.array(s.empty, mask=s.null),
        "finite": pa.array(finite),
        **{name: _doubles(box[:, i], present) for i, name in enumerate(("minx", "miny", "maxx", "maxy"))},
        "centroid_x": _doubles(centre[:, 0], finite),
        "centroid_y": _doubles(centre[:, 1], finite),
        "area_m2": _doubles(area, finite),
        "length_m": _doubles(length, finite),
        "vertices": pa.array(np.bincount(s.vertex_geom, minlength=len(s)), pa.int32()),
    }
    return pa.StructArray.from_arrays(list(facts.values()), list(facts))


geometry_facts = F.arrow_udf(_facts, FACTS)
# For results that are filtered and then used: not being pushed through the
# projection, the filter sees the computed column instead of a second evaluation.
geometry_facts_once = F.arrow_udf(_facts, FACTS).asNondeterministic()


BOUNDS = T.StructType([f for f in FACTS.fields if f.name in ("kind", "finite", "minx", "miny", "maxx", "maxy")])


def _bounds(wkb: pa.Array) -> pa.Array:
    """Type and bounds of geometries, as in their facts."""
    s = sh.read_shapes(wkb)
    box, present = sh.bounds(s), ~s.null & ~s.empty
    kind = pa.array(sh.KINDS, pa.string()).take(pa.array(s.kind))
    sides = [_doubles(box[:, i], present) for i in range(4)]
    return pa.StructArray.from_arrays([kind, pa.array(present & np.isfinite(box).all(axis=1)), *sides], BOUNDS.names)


# Planned like ``geometry_facts_once``, for joins that need no measures.
geometry_bounds_once = F.arrow_udf(_bounds, BOUNDS).asNondeterministic()


def _where(rows: np.ndarray, new: pa.Array, old: pa.Array) -> pa.Array:
    """``new`` in the marked rows, else ``old``."""
    return pc.if_else(pa.array(rows), new.cast(pa.binary()), old.cast(pa.binary()))


@F.arrow_udf(T.DoubleType())
def planar_area(wkb: pa.Array) -> pa.Array:
    """Area in square units of the coordinates, holes subtracted; 0 for points and lines."""
    s = sh.read_shapes(wkb)
    return _doubles(sh.measures(s, s.xy)[0], ~s.null)


def _force_2d(wkb: pa.Array) -> pa.Array:
    """Drop Z and M; 2-D input passes through unchanged."""
    s = sh.read_shapes(wkb)
    deep = s.dims > 2
    return _where(deep, validity.flat(s, wkb), wkb) if deep.any() else wkb


force_2d = F.arrow_udf(_force_2d, T.BinaryType())


def _to_geographic(wkb: pa.Array, srid: pa.Array) -> pa.Array:
    """Reproject to EPSG:4326; the geographic systems in use coincide with it."""
    codes = np.asarray(srid.fill_null(WGS84))
    unknown = set(np.unique(codes).tolist()) - {*GEOGRAPHIC, BRAZIL_POLYCONIC}
    if unknown:
        raise ValueError(f"no transformation to EPSG:{WGS84} for {sorted(unknown)}")
    moved = codes == BRAZIL_POLYCONIC
    if not moved.any():
        return wkb
    rows = np.flatnonzero(moved)
    some = wkb.take(pa.array(rows))
    s = sh.read_shapes(some)
    s.xy = inverse_polyconic(s.xy)
    out = sh.write_shapes(s)
    odd = np.flatnonzero(~s.whole & ~s.null)
    if len(odd):  # collections and empty parts
        out = out.to_pylist()
        for i in odd.tolist():
            kind, _, payload = _moved(sh.read_tree(some[i].as_buffer())[0], inverse_polyconic)
            out[i] = sh.write_tree(kind, payload)
        out = pa.array(out, pa.binary())
    place = np.zeros(len(wkb), "i8")
    place[rows] = np.arange(len(rows))
    return _where(moved, out.take(pa.array(place)), wkb)


to_geographic = F.arrow_udf(_to_geographic, T.BinaryType())


@F.arrow_udf(T.StructType([T.StructField("geometry", T.BinaryType()), T.StructField("facts", FACTS)]))
def geographic_2d(wkb: pa.Array, srid: pa.Array) -> pa.Array:
    """A geometry in EPSG:4326 without Z and M, and its facts before these are dropped.

    One function instead of three, as each step of a chain takes a Python worker of its own in every task.
    """
    placed = _to_geographic(wkb, srid)
    return pa.StructArray.from_arrays([_force_2d(placed).cast(pa.binary()), _facts(placed)], ["geometry", "facts"])


def _moved(tree, move):
    kind, _, payload = tree
    if kind in (sh.POINT, sh.LINE):
        return kind, 2, move(payload[:, :2]) if len(payload) else payload
    if kind == sh.POLYGON:
        return kind, 2, [move(r[:, :2]) if len(r) else r for r in payload]
    return kind, 2, [_moved(part, move) for part in payload]


def _errors(wkb: pa.Array, crs: pa.Array, geographic: pa.Array) -> pa.Array:
    s = sh.read_shapes(wkb)
    flags = np.array(geographic.to_pylist(), bool)
    quick = validity.quick_valid(s, flags)
    odd = np.flatnonzero(~quick)
    # Equal geometries of a batch are looked at once, in one reference system each.
    raws, names = wkb.take(pa.array(odd)).dictionary_encode(), crs.take(pa.array(odd)).to_pylist()
    values, reasons, found = raws.dictionary.to_pylist(), {}, [[]] * len(s)
    for i, code, name in zip(odd.tolist(), raws.indices.to_pylist(), names):
        key = code, name, bool(flags[i])
        if key not in reasons:
            reasons[key] = validity.ogc_errors(None if code is None else values[code], name, key[2])
        found[i] = reasons[key]
    return pa.array(found, pa.list_(pa.string()))


# Errors are nearly always filtered by their size, so they are planned like ``geometry_facts_once``.
_ogc_errors = F.arrow_udf(_errors, T.ArrayType(T.StringType())).asNondeterministic()


def ogc_errors(
    wkb: Column, srid: Column, expected_srid: int | None = None, expected_crs: str | None = None
) -> Column:
    """Reasons a geometry fails the OGC checks; an empty array when it passes."""
    crs = F.concat(F.lit("EPSG:"), srid.cast("string"))
    errors = _ogc_errors(wkb, crs, F.coalesce(srid.isin(*GEOGRAPHIC), F.lit(False)))
    extra = []
    if expected_srid is not None:
        extra.append(
            F.when(
                F.coalesce(srid, F.lit(0)) == 0,
                F.lit(validity.SRID_MISSING.format(expected=expected_srid)),
            ).when(
                srid != expected_srid,
                F.format_string(
                    validity.SRID_MISMATCH.format(actual="%d", expected=expected_srid), srid
                ),
            )
        )
    if expected_crs is not None:
        extra.append(
            F.when(crs.isNull(), F.lit(validity.CRS_MISSING.format(expected=expected_crs))).when(
                crs != expected_crs,
                F.format_string(validity.CRS_MISMATCH.format(actual="%s", expected=expected_crs), crs),
            )
        )
    if not extra:
        return errors
    return F.concat(errors, F.when(wkb.isNull(), F.array().cast("array<string>")).otherwise(
        F.array_compact(F.array(*extra))
    ))


@F.arrow_udf(REPAIRED)
def repair_geometry(wkb: pa.Array) -> pa.Array:
    """Valid counterpart of a geometry (null when none is provable) and whether it changed."""
    fixed, changed = validity.repair(wkb)
    return pa.StructArray.from_arrays([fixed.cast(pa.binary()), pa.array(changed)], ["geometry", "changed"])


@F.arrow_udf(T.BinaryType())
def normalize_geometry(wkb: pa.Array) -> pa.Array:
    return validity.normalized(wkb)


def _clip(tree, box):
    """Parts of a geometry inside a box as (points, lines, polygons)."""
    kind, _, payload = tree
    points, lines, polygons = [], [], []
    if kind == sh.POINT:
        inside = len(payload) and box[0] <= payload[0, 0] <= box[2] and box[1] <= payload[0, 1] <= box[3]
        points += [payload[:, :2]] if inside else []
    elif kind == sh.LINE:
        for piece in topo.clip_line(payload[:, :2], box):
            (lines if len(piece) > 1 else points).append(piece)
    elif kind == sh.POLYGON:
        rings = [topo.drop_repeats(r[:, :2]) for r in payload if len(r)]
        if rings:
            polygons += topo.clip_polygon(rings, box)
            if not polygons:  # the box may only touch the boundary
                for ring in rings:
                    for piece in topo.clip_line(ring, box):
                        (lines if len(piece) > 1 else points).append(piece)
    else:
        for part in payload:
            found = _clip(part, box)
            points += found[0]
            lines += found[1]
            polygons += found[2]
    return points, lines, polygons


def _assemble(points, lines, polygons):
    groups = [
        (kind, multi, parts)
        for kind, multi, parts in (
            (sh.POLYGON, sh.MULTIPOLYGON, polygons),
            (sh.LINE, sh.MULTILINE, lines),
            (sh.POINT, sh.MULTIPOINT, points),
        )
        if parts
    ]
    if not groups:
        return None
    trees = [
        (kind, 2, parts[0]) if len(parts) == 1 else (multi, 2, [(kind, 2, p) for p in parts])
        for kind, multi, parts in groups
    ]
    tree = trees[0] if len(trees) == 1 else (sh.COLLECTION, 2, trees)
    return sh.write_tree(tree[0], tree[2])


def _clipped_areas(s: sh.Shapes, boxes: np.ndarray) -> dict[int, list[list[np.ndarray]]]:
    """Polygons that valid areas share with their boxes; geometries of which a part only touches its box are left out."""
    poly, first = np.unique(s.ring_poly, return_index=True)
    place, geom, n = np.searchsorted(poly, s.ring_poly), s.ring_geom[first], len(poly)
    low, high = (f.reduceat(s.xy, s.ring_start[:-1])[first] for f in (np.minimum, np.maximum))
    meets = (low <= boxes[geom, 2:]).all(axis=1) & (high >= boxes[geom, :2]).all(axis=1)
    use, cut = meets[place], np.flatnonzero(meets)
    corners = boxes[geom[cut]][:, [0, 1, 2, 1, 2, 3, 0, 3, 0, 1]].reshape(5 * len(cut), 2)
    found, failed = arrange.areas(
        np.concatenate([s.xy, corners]), np.concatenate([s.ring_start[:-1][use], len(s.xy) + 5 * np.arange(len(cut))]),
        np.concatenate([s.ring_size[use], np.full(len(cut), 5)]), np.concatenate([place[use], cut]),
        np.concatenate([(s.ring_role == sh.ROLE_HOLE)[use], np.zeros(len(cut), bool)]), least=2,
    )
    touching = {int(geom[p]) for p in cut.tolist() if p not in found or p in failed}
    out: dict[int, list[list[np.ndarray]]] = {}
    for p in sorted(found):
        if int(geom[p]) not in touching:
            out.setdefault(int(geom[p]), []).extend(found[p])
    return out


def _clipped_lines(s: sh.Shapes, boxes: np.ndarray) -> sh.Shapes:
    """What lines have inside their boxes, as lines; those that only touch are empty."""
    ring = np.repeat(np.arange(len(s.ring_geom)), s.ring_size)
    start = np.flatnonzero((ring[:-1] == ring[1:]) & (s.xy[:-1] != s.xy[1:]).any(axis=1))
    a, b, ring = s.xy[start], s.xy[start + 1], ring[start]
    geom = s.ring_geom[ring]
    step, low, high = b - a, np.zeros(len(a)), np.ones(len(a))
    for k in (0, 1):
        with np.errstate(divide="ignore", invalid="ignore"):
            ends = (boxes[geom][:, [k, k + 2]] - a[:, [k]]) / step[:, [k]]
        still = step[:, k] == 0
        beside = still & ((a[:, k] < boxes[geom, k]) | (a[:, k] > boxes[geom, k + 2]))
        low = np.where(beside, 2.0, np.where(still, low, np.maximum(low, ends.min(axis=1))))
        high = np.where(still, high, np.minimum(high, ends.max(axis=1)))
    kept = low < high
    low, high, ring, geom = low[kept][:, None], high[kept][:, None], ring[kept], geom[kept]
    p, q = np.where(low > 0, a[kept] + low * step[kept], a[kept]), np.where(high < 1, a[kept] + high * step[kept], b[kept])
    fresh = np.ones(len(p), bool)
    fresh[1:] = (ring[1:] != ring[:-1]) | (p[1:] != q[:-1]).any(axis=1)
    # A piece is its first point and the end of each of its segments.
    size = np.bincount(np.cumsum(fresh) - 1) + 1 if len(p) else np.empty(0, "i8")
    xy, head = np.empty((size.sum(), 2)), np.cumsum(size) - size
    mask = np.ones(len(xy), bool)
    mask[head] = False
    xy[head], xy[mask] = p[fresh], q
    owner, n = geom[fresh], len(s)
    kind = np.where(np.bincount(owner, minlength=n) > 1, sh.MULTILINE, sh.LINE).astype("i4")
    return sh.Shapes(
        s.null, kind, np.full(n, 2, "i4"), xy, np.concatenate([[0], np.cumsum(size)]).astype("i8"), owner,
        np.full(len(owner), sh.ROLE_LINE, "i4"), np.full(len(owner), -1), np.ones(n, bool), np.ones(n, bool),
    )


def _boxes(*sides: pa.Array) -> np.ndarray:
    return np.stack([np.asarray(a.fill_null(np.nan)) for a in sides], axis=1)


@F.arrow_udf(T.BinaryType())
def clip_to_box(wkb: pa.Array, minx: pa.Array, miny: pa.Array, maxx: pa.Array, maxy: pa.Array) -> pa.Array:
    """Part of a geometry inside a box, null where they do not meet."""
    return _clipped(wkb, _boxes(minx, miny, maxx, maxy))


@F.arrow_udf(T.StructType([T.StructField("geometry", T.BinaryType()), T.StructField("beyond", T.BooleanType()), T.StructField("facts", FACTS)]))
def clip_beyond(wkb: pa.Array, minx: pa.Array, miny: pa.Array, maxx: pa.Array, maxy: pa.Array) -> pa.Array:
    """Whether a geometry lies beyond a box on some side; if so the part inside and its facts, null where they do not meet."""
    boxes, s = _boxes(minx, miny, maxx, maxy), sh.read_shapes(wkb)
    own = sh.bounds(s)
    with np.errstate(invalid="ignore"):
        # Coordinates that are no numbers count as the largest.
        past = (own[:, :2] < boxes[:, :2]).any(axis=1) | ~(own[:, 2:] <= boxes[:, 2:]).all(axis=1)
        meets = (own[:, :2] <= boxes[:, 2:]).all(axis=1) & (own[:, 2:] >= boxes[:, :2]).all(axis=1)
    beyond = past & ~s.null & ~s.empty & ~np.isnan(boxes).any(axis=1)
    rows = np.flatnonzero(beyond & meets)
    part = _clipped(wkb.take(pa.array(rows)), boxes[rows])
    place, cut = np.zeros(len(s), "i8"), np.zeros(len(s), bool)
    place[rows], cut[rows] = np.arange(len(rows)), np.asarray(part.is_valid())
    place = pa.array(place, mask=~cut)
    return pa.StructArray.from_arrays([part.cast(pa.binary()).take(place), pa.array(beyond), _facts(part).take(place)], ["geometry", "beyond", "facts"])


def _clipped(wkb: pa.Array, boxes: np.ndarray) -> pa.Array:
    """Whole batches are clipped together; one by one go collections, what only touches its box, and polygons that are not valid."""
    s = sh.read_shapes(wkb)
    own = sh.bounds(s)
    with np.errstate(invalid="ignore"):
        meets = (own[:, :2] <= boxes[:, 2:]).all(axis=1) & (own[:, 2:] >= boxes[:, :2]).all(axis=1)
        inside = (own[:, :2] >= boxes[:, :2]).all(axis=1) & (own[:, 2:] <= boxes[:, 2:]).all(axis=1)
    inside &= s.whole
    out = _where(inside, sh.write_shapes(s), pa.nulls(len(s), pa.binary()))
    left = np.flatnonzero(meets & ~inside)
    if not len(left):
        return out
    done = np.zeros(len(s), bool)
    for kinds in ((sh.POLYGON, sh.MULTIPOLYGON), (sh.LINE, sh.MULTILINE)):
        rows = left[np.isin(s.kind[left], kinds) & s.whole[left]]
        if len(rows) and sh.POLYGON in kinds:
            rows = rows[validity.states(s.take(rows)) == validity.SOUND]
        if not len(rows):
            continue
        part = s.take(rows)
        cut = validity.polygonal(len(rows), _clipped_areas(part, boxes[rows])) if sh.POLYGON in kinds else _clipped_lines(part, boxes[rows])
        filled = ~cut.empty
        place = np.zeros(len(s), "i8")
        place[rows] = np.arange(len(rows))
        done[rows[filled]] = True
        here = np.zeros(len(s), bool)
        here[rows[filled]] = True
        out = _where(here, sh.write_shapes(cut).take(pa.array(place)), out)
    rest = [i for i in left.tolist() if not done[i]]
    if rest:
        out = out.to_pylist()
        for i in rest:
            out[i] = _assemble(*_clip(sh.read_tree(wkb[i].as_buffer())[0], boxes[i]))
        out = pa.array(out, pa.binary())
    return out


def _areas_and_paths(tree):
    kind, _, payload = tree
    if kind == sh.POINT:
        return [], [payload[:, :2]]
    if kind == sh.LINE:
        return [], [payload[:, :2]]
    if kind == sh.POLYGON:
        rings = [r[:, :2] for r in payload if len(r)]
        return ([rings] if rings else []), []
    areas, paths = [], []
    for part in payload:
        a, p = _areas_and_paths(part)
        areas += a
        paths += p
    return areas, [p for p in paths if len(p)]


def trees_intersect(one, two) -> bool:
    """Closed intersection test: an edge contact, or one geometry holding a vertex of the other."""
    areas_a, paths_a = _areas_and_paths(one)
    areas_b, paths_b = _areas_and_paths(two)
    lines_a = paths_a + [r for rings in areas_a for r in rings]
    lines_b = paths_b + [r for rings in areas_b for r in rings]
    for areas, others in ((areas_b, lines_a), (areas_a, lines_b)):
        if not others:
            continue
        probes = np.stack([p[0] for p in others])
        for rings in areas:
            if (topo.locate(probes, rings) >= 0).any():
                return True
    for a in lines_a:
        for b in lines_b:
            if len(a) > 1 and len(b) > 1:
                if topo.edges_contact(a, b, topo.segments_meet) is not None:
                    return True
            elif len(a) == 1 and len(b) == 1:
                if (a[0] == b[0]).all():
                    return True
            else:
                point, path = (a, b) if len(a) == 1 else (b, a)
                p = np.broadcast_to(point[0], path[:-1].shape)
                if topo.segments_meet(path[:-1], path[1:], p, p).any():
                    return True
    return False


#: Pairs of segments tested together, and most of one row; rows of more are looked at one by one.
PAIRS = 1 << 16


def _edges(s: sh.Shapes):
    """Segments of all paths as (start, end, ring), a lone vertex being one to itself, and where those of each geometry begin."""
    count = np.maximum(s.ring_size - 1, 1)
    ring = np.repeat(np.arange(len(count)), count)
    start = sh.runs(s.ring_start[:-1], count)
    end = np.minimum(start + 1, s.ring_start[1:][ring] - 1)
    own = np.bincount(s.ring_geom, count, len(s)).astype("i8")
    return s.xy[start], s.xy[end], ring, np.cumsum(own) - own, own


def _products(one_at, one_n, two_at, two_n):
    """(row, i, j) for every pair of a row's two runs, in blocks of about ``PAIRS``."""
    size = one_n * two_n
    before = np.concatenate([[0], np.cumsum(size)])
    at = 0
    while at < len(size):
        end = max(at + 1, int(np.searchsorted(before, before[at] + PAIRS, "right")) - 1)
        row = np.repeat(np.arange(at, end), size[at:end])
        place = np.arange(len(row)) - (before[row] - before[at])
        yield row, one_at[row] + place // two_n[row], two_at[row] + place % two_n[row]
        at = end


def _inside(probed: sh.Shapes, probe_geom, areal: sh.Shapes, edges, area_geom) -> np.ndarray:
    """Rows where the first vertex of a path of one geometry lies in a polygon of the other, outlines aside."""
    paths = np.bincount(probed.ring_geom, minlength=len(probed))
    first = np.cumsum(paths) - paths
    a, b, ring, at, own = edges
    polygons, hit = max(1, int(areal.ring_poly.max(initial=0)) + 1), np.zeros(len(probe_geom), bool)
    before = np.cumsum(paths[probe_geom]) - paths[probe_geom]
    for row, i, j in _products(first[probe_geom], paths[probe_geom], at[area_geom], own[area_geom]):
        p, y0, y1 = probed.xy[probed.ring_start[i]], a[j, 1], b[j, 1]
        passed = (areal.ring_role[ring[j]] >= sh.ROLE_SHELL) & ((y0 <= p[:, 1]) != (y1 <= p[:, 1]))
        row, i, j, p = row[passed], i[passed], j[passed], p[passed]
        turn = topo._orient(a[j], b[j], p)
        right = np.where(b[j, 1] > a[j, 1], turn > 0, turn < 0)
        row, i, j = row[right], i[right], j[right]
        probe = before[row] + i - first[probe_geom[row]]
        key, place, times = np.unique(probe * polygons + areal.ring_poly[ring[j]], return_index=True, return_counts=True)
        hit[row[place[times % 2 == 1]]] = True
    return hit


def _meeting(s: sh.Shapes, t: sh.Shapes, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of ``s`` share a point with the geometry of ``t`` that ``code`` names, and rows too large for that."""
    hit = np.zeros(len(s), bool)
    one, two = _edges(s), _edges(t)
    pairs = np.where(code >= 0, one[4] * two[4][code], 0) if len(t) else np.zeros(len(s), "i8")
    large, rows = np.flatnonzero(pairs > PAIRS), np.flatnonzero((pairs > 0) & (pairs <= PAIRS))
    (a, b), (c, d) = one[:2], two[:2]
    for row, i, j in _products(one[3][rows], one[4][rows], two[3][code[rows]], two[4][code[rows]]):
        near = (np.minimum(a[i], b[i]) <= np.maximum(c[j], d[j])).all(axis=1) & (np.minimum(c[j], d[j]) <= np.maximum(a[i], b[i])).all(axis=1)
        row, i, j = row[near], i[near], j[near]
        hit[rows[row[topo.segments_meet(a[i], b[i], c[j], d[j])]]] = True
    rows = rows[~hit[rows]]
    hit[rows[_inside(s, rows, t, two, code[rows])]] = True
    rows = rows[~hit[rows]]
    hit[rows[_inside(t, code[rows], s, one, rows)]] = True
    return hit, large


def _intersects(left: pa.Array, right: pa.Array) -> pa.Array:
    """Closed intersection of two geometry columns; null when either is null.

    Each different right geometry is decoded once, and all segments of a batch are tested together in bounded blocks.
    """
    coded = right.dictionary_encode()
    code = np.asarray(coded.indices.fill_null(-1)).astype("i8")
    s = sh.read_shapes(left)
    hit, large = _meeting(s, sh.read_shapes(coded.dictionary), code)
    for i in large.tolist():
        hit[i] = trees_intersect(sh.read_tree(left[i].as_buffer())[0], sh.read_tree(right[i].as_buffer())[0])
    return pa.array(hit, mask=(code < 0) | s.null)


intersects = F.arrow_udf(_intersects, T.BooleanType())


@F.arrow_udf(T.IntegerType())
def first_met(wkb: pa.Array, pieces: pa.Array) -> pa.Array:
    """Place of the first geometry of a list that meets a geometry, from 0; null where none does."""
    size = np.asarray(pc.list_value_length(pieces).fill_null(0)).astype("i8")
    row = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(row)) - (np.cumsum(size) - size)[row]
    met = np.asarray(_intersects(wkb.take(pa.array(row)), pieces.flatten()).fill_null(False)) if len(row) else np.zeros(0, bool)
    rows, at = np.unique(row[met], return_index=True)
    found = np.full(len(size), -1, "i4")
    found[rows] = place[met][at]
    return pa.array(found, mask=found < 0)


def meets_polygon(wkb: Column, polygon: bytes) -> Column:
    """Closed intersection with one fixed polygon, which is prepared once for each batch; null for null."""

    @F.arrow_udf(T.BooleanType())
    def met(geometries: pa.Array) -> pa.Array:
        s = sh.read_shapes(geometries)
        return pa.array(Prepared(polygon).meets(s), mask=s.null)

    return met(wkb)


TILES = T.ArrayType(
    T.StructType(
        [
            T.StructField("i", T.LongType()), T.StructField("j", T.LongType()),
            T.StructField("inside", T.BooleanType()), T.StructField("piece", T.BinaryType()),
        ]
    )
)


def _tiles(raw: bytes, side: float) -> list[dict]:
    """A geometry cut into square cells; each cell's piece has an area, and ``inside`` says that it is all of the cell."""
    s = sh.read_shapes(pa.array([raw]))
    i0, j0, i1, j1 = (int(np.floor(v / side)) for v in sh.bounds(s)[0])
    found: list[dict] = []

    def tile(i, j, inside, piece):
        found.append({"i": i, "j": j, "inside": inside, "piece": piece})

    def outline(i, j):
        return box_wkb(i * side, j * side, (i + 1) * side, (j + 1) * side)

    if s.kind[0] not in (sh.POLYGON, sh.MULTIPOLYGON) or validity.states(s)[0] == validity.BROKEN:
        # Without a sound area there is nothing to halve: all of it lies in every cell that its bounds meet.
        for i in range(i0 - 1, i1 + 1):
            for j in range(j0 - 1, j1 + 1):
                tile(i, j, False, raw)
        return found
    parts, _ = _areas_and_paths(sh.read_tree(raw)[0])
    # Halves are cut off until one cell is left, so each vertex is looked at once for each halving.
    todo = [([r for rings in parts for r in topo.oriented([topo.drop_repeats(r) for r in rings])], i0, i1 + 1, j0, j1 + 1)]
    while todo:
        rings, i0, i1, j0, j1 = todo.pop()
        if not rings:
            continue
        if len(rings) == 1 and topo.ring_area(rings[0]) == (i1 - i0) * (j1 - j0) * side * side:
            for i in range(i0, i1):
                for j in range(j0, j1):
                    tile(i, j, True, outline(i, j))
        elif i1 - i0 == j1 - j0 == 1:
            tile(i0, j0, False, _assemble([], [], topo.nest_rings(rings)))
        elif i1 - i0 >= j1 - j0:
            middle = (i0 + i1) // 2
            todo.append((topo.clip_half(rings, 0, -1, middle * side), i0, middle, j0, j1))
            todo.append((topo.clip_half(rings, 0, 1, middle * side), middle, i1, j0, j1))
        else:
            middle = (j0 + j1) // 2
            todo.append((topo.clip_half(rings, 1, -1, middle * side), i0, i1, j0, middle))
            todo.append((topo.clip_half(rings, 1, 1, middle * side), i0, i1, middle, j1))
    return found


@F.arrow_udf(TILES)
def cut_to_cells(wkb: pa.Array, side: pa.Array) -> pa.Array:
    """Tiles of each geometry on a grid of the given side; one by one, as regions are few and cut once."""
    rows = [None if w is None else _tiles(w, s) for w, s in zip(wkb.to_pylist(), side.to_pylist(), strict=True)]
    kind = pa.struct([("i", pa.int64()), ("j", pa.int64()), ("inside", pa.bool_()), ("piece", pa.binary())])
    return pa.array(rows, pa.list_(kind))


@F.arrow_udf(T.BinaryType())
def make_point(x: pa.Array, y: pa.Array) -> pa.Array:
    return sh.write_points(
        np.asarray(x.cast(pa.float64()).fill_null(np.nan)), np.asarray(y.cast(pa.float64()).fill_null(np.nan))
    )


@F.arrow_udf(T.BinaryType())
def make_polygon(xs: pa.Array, ys: pa.Array) -> pa.Array:
    """Polygon of one ring given as coordinate arrays (taken as they are, not closed)."""
    null, n = np.asarray(xs.is_null()), len(xs)
    given = pa.array(~null)
    xs, ys = xs.filter(given), ys.filter(given)
    size = np.asarray(pc.list_value_length(xs))
    if not pc.list_value_length(ys).equals(pc.list_value_length(xs)):
        raise ValueError("a ring needs as many x as y")
    xy = np.stack([np.asarray(v.flatten().cast(pa.float64()).fill_null(np.nan)) for v in (xs, ys)], axis=1)
    filled = size > 0
    ring_geom, size = np.flatnonzero(~null)[filled], size[filled]
    return sh.write_shapes(
        sh.Shapes(
            null, np.full(n, sh.POLYGON, "i4"), np.full(n, 2, "i4"), xy, np.concatenate([[0], np.cumsum(size)]).astype("i8"), ring_geom,
            np.full(len(size), sh.ROLE_SHELL, "i4"), np.arange(len(size)), np.ones(n, bool), np.ones(n, bool),
        )
    )


@F.arrow_udf(T.BinaryType())
def make_multipolygon(parts: pa.Array) -> pa.Array:
    """Multipolygons from arrays of polygons, each an array of rings, shell first, each an array x, y, x, y and so on."""
    rings, points = parts.flatten(), parts.flatten().flatten()
    values = np.asarray(points.flatten(), "f8").reshape(-1, 2)

    def owners(array):
        ends = np.asarray(array.offsets) - array.offsets[0].as_py()
        return np.repeat(np.arange(len(array)), np.diff(ends)), np.diff(ends)

    part_geom, _ = owners(parts)
    ring_part, rings_in = owners(rings)
    sizes = owners(points)[1] // 2
    first = np.concatenate([[0], np.cumsum(rings_in)[:-1]]) if len(rings_in) else np.empty(0, "i8")
    role = np.full(len(points), sh.ROLE_HOLE, "i4")
    role[first[rings_in > 0]] = sh.ROLE_SHELL
    null, n = np.asarray(parts.is_null()), len(parts)
    return sh.write_shapes(
        sh.Shapes(
            null, np.full(n, sh.MULTIPOLYGON, "i4"), np.full(n, 2, "i4"), values, np.concatenate([[0], np.cumsum(sizes)]).astype("i8"),
            part_geom[ring_part], role, ring_part, np.ones(n, bool), np.ones(n, bool),
        )
    )


def make_box(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    return make_polygon(F.array(minx, maxx, maxx, minx, minx), F.array(miny, miny, maxy, maxy, miny))


def point_wkb(x: float, y: float) -> bytes:
    return sh.write_tree(sh.POINT, np.array([[x, y]]))


def box_wkb(minx: float, miny: float, maxx: float, maxy: float) -> bytes:
    ring = np.array([[minx, miny], [maxx, miny], [maxx, maxy], [minx, maxy], [minx, miny]])
    return sh.write_tree(sh.POLYGON, [ring])


def signature(wkb: Column) -> Column:
    """Digest that stands for a geometry in grouping keys."""
    return F.sha2(wkb, 256)

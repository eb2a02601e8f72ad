"""Coordinate and topology checks with reasons, and repair of invalid polygons."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from talweg.functions import arrange, sweep
from talweg.functions import topology as topo
from talweg.functions.shapes import (
    COLLECTION, KINDS, LINE, MULTIPOLYGON, POINT, POLYGON, ROLE_HOLE, ROLE_LINE, ROLE_SHELL,
    Shapes, read_shapes, read_tree, runs, write_shapes, write_tree,
)

# Reason texts.
NULL_GEOMETRY = "Geometria nula."
EMPTY_GEOMETRY = "Geometria vazia."
SAFE_REPAIR_NULL = "Geometria ficou nula apos tentativa de reparo seguro."
BAD_ORDINATE = "{label}: eixo {axis} com valor invalido ({value})."
FEW_POINTS = "{label}: quantidade insuficiente de pontos ({count})."
FEW_DISTINCT = "{label}: precisa de pelo menos 2 pontos distintos."
OPEN_RING = "{label}: anel nao esta fechado."
OUT_OF_RANGE = (
    "{label}: bounds incompativeis com o CRS geografico {crs} "
    "(minx={0}, miny={1}, maxx={2}, maxy={3})."
)
NO_PARTS = "{label} sem geometrias."
NOT_VALID = "Geometria invalida segundo OGC: {reason}."
OPEN_SHELL = "Polygon: anel externo nao esta fechado."
OPEN_HOLE = "Polygon: buraco {index} nao esta fechado."
SHELL_LABEL, HOLE_LABEL = "{label} - anel externo", "{label} - buraco {index}"
SRID_MISSING = "SRID ausente. Esperado: {expected}."
SRID_MISMATCH = "SRID incompativel. Atual: {actual}. Esperado: {expected}."
CRS_MISSING = "CRS ausente. Esperado: {expected}."
CRS_MISMATCH = "CRS incompativel. Atual: {actual}. Esperado: {expected}."


def _at(reason: str, point) -> str:
    return f"{reason}[{point[0]:.15g} {point[1]:.15g}]"


def _path_errors(path, label, minimum, closed):
    errors = []
    if len(path) < minimum:
        errors.append(FEW_POINTS.format(label=label, count=len(path)))
    finite = np.isfinite(path)
    if not finite.all():
        for row, axis in np.argwhere(~finite):
            errors.append(BAD_ORDINATE.format(label=label, axis=axis, value=path[row, axis]))
    if len(path) < 2 or (path[1:, :2] == path[0, :2]).all():
        errors.append(FEW_DISTINCT.format(label=label))
    if closed and len(path) and (path[0] != path[-1]).any():
        errors.append(OPEN_RING.format(label=label))
    return errors


def _range_errors(paths, label, crs, geographic):
    xy = np.concatenate([p[:, :2] for p in paths])
    low, high = xy.min(axis=0), xy.max(axis=0)
    limit = np.array([180.0, 90.0])
    if not geographic or ((np.abs(low) <= limit) & (np.abs(high) <= limit)).all():
        return []
    box = [float(v) for v in (*low, *high)]
    return [OUT_OF_RANGE.format(*box, label=label, crs=crs)]


def _is_empty(tree) -> bool:
    kind, _, payload = tree
    if kind in (POINT, LINE):
        return not len(payload)
    return all(not len(p) for p in payload) if kind == POLYGON else all(map(_is_empty, payload))


def coordinate_errors(tree, crs, geographic) -> list[str]:
    kind, _, payload = tree
    label = KINDS[kind]
    if _is_empty(tree):
        return [EMPTY_GEOMETRY]
    if kind == POINT:
        errors = [
            BAD_ORDINATE.format(label=label, axis=axis, value=value)
            for axis, value in enumerate(payload[0]) if not np.isfinite(value)
        ]
        return errors + _range_errors([payload], label, crs, geographic)
    if kind == LINE:
        return _path_errors(payload, label, 2, False) + _range_errors([payload], label, crs, geographic)
    if kind == POLYGON:
        errors = _path_errors(payload[0], SHELL_LABEL.format(label=label), 4, True)
        for i, hole in enumerate(payload[1:], 1):
            errors += _path_errors(hole, HOLE_LABEL.format(label=label, index=i), 4, True)
        return errors + _range_errors(payload[:1], label, crs, geographic)
    errors = [] if payload else [NO_PARTS.format(label=label)]
    for i, part in enumerate(payload, 1):
        errors += [f"{label}[{i}]: {e}" for e in coordinate_errors(part, crs, geographic)]
    return errors


def invalid_reason(tree) -> str | None:
    """Why a geometry is not valid, None when it is."""
    kind, _, payload = tree
    if kind == POINT:
        return None if np.isfinite(payload[:, :2]).all() else _at("Invalid Coordinate", payload[0])
    if kind == LINE:
        if not np.isfinite(payload[:, :2]).all():
            return _at("Invalid Coordinate", payload[~np.isfinite(payload[:, :2]).all(axis=1)][0])
        if len(payload) and len(topo.drop_repeats(payload[:, :2])) < 2:
            return _at("Too few points in geometry component", payload[0])
        return None
    if kind == POLYGON:
        return _polygon_reason([r[:, :2] for r in payload if len(r)])
    for part in payload:
        reason = invalid_reason(part)
        if reason:
            return reason
    return _shells_reason(payload) if kind == MULTIPOLYGON else None


def _polygon_reason(rings):
    cleaned = []
    for ring in rings:
        finite = np.isfinite(ring).all(axis=1)
        if not finite.all():
            return _at("Invalid Coordinate", ring[~finite][0])
        if (ring[0] != ring[-1]).any():
            return _at("Ring is not closed", ring[0])
        ring = topo.drop_repeats(ring)
        if len(ring) < 4:
            return _at("Too few points in geometry component", ring[0])
        cleaned.append(ring)
    for ring in cleaned:
        clash = topo.ring_clash(ring)
        if clash is not None:
            return _at("Self-intersection" if clash[1] else "Ring Self-intersection", clash[0])
    if not cleaned:
        return None
    shell, holes = cleaned[0], cleaned[1:]
    for i, hole in enumerate(holes):
        for other in [shell, *holes[:i]]:
            point = topo.edges_contact(hole, other, topo.segments_cross)
            if point is not None:
                return _at("Self-intersection", point)
        if topo.side_of(hole, shell) < 0:
            return _at("Hole lies outside shell", hole[0])
    for i, hole in enumerate(holes):
        for other in holes[:i]:
            if topo.side_of(hole, other) > 0 or topo.side_of(other, hole) > 0:
                return _at("Holes are nested", hole[0])
    return None


def _shells_reason(parts):
    polygons = [[topo.drop_repeats(r[:, :2]) for r in p[2] if len(r)] for p in parts]
    polygons = [p for p in polygons if p]
    if not polygons:
        return None
    boxes = np.array([[*p[0].min(axis=0), *p[0].max(axis=0)] for p in polygons])
    for i, js in topo.candidate_pairs(boxes, boxes):
        for j in js[js > i]:
            one, two = polygons[i], polygons[j]
            for a in one:
                for b in two:
                    point = topo.edges_contact(a, b, topo.segments_cross)
                    if point is not None:
                        return _at("Self-intersection", point)
            for inner, outer in ((one, two), (two, one)):
                in_hole = any(topo.side_of(inner[0], hole) > 0 for hole in outer[1:])
                if not in_hole and topo.side_of(inner[0], outer[0]) > 0:
                    return _at("Nested shells", inner[0][0])
    return None


def topology_errors(tree) -> list[str]:
    kind, _, payload = tree
    if _is_empty(tree):
        return [EMPTY_GEOMETRY]
    reason = invalid_reason(tree)
    errors = [NOT_VALID.format(reason=reason)] if reason else []
    if kind == POLYGON:
        for i, ring in enumerate(payload):
            if len(ring) and (ring[0] != ring[-1]).any():
                errors.append(OPEN_HOLE.format(index=i) if i else OPEN_SHELL)
    elif kind in (MULTIPOLYGON, COLLECTION):
        for i, part in enumerate(payload, 1):
            errors += [f"{KINDS[kind]}[{i}]: {e}" for e in topology_errors(part)]
    return errors


#: What array tests tell of a geometry's topology; unsure ones are looked at one by one.
SOUND, BROKEN, UNSURE = range(3)


def states(s: Shapes) -> np.ndarray:
    """Topological state of every geometry, from one sweep over all segments of the batch.

    Unsure are collections, geometries with empty parts or non-finite coordinates, and polygons whose rings touch each other.
    """
    n = len(s)
    state = np.zeros(n, "i1")
    state[(s.kind == COLLECTION) | ~(s.whole | s.null)] = UNSURE
    if not len(s.ring_geom):
        return state
    state[s.vertex_geom[~np.isfinite(s.xy).all(axis=1)]] = UNSURE
    first = s.ring_start[:-1]
    moves = (s.xy != np.repeat(s.xy[first], s.ring_size, axis=0)).any(axis=1)
    state[s.ring_geom[(s.ring_role == ROLE_LINE) & ~np.logical_or.reduceat(moves, first)]] = UNSURE
    open_ = (s.xy[first] != s.xy[s.ring_start[1:] - 1]).any(axis=1)
    areal = (s.ring_role >= ROLE_SHELL) & (state[s.ring_geom] == SOUND)
    state[s.ring_geom[areal & (open_ | (s.ring_size < 4))]] = BROKEN
    rings = np.flatnonzero(areal & (state[s.ring_geom] == SOUND))
    geom, hole, poly = s.ring_geom[rings], s.ring_role[rings] == ROLE_HOLE, s.ring_poly[rings]
    segments = sweep.Segments(s.xy, first[rings], s.ring_size[rings])
    state[geom[segments.size < 3]] = BROKEN
    state[geom[segments.ring[segments.spikes()]]] = BROKEN
    owner, touching = geom[segments.ring], np.zeros(n, bool)
    for i, j, cross in segments.contacts(owner):
        state[owner[i[cross | (segments.ring[i] == segments.ring[j])]]] = BROKEN
        touching[owner[i]] = True
    state[touching & (state == SOUND)] = UNSURE
    several = np.bincount(geom, minlength=n)[geom] > 1
    if several.any():
        rest = np.flatnonzero(several & (state[geom] == SOUND))
        some = sweep.Segments(s.xy, first[rings][rest], s.ring_size[rings][rest])
        state[geom[rest][sweep.misplaced(some, geom[rest], poly[rest], hole[rest])]] = BROKEN
    return state


def quick_valid(s: Shapes, geographic: np.ndarray) -> np.ndarray:
    """Rows that certainly pass every check, decided with whole-batch array tests."""
    good = ~s.null & ~s.empty & s.extra_ok & s.whole
    if not len(s.ring_geom):
        return good
    with np.errstate(invalid="ignore"):
        in_range = (np.abs(s.xy[:, 0]) <= 180) & (np.abs(s.xy[:, 1]) <= 90)
    vertex_geom = s.vertex_geom
    good[vertex_geom[~in_range & geographic[vertex_geom]]] = False
    good[vertex_geom[~np.isfinite(s.xy).all(axis=1)]] = False
    good[s.ring_geom[(s.ring_role == ROLE_LINE) & (s.ring_size < 2)]] = False
    return good & (states(s) == SOUND)


def ogc_errors(raw: bytes | None, crs: str | None, geographic: bool) -> list[str]:
    """All errors of one geometry: type, coordinates, topology, reference system."""
    if raw is None:
        return [NULL_GEOMETRY] * 4
    tree, _ = read_tree(raw)
    return coordinate_errors(tree, crs, geographic) + topology_errors(tree)


def _broken(s: Shapes, raw: pa.Array) -> np.ndarray:
    """Rows that are not valid; null and empty ones don't count."""
    state = states(s)
    state[s.null | s.empty] = SOUND
    for i in np.flatnonzero(state == UNSURE):
        state[i] = BROKEN if invalid_reason(read_tree(raw[i].as_buffer())[0]) else SOUND
    return np.flatnonzero(state == BROKEN)


def repair(raw: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Valid counterparts of a batch, and which rows changed.

    Broken areas become what their rings wind around, shells counter-clockwise less holes, all of a batch in one arrangement; lines
    and points of such geometries are left out. Null are those with non-finite coordinates, without any ring of three sides, or not valid even then.
    """
    s = read_shapes(raw)
    rows = _broken(s, raw)
    changed = np.zeros(len(s), bool)
    changed[rows] = True
    if not len(rows):
        return raw, changed
    part = s.take(rows)
    lost = np.zeros(len(part), bool)
    lost[part.vertex_geom[~np.isfinite(part.xy).all(axis=1)]] = True
    fixed, failed = _rebuilt(part, lost)
    lost[list(failed)] = True
    text = write_shapes(fixed)
    lost[_broken(fixed, text)] = True
    place = np.zeros(len(s), "i8")
    place[rows] = np.arange(len(rows))
    mended = pc.if_else(pa.array(lost), pa.nulls(len(part), pa.binary()), text).take(pa.array(place))
    return pc.if_else(pa.array(changed), mended, raw.cast(pa.binary())), changed


def _rebuilt(s: Shapes, skip: np.ndarray) -> tuple[Shapes, set[int]]:
    """The areas of all geometries but the skipped ones, and those without a result."""
    rings = np.flatnonzero((s.ring_role >= ROLE_SHELL) & ~skip[s.ring_geom])
    start, size = s.ring_start[:-1][rings], s.ring_size[rings]
    open_ = (s.xy[start] != s.xy[start + size - 1]).any(axis=1)
    vertex = runs(start, size + open_)
    vertex[np.cumsum(size + open_)[open_] - 1] = start[open_]  # back to the first point
    xy, size = s.xy[vertex], size + open_
    start = np.cumsum(size) - size
    hole, poly, geom = s.ring_role[rings] == ROLE_HOLE, s.ring_poly[rings], s.ring_geom[rings]
    sides = sweep.Segments(xy, start, size).size
    flat = np.unique(poly[(sides < 3) & ~hole])
    use = (sides >= 3) & ~np.isin(poly, flat)
    found, failed = arrange.areas(xy, start[use], size[use], geom[use], hole[use])
    failed |= set(np.setdiff1d(geom, geom[use]).tolist())
    return polygonal(len(s), found), failed


def polygonal(n: int, found: dict[int, list[list[np.ndarray]]]) -> Shapes:
    """A batch of ``n`` polygons or multipolygons from their rings; the others are empty polygons."""
    rings, geoms, roles, polys, kind, poly = [], [], [], [], np.full(n, POLYGON, "i4"), 0
    for g in sorted(found):
        kind[g] = POLYGON if len(found[g]) < 2 else MULTIPOLYGON
        for part in found[g]:
            for place, ring in enumerate(part):
                rings.append(ring)
                geoms.append(g)
                roles.append(ROLE_HOLE if place else ROLE_SHELL)
                polys.append(poly)
            poly += 1
    sizes = np.array([len(r) for r in rings], "i8")
    return Shapes(
        np.zeros(n, bool), kind, np.full(n, 2, "i4"), np.concatenate(rings) if rings else np.empty((0, 2)),
        np.concatenate([[0], np.cumsum(sizes)]).astype("i8"), np.array(geoms, "i8"), np.array(roles, "i4"), np.array(polys, "i8"),
        np.ones(n, bool), np.ones(n, bool),
    )


def normalized(raw: pa.Array) -> pa.Array:
    """Repaired 2-D geometries with counter-clockwise shells and clockwise holes."""
    fixed, _ = repair(raw)
    s = read_shapes(fixed)
    segments = sweep.Segments(s.xy, s.ring_start[:-1], s.ring_size)
    origin = s.xy[s.ring_start[:-1]][segments.ring]
    a, b = segments.a - origin, segments.b - origin
    area = np.bincount(segments.ring, a[:, 0] * b[:, 1] - b[:, 0] * a[:, 1], len(s.ring_geom))
    turned = (s.ring_role >= ROLE_SHELL) & ((area > 0) == (s.ring_role == ROLE_HOLE))
    ring = np.repeat(np.arange(len(s.ring_geom)), s.ring_size)
    mirrored = s.ring_start[:-1][ring] + s.ring_start[1:][ring] - 1 - np.arange(len(s.xy))
    s.xy = s.xy[np.where(turned[ring], mirrored, np.arange(len(s.xy)))]
    return flat(s, fixed)


def flat(s: Shapes, raw: pa.Array) -> pa.Array:
    """2-D WKB of a batch; collections and geometries with empty parts, which rings don't tell whole, one by one."""
    out = write_shapes(s)
    odd = np.flatnonzero(~s.whole & ~s.null)
    if not len(odd):
        return out
    trees = [read_tree(raw[i].as_buffer())[0] for i in odd.tolist()]
    place = np.zeros(len(s), "i8")
    place[odd] = np.arange(len(odd))
    return pc.if_else(pa.array(~(s.null | s.whole)), pa.array([write_tree(t[0], t[2]) for t in trees], pa.binary()).take(pa.array(place)), out)

"""Planar tests on single rings and polygons: simplicity, containment, crossing, clipping."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

VECTOR_LIMIT = 64  # rings up to this many segments are tested as one batch per size


def _orient(a, b, c):
    return (b[..., 0] - a[..., 0]) * (c[..., 1] - a[..., 1]) - (b[..., 1] - a[..., 1]) * (
        c[..., 0] - a[..., 0]
    )


def _on_box(a, b, p):
    return (
        (np.minimum(a[..., 0], b[..., 0]) <= p[..., 0]) & (p[..., 0] <= np.maximum(a[..., 0], b[..., 0]))
        & (np.minimum(a[..., 1], b[..., 1]) <= p[..., 1]) & (p[..., 1] <= np.maximum(a[..., 1], b[..., 1]))
    )


def segments_meet(p, q, r, s):
    """Closed segments pq and rs share a point."""
    d1, d2, d3, d4 = _orient(p, q, r), _orient(p, q, s), _orient(r, s, p), _orient(r, s, q)
    cross = (np.sign(d1) * np.sign(d2) < 0) & (np.sign(d3) * np.sign(d4) < 0)
    touch = (
        ((d1 == 0) & _on_box(p, q, r)) | ((d2 == 0) & _on_box(p, q, s))
        | ((d3 == 0) & _on_box(r, s, p)) | ((d4 == 0) & _on_box(r, s, q))
    )
    return cross | touch


def segments_cross(p, q, r, s):
    """The interiors of pq and rs meet: a proper crossing or a collinear overlap."""
    d1, d2, d3, d4 = _orient(p, q, r), _orient(p, q, s), _orient(r, s, p), _orient(r, s, q)
    proper = (np.sign(d1) * np.sign(d2) < 0) & (np.sign(d3) * np.sign(d4) < 0)
    flat = (d1 == 0) & (d2 == 0)
    axis = np.abs(q - p).argmax(axis=-1)
    take = lambda v: np.take_along_axis(v, axis[..., None], -1)[..., 0]
    lo = np.maximum(np.minimum(take(p), take(q)), np.minimum(take(r), take(s)))
    hi = np.minimum(np.maximum(take(p), take(q)), np.maximum(take(r), take(s)))
    return proper | (flat & (lo < hi))


def drop_repeats(ring: np.ndarray) -> np.ndarray:
    if len(ring) < 2:
        return ring
    keep = np.ones(len(ring), bool)
    keep[1:] = (ring[1:] != ring[:-1]).any(axis=1)
    return ring[keep]


def candidate_pairs(box_a: np.ndarray, box_b: np.ndarray):
    """Index pairs of overlapping boxes, by a sorted sweep along x in bounded blocks."""
    order = np.argsort(box_b[:, 0], kind="stable")
    low = box_b[order, 0]
    widest = (box_b[:, 2] - box_b[:, 0]).max() if len(box_b) else 0.0
    first = np.searchsorted(low, box_a[:, 0] - widest, "left")
    last = np.searchsorted(low, box_a[:, 2], "right")
    for i in range(len(box_a)):
        j = order[first[i] : last[i]]
        hit = (
            (box_b[j, 2] >= box_a[i, 0]) & (box_b[j, 1] <= box_a[i, 3]) & (box_b[j, 3] >= box_a[i, 1])
        )
        if hit.any():
            yield i, j[hit]


def _segment_boxes(a, b):
    return np.concatenate([np.minimum(a, b), np.maximum(a, b)], axis=1)


def ring_clash(ring: np.ndarray):
    """A point where a closed ring without repeats touches itself, or None; the flag tells a crossing."""
    a, b = ring[:-1], ring[1:]
    m = len(a)
    if m < 3:
        return ring[0], True
    after = np.roll(b, -1, axis=0)
    spike = (_orient(a, b, after) == 0) & (((b - a) * (after - b)).sum(axis=1) < 0)
    if spike.any():
        return b[np.flatnonzero(spike)[0]], True
    touch = None
    for i, j in _meeting_pairs(a, b):
        if segments_cross(a[i : i + 1], b[i : i + 1], a[j : j + 1], b[j : j + 1])[0]:
            return crossing_point(a[i], b[i], a[j], b[j]), True
        if touch is None:
            touch = crossing_point(a[i], b[i], a[j], b[j])
    return (touch, False) if touch is not None else None


@lru_cache(maxsize=VECTOR_LIMIT)
def _apart(m: int):
    """Index pairs of the segments of a closed ring that are not neighbours."""
    i, j = np.triu_indices(m, 2)
    keep = ~((i == 0) & (j == m - 1))
    return i[keep], j[keep]


def _meeting_pairs(a, b):
    """Non-neighbouring segments of a closed ring that share a point."""
    m = len(a)
    if m <= VECTOR_LIMIT:
        i, j = _apart(m)
        hit = segments_meet(a[i], b[i], a[j], b[j])
        yield from zip(i[hit], j[hit])
        return
    boxes = _segment_boxes(a, b)
    for i, js in candidate_pairs(boxes, boxes):
        js = js[(js > i + 1) & ~((i == 0) & (js == m - 1))]
        if len(js):
            p, q = np.broadcast_to(a[i], (len(js), 2)), np.broadcast_to(b[i], (len(js), 2))
            for j in js[segments_meet(p, q, a[js], b[js])]:
                yield i, j


def crossing_point(p, q, r, s):
    d = (q[0] - p[0]) * (s[1] - r[1]) - (q[1] - p[1]) * (s[0] - r[0])
    if d == 0:
        for point in (r, s, p, q):
            if _on_box(p, q, point) and _on_box(r, s, point):
                return point
        return r
    t = ((r[0] - p[0]) * (s[1] - r[1]) - (r[1] - p[1]) * (s[0] - r[0])) / d
    return p + t * (q - p)


def ring_area(ring: np.ndarray) -> float:
    v = ring - ring[0]
    return float((v[:-1, 0] * v[1:, 1] - v[1:, 0] * v[:-1, 1]).sum() / 2)


def locate(points: np.ndarray, rings: list[np.ndarray]) -> np.ndarray:
    """+1 inside, 0 on the boundary, -1 outside of the even-odd area of the rings."""
    inside = np.zeros(len(points), bool)
    edge = np.zeros(len(points), bool)
    for ring in rings:
        block = max(1, 4_000_000 // max(1, len(ring)))
        for at in range(0, len(points), block):
            p = points[at : at + block][:, None, :]
            a, b = ring[None, :-1], ring[None, 1:]
            turn = _orient(a, b, p)
            edge[at : at + block] |= ((turn == 0) & _on_box(a, b, p)).any(axis=1)
            upward = (a[..., 1] <= p[..., 1]) & (b[..., 1] > p[..., 1]) & (turn > 0)
            downward = (b[..., 1] <= p[..., 1]) & (a[..., 1] > p[..., 1]) & (turn < 0)
            inside[at : at + block] ^= ((upward | downward).sum(axis=1) % 2).astype(bool)
    return np.where(edge, 0, np.where(inside, 1, -1))


def edges_contact(one: np.ndarray, two: np.ndarray, test) -> np.ndarray | None:
    """First point where segments of two paths satisfy ``test``."""
    if len(one) < 2 or len(two) < 2:
        return None
    a, b, c, d = one[:-1], one[1:], two[:-1], two[1:]
    for i, js in candidate_pairs(_segment_boxes(a, b), _segment_boxes(c, d)):
        p, q = np.broadcast_to(a[i], (len(js), 2)), np.broadcast_to(b[i], (len(js), 2))
        hit = js[test(p, q, c[js], d[js])]
        if len(hit):
            return crossing_point(a[i], b[i], c[hit[0]], d[hit[0]])
    return None


def side_of(inner: np.ndarray, outer: np.ndarray) -> int:
    """Where a ring lies relative to another it does not cross: +1 inside, -1 outside."""
    places = locate(inner[:-1], [outer])
    for place in places:
        if place:
            return int(place)
    middle = locate((inner[:-1] + inner[1:]) / 2, [outer])
    decided = middle[middle != 0]
    return int(decided[0]) if len(decided) else 1


def clip_half(rings: list[np.ndarray], axis: int, sign: float, limit: float) -> list[np.ndarray]:
    """Cut closed rings (shells counter-clockwise, holes clockwise) by one half-plane.

    Inside chains end on the cutting line; sorted along it, consecutive ends
    bound the interior, which gives the closing edges and so the separate parts.
    """
    kept, chains = [], []
    for ring in rings:
        depth = (ring[:-1, axis] - limit) * sign
        inside = depth >= 0
        if inside.all():
            kept.append(ring)
            continue
        if not inside.any():
            continue
        first = int(np.flatnonzero(~inside)[0])
        order = (np.arange(len(depth) + 1) + first) % len(depth)  # from an outside point around to it
        v, d, flag = ring[:-1][order], depth[order], inside[order]
        enter, leave = np.flatnonzero(~flag[:-1] & flag[1:]), np.flatnonzero(flag[:-1] & ~flag[1:])
        ends = np.concatenate([enter, leave])
        cut = v[ends] + (d[ends] / (d[ends] - d[ends + 1]))[:, None] * (v[ends + 1] - v[ends])
        cut[:, axis] = limit
        for i, (start, stop) in enumerate(zip(enter.tolist(), leave.tolist())):
            chains.append(np.concatenate([cut[i : i + 1], v[start + 1 : stop + 1], cut[len(enter) + i : len(enter) + i + 1]]))
    if not chains:
        return kept
    other = 1 - axis
    ends = [(c[0][other], 0, i) for i, c in enumerate(chains)] + [
        (c[-1][other], 1, i) for i, c in enumerate(chains)
    ]
    ends.sort()
    partner = {}
    for one, two in zip(ends[::2], ends[1::2]):
        partner[one[1:]], partner[two[1:]] = two[1:], one[1:]
    used = set()
    for start in range(len(chains)):
        if start in used:
            continue
        path, at = [], start
        while at not in used:
            used.add(at)
            path.append(chains[at])
            role, at = partner[(1, at)]
            if role == 1:  # equal ends tied in the sort: close on the chain itself
                at = start
        ring = drop_repeats(np.concatenate(path + [path[0][:1]]))
        if len(ring) >= 4 and ring_area(ring) != 0:
            kept.append(ring)
    return kept


def nest_rings(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Group counter-clockwise shells with the clockwise holes they contain."""
    shells = [[r] for r in rings if ring_area(r) > 0]
    for hole in (r for r in rings if ring_area(r) < 0):
        owners = [s for s in shells if side_of(hole, s[0]) > 0]
        if owners:
            min(owners, key=lambda s: abs(ring_area(s[0]))).append(hole)
    return shells


def oriented(rings: list[np.ndarray]) -> list[np.ndarray]:
    """First ring counter-clockwise, the others clockwise."""
    return [
        ring if (ring_area(ring) > 0) == (i == 0) else ring[::-1] for i, ring in enumerate(rings)
    ]


def clip_polygon(rings: list[np.ndarray], box) -> list[list[np.ndarray]]:
    minx, miny, maxx, maxy = box
    out = oriented(rings)
    for axis, sign, limit in ((0, 1, minx), (0, -1, maxx), (1, 1, miny), (1, -1, maxy)):
        out = clip_half(out, axis, sign, limit)
    return nest_rings(out)


def clip_line(line: np.ndarray, box) -> list[np.ndarray]:
    """Liang-Barsky per segment, joined into paths; a single touching point is a path of one."""
    lo, hi = np.array(box[:2]), np.array(box[2:])
    paths: list[list[np.ndarray]] = []
    for a, b in zip(line[:-1], line[1:]):
        step, t0, t1 = b - a, 0.0, 1.0
        for k in (0, 1):
            if step[k] == 0:
                if not lo[k] <= a[k] <= hi[k]:
                    t0, t1 = 1.0, 0.0
                continue
            near, far = sorted(((lo[k] - a[k]) / step[k], (hi[k] - a[k]) / step[k]))
            t0, t1 = max(t0, near), min(t1, far)
        if t0 > t1:
            continue
        p, q = a + t0 * step if t0 else a, a + t1 * step if t1 < 1 else b
        if paths and (paths[-1][-1] == p).all():
            paths[-1].append(q)
        else:
            paths.append([p, q])
    pieces = [drop_repeats(np.array(path)) for path in paths]
    return [p for p in pieces if len(p) > 1] or [p[:1] for p in pieces[:1]]

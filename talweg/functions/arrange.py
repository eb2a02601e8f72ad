"""Areas of overlapping rings by a noded arrangement, for all geometries of a batch together.

Segments of all rings are split where they meet. Equal pieces become one edge that knows by how much the winding number grows from its right
to its left side. Edges with the wanted area on one side only are its boundary; they are chained around faces into rings.
"""

from __future__ import annotations

import numpy as np

from talweg.functions import topology as topo
from talweg.functions.sweep import Segments, overlapping, segment_boxes

#: Rounds of splitting after which rounding errors count as not settled, and the share of the largest coordinate that they may have.
ROUNDS, ROUNDING = 12, 1e-12


def turns(segments: Segments, rings: int) -> np.ndarray:
    """+1 for rings that are counter-clockwise at their topmost point, -1 for others, 0 for rings without segments."""
    out = np.zeros(rings)
    order = np.lexsort((segments.b[:, 0], segments.b[:, 1], segments.ring))
    last = np.cumsum(np.bincount(segments.ring, minlength=rings)) - 1
    used = np.flatnonzero(segments.size)
    top = order[last[used]]
    turn = np.sign(topo._orient(segments.a[top], segments.b[top], segments.b[segments.next[top]]))
    moment = np.bincount(segments.ring, segments.a[:, 0] * segments.b[:, 1] - segments.b[:, 0] * segments.a[:, 1], rings)
    out[used] = np.where(turn != 0, turn, np.sign(moment[used]))
    return out


def _crossings(p, q, r, s):
    """Crossing points of segments that cross; on axis-parallel segments exactly."""
    d, e = q - p, s - r
    t = ((r[:, 0] - p[:, 0]) * e[:, 1] - (r[:, 1] - p[:, 1]) * e[:, 0]) / (d[:, 0] * e[:, 1] - d[:, 1] * e[:, 0])
    out = p + t[:, None] * d
    for k in (0, 1):
        out[:, k] = np.where(d[:, k] == 0, p[:, k], np.where(e[:, k] == 0, r[:, k], out[:, k]))
    for end in (p, q, r, s):  # a crossing that rounding keeps from an end is that end
        near = np.abs(out - end).max(axis=1) <= ROUNDING * np.abs(end).max(axis=1)
        out[near] = end[near]
    return out


def _on(turn, a, b, p):
    """Points on a segment, up to rounding."""
    slack = ROUNDING * np.abs(p).max(axis=1)
    low, high = np.minimum(a, b) - slack[:, None], np.maximum(a, b) + slack[:, None]
    return (np.abs(turn) <= slack * np.abs(b - a).max(axis=1)) & (low <= p).all(axis=1) & (p <= high).all(axis=1)


def _merged(a, b, geom, given, given_geom):
    """End points that rounding keeps apart as one point; points that were given come before computed ones."""
    keys, number = np.unique(
        np.concatenate([np.column_stack([given_geom, given]), np.column_stack([geom, a]), np.column_stack([geom, b])]), axis=0, return_inverse=True
    )
    number, points = number.ravel(), keys[:, 1:]
    slack = ROUNDING * np.abs(points).max(axis=1, keepdims=True)
    pairs = [np.stack(p) for p in overlapping(np.concatenate([points - slack, points + slack], axis=1), keys[:, 0].astype(np.int64))]
    if not pairs:
        return a, b
    i, j = np.concatenate(pairs, axis=1)
    rank = np.arange(len(points)) + len(points)
    rank[number[: len(given)]] -= len(points)
    named = np.empty(2 * len(points), np.int64)
    named[rank] = np.arange(len(points))
    while True:
        least = rank.copy()
        np.minimum.at(least, i, rank[j])
        np.minimum.at(least, j, rank[i])
        if (least == rank).all():
            break
        rank = least
    own = named[rank][number]
    n = len(a)
    return points[own[len(given) : len(given) + n]], points[own[len(given) + n :]]


def _noded(a, b, geom):
    """Segments split until they share end points only; segments keep their direction. The last array marks geometries that don't settle."""
    weight = np.arange(len(a))  # the segment that a piece comes from
    unsettled, given, given_geom = np.empty(0, geom.dtype), a, geom
    for number in range(ROUNDS):
        if number:
            a, b = _merged(a, b, geom, given, given_geom)
            real = (a != b).any(axis=1)
            a, b, geom, weight = a[real], b[real], geom[real], weight[real]
        at, points = [], []
        for i, j in overlapping(segment_boxes(a, b), geom):
            p, q, r, s = a[i], b[i], a[j], b[j]
            d1, d2, d3, d4 = topo._orient(p, q, r), topo._orient(p, q, s), topo._orient(r, s, p), topo._orient(r, s, q)
            cross = (np.sign(d1) * np.sign(d2) < 0) & (np.sign(d3) * np.sign(d4) < 0)
            if cross.any():
                x = _crossings(p[cross], q[cross], r[cross], s[cross])
                at += [i[cross], j[cross]]
                points += [x, x]
            for turn, one, two, point, row in ((d1, p, q, r, i), (d2, p, q, s, i), (d3, r, s, p, j), (d4, r, s, q, j)):
                on = _on(turn, one, two, point) & (point != one).any(axis=1) & (point != two).any(axis=1)
                if on.any():
                    at.append(row[on])
                    points.append(point[on])
        at = np.concatenate(at) if at else np.empty(0, np.int64)
        points = np.concatenate(points) if len(at) else np.empty((0, 2))
        new = (points != a[at]).any(axis=1) & (points != b[at]).any(axis=1)
        at, points = at[new], points[new]
        unsettled = np.unique(geom[at])
        if not len(at):
            break
        n = len(a)
        row = np.concatenate([np.arange(n), at, np.arange(n)])
        xy = np.concatenate([a, points, b])
        along = ((xy - a[row]) * (b - a)[row]).sum(axis=1)
        along[:n], along[-n:] = -np.inf, np.inf
        order = np.lexsort((along, row))
        row, xy = row[order], xy[order]
        piece = np.flatnonzero((row[:-1] == row[1:]) & (xy[:-1] != xy[1:]).any(axis=1))
        source = row[piece]
        a, b, geom, weight = xy[piece], xy[piece + 1], geom[source], weight[source]
    return a, b, geom, weight, unsettled


def _edges(a, b, geom, sign):
    """(points, u, v, geom, w): edges between numbered points, u before v in order of x and y, with the winding gained from right to left."""
    keys = np.concatenate([np.column_stack([geom, a]), np.column_stack([geom, b])])
    points, number = np.unique(keys, axis=0, return_inverse=True)
    u, v = np.split(number.ravel(), 2)
    w = np.where(u < v, sign, -sign)
    u, v = np.minimum(u, v), np.maximum(u, v)
    pair, first, place = np.unique(u * len(points) + v, return_index=True, return_inverse=True)
    w = np.bincount(place.ravel(), w, len(pair))
    keep = w != 0
    first = first[keep]
    return points[:, 1:], u[first], v[first], geom[first], w[keep].astype(np.int64)


def _left(points, u, v, geom, w):
    """Winding number on the left of each edge: minus what an upward ray from just left of its middle gains."""
    n = len(u)
    a, b = points[u], points[v]
    middle = (a + b) / 2
    rays = np.column_stack([middle, middle[:, 0], np.full(n, np.inf)])
    out = np.zeros(n, np.int64)
    for i, j in overlapping(np.concatenate([segment_boxes(a, b), rays]), np.concatenate([geom, geom])):
        mixed = (i < n) != (j < n)
        edge, ray = np.minimum(i, j)[mixed], np.maximum(i, j)[mixed] - n
        x, upright = middle[ray, 0], a[ray, 0] == b[ray, 0]
        # Just left of an upright edge lies a little before its x; otherwise just above the edge is meant.
        over = np.where(upright, (a[edge, 0] < x) & (x <= b[edge, 0]), (a[edge, 0] <= x) & (x < b[edge, 0]))
        over &= (edge != ray) & (topo._orient(a[edge], b[edge], middle[ray]) < 0)
        np.subtract.at(out, ray[over], w[edge[over]])
    return out


def _chained(points, start, stop):
    """Ring number and place of each directed boundary edge, whose left is the area, and which edges have no follower of their own."""
    n = len(start)
    spokes = np.concatenate([start, stop])
    d = points[np.concatenate([stop, start])] - points[spokes]
    order = np.lexsort((np.arctan2(d[:, 1], d[:, 0]), spokes))
    # Around a point, arriving and leaving edges alternate; the area left of an arriving one ends clockwise at a leaving one.
    first = np.searchsorted(spokes[order], spokes[order], "left")
    last = np.searchsorted(spokes[order], spokes[order], "right") - 1
    place = np.arange(2 * n)
    before = order[np.where(place == first, last, place - 1)]
    follows = np.empty(2 * n, np.int64)
    follows[order] = before
    then = follows[n:] % n
    lost = (follows[n:] >= n) | (np.bincount(then, minlength=n)[then] > 1)
    if lost.any():
        return None, None, lost
    label, jump = np.arange(n), then.copy()
    for _ in range(max(1, int(n).bit_length())):
        label, jump = np.minimum(label, label[jump]), jump[jump]
    root = label == np.arange(n)
    left, jump = np.where(root, 0, 1), np.where(root, np.arange(n), then)
    for _ in range(max(1, int(n).bit_length())):
        left, jump = left + left[jump], jump[jump]
    size = np.bincount(label, minlength=n)
    return label, np.where(root, 0, size[label] - left), lost


def _split(vertices: list[int]) -> list[list[int]]:
    """Loops of a ring at the points that it visits again."""
    found, stack, seen = [], [], {}
    for v in vertices:
        if v in seen:
            at = seen[v]
            found.append(stack[at:])
            for gone in stack[at + 1 :]:
                del seen[gone]
            del stack[at + 1 :]
        else:
            seen[v] = len(stack)
            stack.append(v)
    return [loop for loop in (*found, stack) if len(loop) > 2]


def areas(xy: np.ndarray, starts: np.ndarray, sizes: np.ndarray, geom: np.ndarray, hole: np.ndarray, least: int = 1):
    """Rings around the points whose winding number is ``least`` or more: ({geometry: polygons}, geometries without a result).

    Rings are closed runs of ``xy``. Shells count as counter-clockwise and holes as clockwise, by their topmost point. With ``least`` 1
    this is the union of all polygons less their holes, with 2 what two valid ones share. Polygons are lists of closed rings, shell first.
    """
    segments = Segments(xy, starts, sizes)
    if not len(segments.a):
        return {}, set()
    sign = turns(segments, len(starts)) * np.where(hole, -1, 1)
    a, b, owner, source, unsettled = _noded(segments.a, segments.b, geom[segments.ring])
    points, u, v, owner, w = _edges(a, b, owner, sign[segments.ring][source])
    if not len(u):
        return {}, set(unsettled.tolist())
    left = _left(points, u, v, owner, w)
    inside, beside = left >= least, left - w >= least
    edge = inside != beside
    start, stop = np.where(inside, u, v)[edge], np.where(inside, v, u)[edge]
    owner, failed = owner[edge], set(unsettled.tolist())
    lost = np.isin(owner, unsettled)
    while True:
        failed |= set(owner[lost].tolist())
        use = ~np.isin(owner, list(failed))
        start, stop, owner = start[use], stop[use], owner[use]
        if not len(start):
            return {}, failed
        label, place, lost = _chained(points, start, stop)
        if not lost.any():
            break
    order = np.lexsort((place, label))
    names, begins = np.unique(label[order], return_index=True)
    ends = np.append(begins[1:], len(order))
    vertex = start[order]
    twice = np.unique(np.column_stack([label[order], vertex]), axis=0, return_counts=True)
    touching = set(twice[0][twice[1] > 1, 0].tolist())
    rings: dict[int, list[np.ndarray]] = {}
    for name, at, end in zip(names.tolist(), begins.tolist(), ends.tolist()):
        loops = _split(vertex[at:end].tolist()) if name in touching else [vertex[at:end]]
        for loop in loops:
            ring = points[np.append(loop, loop[0])]
            rings.setdefault(int(owner[name]), []).append(ring)
    out = {}
    for g, own in rings.items():
        signs = [topo.ring_area(r) for r in own]
        out[g] = [[r] for r in own] if min(signs) > 0 else topo.nest_rings([r for r, s in zip(own, signs) if s])
    return out, failed

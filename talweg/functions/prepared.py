"""A polygon prepared for many tests: its edges in bands by y, so that a point or segment meets only the edges at its height."""

from __future__ import annotations

import numpy as np

from talweg.functions import topology as topo
from talweg.functions.shapes import ROLE_SHELL, Shapes, read_tree

#: Edges in a band on the average, most bands, pairs tested together.
BAND_EDGES, MOST_BANDS, BLOCK = 4, 65_536, 1_000_000


def rings_of(tree) -> list[np.ndarray]:
    kind, _, payload = tree
    if kind == 3:
        return [r[:, :2] for r in payload if len(r)]
    return [r for part in payload for r in rings_of(part)] if kind > 3 else []


class Prepared:
    """A valid polygon or multipolygon."""

    def __init__(self, wkb: bytes):
        rings = rings_of(read_tree(wkb)[0])
        self.first = np.array([r[0] for r in rings])
        self.a, self.b = np.concatenate([r[:-1] for r in rings]), np.concatenate([r[1:] for r in rings])
        low, high = np.minimum(self.a[:, 1], self.b[:, 1]), np.maximum(self.a[:, 1], self.b[:, 1])
        self.low, self.high = float(low.min()), float(high.max())
        self.count = int(np.clip(len(self.a) // BAND_EDGES, 1, MOST_BANDS))
        self.height = (self.high - self.low) / self.count or 1.0
        first, last = self.band(low), self.band(high)
        edge = np.repeat(np.arange(len(low)), last - first + 1)
        band = np.repeat(first, last - first + 1) + np.arange(len(edge)) - np.repeat(np.cumsum(last - first + 1) - (last - first + 1), last - first + 1)
        order = np.argsort(band, kind="stable")
        self.edges = edge[order]
        self.starts = np.searchsorted(band[order], np.arange(self.count + 1))

    def band(self, y: np.ndarray) -> np.ndarray:
        return np.clip(((y - self.low) / self.height).astype(np.int64), 0, self.count - 1)

    def _pairs(self, band: np.ndarray):
        """(row, edge) for the edges in each row's band, in bounded blocks."""
        size = self.starts[band + 1] - self.starts[band]
        before = np.concatenate([[0], np.cumsum(size)])
        at = 0
        while at < len(band):
            end = max(at + 1, int(np.searchsorted(before, before[at] + BLOCK, "right")) - 1)
            own = size[at:end]
            row = np.repeat(np.arange(at, end), own)
            place = np.arange(own.sum()) - np.repeat(before[at:end] - before[at], own)
            yield row, self.edges[self.starts[band[row]] + place]
            at = end

    def locate(self, points: np.ndarray) -> np.ndarray:
        """+1 inside, 0 on the outline, -1 outside."""
        place = np.full(len(points), -1)
        rows = np.flatnonzero((points[:, 1] >= self.low) & (points[:, 1] <= self.high))
        crossed, edge_hit = np.zeros(len(rows), np.int64), np.zeros(len(rows), bool)
        for row, edge in self._pairs(self.band(points[rows, 1])):
            p, a, b = points[rows[row]], self.a[edge], self.b[edge]
            turn = topo._orient(a, b, p)
            edge_hit[row[(turn == 0) & topo._on_box(a, b, p)]] = True
            up = (a[:, 1] <= p[:, 1]) & (b[:, 1] > p[:, 1]) & (turn > 0)
            down = (b[:, 1] <= p[:, 1]) & (a[:, 1] > p[:, 1]) & (turn < 0)
            crossed += np.bincount(row[up | down], minlength=len(rows))
        place[rows] = np.where(edge_hit, 0, np.where(crossed % 2 == 1, 1, -1))
        return place

    def touched(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Which segments share a point with the outline."""
        hit = np.zeros(len(p), bool)
        low, high = np.minimum(p[:, 1], q[:, 1]), np.maximum(p[:, 1], q[:, 1])
        rows = np.flatnonzero((high >= self.low) & (low <= self.high))
        first, last = self.band(low[rows]), self.band(high[rows])
        size = last - first + 1
        row = np.repeat(rows, size)
        band = np.repeat(first, size) + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        for at, edge in self._pairs(band):
            i = row[at]
            near = (np.maximum(p[i, 0], q[i, 0]) >= np.minimum(self.a[edge, 0], self.b[edge, 0])) & (
                np.minimum(p[i, 0], q[i, 0]) <= np.maximum(self.a[edge, 0], self.b[edge, 0])
            )
            i, edge = i[near], edge[near]
            hit[i[topo.segments_meet(p[i], q[i], self.a[edge], self.b[edge])]] = True
        return hit

    def meets(self, s: Shapes) -> np.ndarray:
        """Which geometries of a batch share a point with the polygon."""
        out = np.zeros(len(s), bool)
        if not len(s.ring_geom):
            return out
        out[s.ring_geom[self.locate(s.xy[s.ring_start[:-1]]) >= 0]] = True
        ring = np.repeat(np.arange(len(s.ring_geom)), s.ring_size)
        start = np.flatnonzero(ring[:-1] == ring[1:])
        start = start[~out[s.ring_geom[ring[start]]]]
        out[s.ring_geom[ring[start[self.touched(s.xy[start], s.xy[start + 1])]]]] = True
        # What is left may still hold a ring of the polygon wholly inside an area.
        start = start[(s.ring_role[ring[start]] >= ROLE_SHELL) & ~out[s.ring_geom[ring[start]]]]
        geom, a, b = s.ring_geom[ring[start]], s.xy[start], s.xy[start + 1]
        for p in self.first if len(start) else ():
            crossing = (a[:, 1] <= p[1]) != (b[:, 1] <= p[1])
            turn = topo._orient(a[crossing], b[crossing], p[None])
            right = (turn > 0) == (b[crossing, 1] > a[crossing, 1])
            out[np.bincount(geom[crossing][right], minlength=len(s)) % 2 == 1] = True
        return out

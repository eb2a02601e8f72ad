"""Sweeps over all segments or boxes of a whole batch: which of them meet, and which rings lie in which."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from talweg.functions import topology as topo

#: Pairs looked at together.
BLOCK = 2_000_000


def overlapping(boxes: np.ndarray, group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of boxes of one group that overlap, each pair once, in bounded blocks.

    Boxes are sorted by group and left side together. The partners of a box are a range of that order, found for all boxes by one binary search.
    """
    n = len(boxes)
    if n < 2:
        return
    order = np.lexsort((boxes[:, 0], group))
    b, g = boxes[order], group[order].astype(np.int64)
    lefts = np.unique(b[:, 0])
    width = len(lefts) + 1
    upto = np.searchsorted(g * width + np.searchsorted(lefts, b[:, 0]), g * width + np.searchsorted(lefts, b[:, 2], "right") - 1, "right")
    count = np.maximum(upto - np.arange(n) - 1, 0)
    before = np.concatenate([[0], np.cumsum(count)])
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(before, before[at] + BLOCK, "right")) - 1)
        own = count[at:end]
        if own.any():
            i = np.repeat(np.arange(at, end), own)
            j = i + 1 + np.arange(len(i)) - np.repeat(before[at:end] - before[at], own)
            hit = (b[j, 1] <= b[i, 3]) & (b[j, 3] >= b[i, 1])
            if hit.any():
                yield order[i[hit]], order[j[hit]]
        at = end


def segment_boxes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.concatenate([np.minimum(a, b), np.maximum(a, b)], axis=1)


class Segments:
    """Segments of closed rings without repeated points: ends, ring, and the next segment of the ring."""

    def __init__(self, xy: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        vertex = np.repeat(starts, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        ring = np.repeat(np.arange(len(starts)), sizes)
        v = xy[vertex]
        inner = np.flatnonzero((ring[:-1] == ring[1:]) & (v[:-1] != v[1:]).any(axis=1)) if len(v) else np.empty(0, np.int64)
        # The end of a segment is the next point that differs, so runs of equal points are one.
        self.a, self.b, self.ring = v[inner], v[inner + 1], ring[inner]
        self.size = np.bincount(self.ring, minlength=len(starts))
        first = np.cumsum(self.size) - self.size
        self.place = np.arange(len(inner)) - first[self.ring]
        last = self.place == self.size[self.ring] - 1
        self.next = np.where(last, first[self.ring], np.arange(len(inner)) + 1)

    def spikes(self) -> np.ndarray:
        """Segments after which the ring turns back on itself."""
        after = self.b[self.next]
        flat = topo._orient(self.a, self.b, after) == 0
        return flat & (((self.b - self.a) * (after - self.b)).sum(axis=1) < 0)

    def contacts(self, group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(i, j, crossing): pairs of one group that share a point and aren't neighbours in a ring."""
        for i, j in overlapping(segment_boxes(self.a, self.b), group):
            apart = (self.next[i] != j) & (self.next[j] != i)
            i, j = i[apart], j[apart]
            meet = topo.segments_meet(self.a[i], self.b[i], self.a[j], self.b[j])
            i, j = i[meet], j[meet]
            if len(i):
                yield i, j, topo.segments_cross(self.a[i], self.b[i], self.a[j], self.b[j])


def ring_boxes(segments: Segments, rings: int) -> np.ndarray:
    box = np.full((rings, 4), np.nan)
    used = np.flatnonzero(segments.size)
    if len(used):
        first = (np.cumsum(segments.size) - segments.size)[used]
        box[used, :2] = np.minimum.reduceat(segments.a, first)
        box[used, 2:] = np.maximum.reduceat(segments.a, first)
    return box


def holders(segments: Segments, geom: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(inner, outer) rings of one geometry where the first point of the inner one lies inside the outer one.

    For rings without contact this tells that all of the inner ring does.
    """
    boxes = ring_boxes(segments, len(geom))
    first = np.cumsum(segments.size) - segments.size
    inner_all, outer_all = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i, j in overlapping(boxes, geom):
        inner, outer = np.concatenate([i, j]), np.concatenate([j, i])
        nested = (boxes[inner, :2] >= boxes[outer, :2]).all(axis=1) & (boxes[inner, 2:] <= boxes[outer, 2:]).all(axis=1)
        inner, outer = inner[nested], outer[nested]
        before = np.concatenate([[0], np.cumsum(segments.size[outer])])
        at = 0
        while at < len(inner):  # edges of some outer rings together
            end = max(at + 1, int(np.searchsorted(before, before[at] + BLOCK, "right")) - 1)
            sizes = segments.size[outer[at:end]]
            pair = np.repeat(np.arange(end - at), sizes)
            edge = np.repeat(first[outer[at:end]], sizes) + np.arange(sizes.sum()) - np.repeat(before[at:end] - before[at], sizes)
            p, a, b = segments.a[first[inner[at:end]]][pair], segments.a[edge], segments.b[edge]
            turn = topo._orient(a, b, p)
            up = (a[:, 1] <= p[:, 1]) & (b[:, 1] > p[:, 1]) & (turn > 0)
            down = (b[:, 1] <= p[:, 1]) & (a[:, 1] > p[:, 1]) & (turn < 0)
            odd = np.bincount(pair, up | down, end - at).astype(np.int64) % 2 == 1
            inner_all.append(inner[at:end][odd])
            outer_all.append(outer[at:end][odd])
            at = end
    return np.concatenate(inner_all), np.concatenate(outer_all)


def misplaced(segments: Segments, geom: np.ndarray, poly: np.ndarray, hole: np.ndarray) -> np.ndarray:
    """Rings that lie where they may not, if no rings touch: holes outside their shell or inside each other, shells inside another polygon."""
    inner, outer = holders(segments, geom)
    own = poly[inner] == poly[outer]
    n = len(geom)
    in_shell = np.bincount(inner[own & hole[inner] & ~hole[outer]], minlength=n)
    in_hole = np.bincount(inner[own & hole[inner] & hole[outer]], minlength=n)
    # A shell may lie inside another polygon's shell only inside one of its holes.
    depth = np.bincount(inner[~own & ~hole[inner]], np.where(hole[outer], -1, 1)[~own & ~hole[inner]], n)
    return np.where(hole, (in_shell != 1) | (in_hole > 0), depth != 0)

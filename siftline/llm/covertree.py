"""A cover tree over norm-augmented vectors, for exact searches by inner product within windows of scores.

A vector x gets one more component, sqrt(M**2 - |x|**2), M the largest length: all then lie on a
sphere, and the inner product with a query (whose added component is 0) is |q| M times the cosine of
the angle between them. A node has a centre, one of its points, and covers them all within a radius
that halves at least from level to level; the centres of its children are farther apart than the
children's level allows them to cover, and the node's own centre is the first of them. What is stored
is the true covering radius, as an angle. By the triangle inequality of the sphere all products below
a node lie between |q| M cos(angle + radius) and |q| M cos(angle - radius).
"""

from __future__ import annotations

import numpy as np

LEAF = 16
SLACK = 1e-6  # far above the rounding of any length or angle here
BATCH = 64
EXACT = float(1 << 53)
LEAST, MOST = -(2**63), 2**63 - 1


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, held within 64 bits."""
    if not len(x) or not len(q):
        return np.zeros(len(x), np.int64)
    if float(np.abs(q.astype(np.float64)).max()) * float(np.abs(x.astype(np.float64)).max()) * len(q) < EXACT:
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    return np.array([max(min(int(s), MOST), LEAST) for s in x.astype(object) @ q.astype(object)], np.int64)


class Best:
    """The best ``k`` rows of each window [low, high] of scores; ties go to the smaller id."""

    def __init__(self, lows: list[int], highs: list[int], k: int):
        self.lows, self.highs, self._k = np.array(lows, np.int64), np.array(highs, np.int64), k
        self.found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in lows]
        self.least = self.lows.copy()  # what a score must reach to count

    def wants(self, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Whether scores between these bounds can still change a window."""
        return ((most[:, None] >= self.least) & (least[:, None] <= self.highs)).any(1)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for w, (low, high) in enumerate(zip(self.least.tolist(), self.highs.tolist(), strict=True)):
            at = np.flatnonzero((scores >= low) & (scores <= high))
            if not len(at):
                continue
            s, i = np.concatenate((self.found[w][0], scores[at])), np.concatenate((self.found[w][1], ids[at]))
            order = np.lexsort((i, -s))[: self._k]  # the least 64-bit score has no negative, and sorts last either way
            self.found[w] = s, i = s[order], i[order]
            if len(s) == self._k:
                self.least[w] = max(low, int(s[-1]))


class CoverTree:
    """Points in the order of the tree; a node is a range of them."""

    PARTS = ("centre", "start", "stop", "first", "last", "radius")

    def __init__(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, parts: dict[str, np.ndarray]):
        self.x, self.ids, self.labels = x, ids, labels
        self.centre, self.start, self.stop, self.first, self.last, self.radius = (parts[p] for p in self.PARTS)
        wide = x.astype(np.float64)
        self.length = float(np.sqrt(np.square(wide).sum(1).max(initial=0.0))) * (1 + SLACK)
        biggest = float(np.abs(wide).max(initial=0.0))
        self._wide, self._biggest = wide, biggest
        self.kinds = np.unique(labels)
        self.compared = 0  # points whose product was taken

    @classmethod
    def built(cls, x: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> CoverTree:
        n = len(x)
        wide = x.astype(np.float64)
        squares = np.square(wide).sum(1)
        length = max(float(squares.max(initial=0.0)), 1.0)
        added = np.sqrt(np.maximum(length - squares, 0.0))
        apart = 2 * (1 - (wide @ wide.T + np.outer(added, added)) / length)  # squared distances on the unit sphere
        np.maximum(apart, 0.0, out=apart)
        order = np.arange(n)
        nodes = [(0, 0, n)]  # centre, as first numbered; its range in order
        first, last, radius = [0], [0], [0.0]
        at = 0
        while at < len(nodes):
            centre, a, b = nodes[at]
            members = order[a:b]
            nearest = apart[members, centre]
            widest = float(nearest.max(initial=0.0))
            chord = np.sqrt(widest + SLACK * SLACK)
            radius[at] = float(2 * np.arcsin(min(1.0, chord / 2))) + SLACK
            first[at] = last[at] = len(nodes)
            if b - a > LEAF and widest > SLACK * SLACK:
                centres, owner = [centre], np.zeros(b - a, np.int64)
                while True:
                    far = int(np.argmax(nearest))
                    if nearest[far] <= widest / 4:  # half the radius, squared
                        break
                    centres.append(int(members[far]))
                    new = apart[members, centres[-1]]
                    closer = new < nearest
                    owner[closer] = len(centres) - 1
                    np.minimum(nearest, new, out=nearest)
                by_owner = np.argsort(owner, kind="stable")
                order[a:b] = members[by_owner]
                ends = a + np.cumsum(np.bincount(owner, minlength=len(centres)))
                for c, begin, end in zip(centres, [a, *ends[:-1].tolist()], ends.tolist(), strict=True):
                    nodes.append((c, begin, end))
                    first.append(0)
                    last.append(0)
                    radius.append(0.0)
                last[at] = len(nodes)
            at += 1
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        centre, start, stop = (np.array(c, np.int64) for c in zip(*nodes, strict=True))
        parts = (place[centre] if n else centre, start, stop, np.array(first), np.array(last), np.array(radius))
        return cls(x[order], ids[order], labels[order], dict(zip(cls.PARTS, parts, strict=True)))

    def _products(self, at: np.ndarray, q: np.ndarray, exact: bool) -> np.ndarray:
        self.compared += len(at)
        return (self._wide[at] @ q).astype(np.int64) if exact else products(self.x[at], q)

    def search(self, q: np.ndarray, best: Best, fits) -> None:
        """Descend best first, a batch of nodes at a time; ``fits(ids, labels)`` says which points may be offered."""
        if not len(self.ids):
            return
        width = min(len(q), self.x.shape[1])
        q, whole = q[:width], self.x.shape[1] == width
        exact = whole and float(np.abs(q.astype(np.float64)).max(initial=0.0)) * self._biggest * max(width, 1) < EXACT
        if not whole:  # the query is shorter: what it lacks adds nothing
            q = np.concatenate((q, np.zeros(self.x.shape[1] - width, np.int64)))
        asked = q.astype(np.float64)
        size = float(np.sqrt(np.square(asked).sum())) * self.length
        q = asked if exact else q
        margin = 1 + size * 1e-9
        nodes, least, most = np.zeros(1, np.int64), np.array([-size - margin]), np.array([size + margin])
        while True:
            alive = best.wants(least, most)
            nodes, least, most = nodes[alive], least[alive], most[alive]
            if not len(nodes):
                return
            if len(nodes) > BATCH:
                by = np.argpartition(-most, BATCH)
                now, later = nodes[by[:BATCH]], by[BATCH:]
            else:
                now, later = nodes, np.zeros(0, np.int64)
            leaves = self.first[now] == self.last[now]
            inner = ranges(self.first[now[~leaves]], self.last[now[~leaves]])
            single = self.stop[inner] - self.start[inner] == 1
            points = np.concatenate((ranges(self.start[now[leaves]], self.stop[now[leaves]]), self.centre[inner[single]]))
            scores = self._products(points, q, exact)
            fine = fits(self.ids[points], self.labels[points])
            best.offer(scores[fine], self.ids[points][fine])
            inner = inner[~single]
            centres = self._products(self.centre[inner], q, exact).astype(np.float64)
            angle = np.arccos(np.clip(centres / max(size, 1e-300), -1.0, 1.0))
            high = size * np.cos(np.maximum(angle - self.radius[inner], 0.0)) + margin
            low = size * np.cos(np.minimum(angle + self.radius[inner], np.pi)) - margin
            nodes = np.concatenate((nodes[later], inner))
            least, most = np.concatenate((least[later], low)), np.concatenate((most[later], high))


def ranges(starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after another."""
    lengths = stops - starts
    if not lengths.sum():
        return np.zeros(0, np.int64)
    offsets = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return np.arange(lengths.sum()) + offsets

"""Which sites can be nearest anywhere in a box: a packed tree over site locations, searched for many boxes at once.

Works in any number of dimensions (2 for the plane, 3 for unit vectors on the sphere).  A site ``q`` is ruled out for a
box when ``k`` sites are strictly closer at every place of it.  ``|x - q|^2 - |x - p|^2`` is linear in ``x`` and splits by
dimension, so its least value over a box of places and a box of sites is exact and cheap; whole branches of the tree go
by the same test.  The sites that rule others out are those nearest to the box's middle.
"""

from __future__ import annotations

import numpy as np

LEAF, BRANCH = 8, 4
#: Squared distances that differ by less than this share may tie once they are rounded.
MARGIN = 1e-12
#: (box, branch) pairs looked at together.
PAIRS = 1 << 18


def _z_order(at: np.ndarray) -> np.ndarray:
    """The order of the places along a space-filling curve."""
    span = at.max(axis=0) - at.min(axis=0)
    bits = 48 // at.shape[1]
    grid = ((at - at.min(axis=0)) / np.where(span > 0, span, 1.0) * ((1 << bits) - 1)).astype(np.uint64)
    code = np.zeros(len(at), np.uint64)
    for b in range(bits):
        for d in range(at.shape[1]):
            code |= ((grid[:, d] >> np.uint64(b)) & np.uint64(1)) << np.uint64(b * at.shape[1] + d)
    return np.argsort(code, kind="stable")


class SiteIndex:
    """Distinct site locations ``at`` (rows) with the number of sites at each (``weight``)."""

    def __init__(self, at: np.ndarray, weight: np.ndarray):
        self.order = _z_order(at)
        self.at, self.weight = at[self.order], weight[self.order].astype(np.int64)
        low, high, count = self.at, self.at, self.weight
        self.levels = [(low, high, count)]
        step = LEAF
        while len(low) > 1:
            starts = np.arange(0, len(low), step)
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            count = np.add.reduceat(count, starts)
            self.levels.append((low, high, count))
            step = BRANCH

    def _walk(self, boxes: int, keep) -> tuple[np.ndarray, np.ndarray]:
        """(box, site) pairs that ``keep(box, low, high, count)`` leaves at every level, from the root down."""
        top = len(self.levels) - 1
        box = np.repeat(np.arange(boxes), len(self.levels[top][0]))
        node = np.tile(np.arange(len(self.levels[top][0])), boxes)
        for level in range(top, -1, -1):
            low, high, count = self.levels[level]
            good = keep(box, low[node], high[node], count[node])
            box, node = box[good], node[good]
            if level:
                step = LEAF if level == 1 else BRANCH
                box = np.repeat(box, step)
                node = (node[:, None] * step + np.arange(step)).ravel()
                inside = node < len(self.levels[level - 1][0])
                box, node = box[inside], node[inside]
        return box, node

    def nearest(self, middle: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(sites, weights), each place x k: the locations nearest to each place, -1 and 0 where there are fewer."""
        def keep(box, low, high, count):
            m = middle[box]
            near = np.maximum(np.maximum(low - m, m - high), 0.0)
            far = np.maximum(np.abs(low - m), np.abs(high - m))
            near, far = (near * near).sum(axis=1), (far * far).sum(axis=1)
            order = np.lexsort((far, box))
            place = np.arange(len(order)) - np.searchsorted(box[order], box[order])
            at_k = order[place == k - 1]  # branches hold a location at least
            limit = np.full(len(middle), np.inf)
            limit[box[at_k]] = far[at_k]
            return near <= limit[box] * (1 + MARGIN)

        box, site = self._walk(len(middle), keep)
        gap = self.at[site] - middle[box]
        order = np.lexsort((site, (gap * gap).sum(axis=1), box))
        box, site = box[order], site[order]
        place = np.arange(len(order)) - np.searchsorted(box, box)
        first = place < k
        sites, weights = np.full((len(middle), k), -1), np.zeros((len(middle), k), np.int64)
        sites[box[first], place[first]] = site[first]
        weights[box[first], place[first]] = self.weight[site[first]]
        return sites, weights

    def candidates(self, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(box, site) pairs: every site that may be one of the ``k`` nearest somewhere in the box ``low`` .. ``high``."""
        boxes, sites = [], []
        for s in range(0, len(low), 512):
            box, site = self._candidates(low[s:s + 512], high[s:s + 512], k)
            boxes.append(box + s)
            sites.append(site)
        return np.concatenate(boxes), np.concatenate(sites)

    def _candidates(self, low: np.ndarray, high: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        middle = (low + high) / 2
        half = high - middle
        rivals, weights = self.nearest(middle, min(k + 3, len(self.at)))
        rival_at = self.at[rivals] - middle[:, None, :]  # relative to the middle, where the numbers are small

        def keep(box, site_low, site_high, count):
            out = np.empty(len(box), bool)
            for t in range(0, len(box), PAIRS):
                b = box[t:t + PAIRS]
                a, z = site_low[t:t + PAIRS] - middle[b], site_high[t:t + PAIRS] - middle[b]
                closer = np.zeros(len(b), np.int64)
                reach = np.maximum(np.abs(a), np.abs(z))
                scale = (reach * reach).sum(axis=1) + (half[b] * half[b]).sum(axis=1)
                for r in range(rivals.shape[1]):
                    p = rival_at[b, r]
                    least = np.full(a.shape, np.inf)
                    for x in (-half[b], half[b]):  # linear in the place: an end of the box
                        q = np.clip(x, a, z)  # convex in the site
                        least = np.minimum(least, q * q - p * p - 2 * x * (q - p))
                    closer += np.where((least.sum(axis=1) > MARGIN * scale) & (rivals[b, r] >= 0), weights[b, r], 0)
                out[t:t + PAIRS] = closer < k
            return out

        return self._walk(len(low), keep)


def leaf_cells(index: SiteIndex, cells: np.ndarray, sides: np.ndarray, k: int, most: int, fan: int, deepest: int, on_sphere: bool = False):
    """Yield (root, depth, cells, starts, sites): the parts of ``cells`` that have at most ``most`` candidates each.

    ``cells`` are integer cell coordinates, row by row, of side ``sides``; a cell with more candidates is cut
    into ``fan`` parts a dimension, up to ``deepest`` times.  ``root`` is the row it comes from; a part's candidates are
    ``sites[starts[i]:starts[i + 1]]`` (places in ``index.order``).
    """
    roots = np.arange(len(cells))
    offsets = np.stack(np.meshgrid(*[np.arange(fan)] * cells.shape[1], indexing="ij"), axis=-1).reshape(-1, cells.shape[1])
    todo = [(roots[s:s + 2048], cells[s:s + 2048], 0) for s in range(0, len(cells), 2048)]
    while todo:
        root, cell, depth = todo.pop()
        side = sides[root][:, None] / float(fan) ** depth
        low, high = cell * side, (cell + 1) * side
        if on_sphere:  # only cells that the unit sphere passes through
            near = np.maximum(np.maximum(low, -high), 0.0)
            far = np.maximum(np.abs(low), np.abs(high))
            cut = ((near * near).sum(axis=1) <= 1 + 1e-9) & ((far * far).sum(axis=1) >= 1 - 1e-9)
            root, cell, low, high = root[cut], cell[cut], low[cut], high[cut]
        if not len(cell):
            continue
        box, site = index.candidates(low, high, k)
        count = np.bincount(box, minlength=len(cell))
        order = np.argsort(box, kind="stable")
        site = site[order]
        done = (count <= most) | (depth == deepest)
        starts = np.concatenate([[0], np.cumsum(count[done])])
        yield root[done], depth, cell[done], starts, site[done[box[order]]]
        rest, parents = cell[~done], root[~done]
        if len(rest):
            parts = (rest[:, None, :] * fan + offsets).reshape(-1, cells.shape[1])
            owner = np.repeat(parents, len(offsets))
            todo += [(owner[s:s + 2048], parts[s:s + 2048], depth + 1) for s in range(0, len(parts), 2048)]

"""Cover trees over integer vectors and the dual-tree search for the largest inner products."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

LEAF = 48     # points below which a node is not divided
SPARSE = 4    # a net with more than one in so many points as centres does not divide a node


@dataclass
class Node:
    """Points ``rows`` within ``radius`` of the point ``centre``; children cover the rows."""
    centre: int
    radius: float
    rows: np.ndarray
    children: list["Node"] = field(default_factory=list)


def _distances(x: np.ndarray, rows: np.ndarray, p: int) -> np.ndarray:
    d = x[rows] - x[p]
    return np.sqrt(np.einsum("ij,ij->i", d, d))


def build(x: np.ndarray) -> Node | None:
    """Tree over the rows of ``x`` (floats).

    A node's children are centred on a net of half its radius: every point
    is within that distance of its child's centre (covering), centres are
    further apart than that (separation), and the node's own centre is one
    of them (nesting).  A node that has few points, no extent or a net of
    too many centres stays a leaf.
    """
    if not len(x):
        return None
    rows = np.arange(len(x))
    far = _distances(x, rows, 0)
    root = Node(0, float(far.max()), rows)
    todo = [(root, far)]
    while todo:
        node, far = todo.pop()
        if len(node.rows) <= LEAF or node.radius == 0:
            continue
        half, most = node.radius / 2, len(node.rows) // SPARSE
        centres, nearest, to = [node.centre], far.copy(), np.zeros(len(node.rows), np.int64)
        reach = [far]
        while len(centres) <= most and nearest.max() > half:
            p = int(node.rows[nearest.argmax()])
            d = _distances(x, node.rows, p)
            closer = d < nearest
            nearest[closer], to[closer] = d[closer], len(centres)
            centres.append(p)
            reach.append(d)
        if nearest.max() > half:
            continue
        for k, c in enumerate(centres):
            mine = to == k
            d = reach[k][mine]
            child = Node(c, float(d.max()), node.rows[mine])
            node.children.append(child)
            todo.append((child, d))
    return root


class TopK:
    """The best k (score, id, row) of each query; ties go to the smaller id, then row."""

    def __init__(self, floors: np.ndarray, k: int) -> None:
        self.k, self.worst = k, floors.astype(float)  # only scores of at least the floor can be among the best
        self.best: list[list[tuple]] = [[] for _ in floors]

    def offer(self, q: int, found: list[tuple]) -> None:
        best = sorted(self.best[q] + found)[:self.k]
        self.best[q] = best
        if len(best) == self.k:
            self.worst[q] = max(self.worst[q], -best[-1][0])


def search(queries: np.ndarray, own: np.ndarray, points: np.ndarray, ids: np.ndarray, rows: np.ndarray,
           floors: np.ndarray, k: int) -> list[list[tuple]]:
    """For each query the best k points by inner product, as sorted (-score, id, row).

    ``own`` is each query's own row, which is no candidate; ``floors`` a
    score that its k-th best is known to reach.  Query and point trees are
    walked together; a pair of nodes is dropped when the largest inner
    product their covering radii allow is below the worst k-th score among
    the node's queries.
    """
    top = TopK(floors, k)
    qf, pf = queries.astype(float), points.astype(float)
    most = _largest(queries, points)
    # doubles hold the scores exactly, else 64-bit integers, else integers of any size
    exact = (qf, pf) if most < 2 ** 52 else (queries, points) if most < 2 ** 62 else (queries.astype(object), points.astype(object))
    qn, pn = np.sqrt((qf * qf).sum(axis=1)), np.sqrt((pf * pf).sum(axis=1))
    qt, pt = build(qf), build(pf)
    if qt is None or pt is None:
        return top.best

    def bound(a: Node, b: Node) -> float:
        x = float(qf[a.centre] @ pf[b.centre]) + a.radius * pn[b.centre] + b.radius * qn[a.centre] + a.radius * b.radius
        return x + 1e-9 * (abs(x) + qn[a.centre] * pn[b.centre]) + 1e-6

    todo = [(bound(qt, pt), qt, pt)]
    while todo:
        limit, a, b = todo.pop()
        if limit < top.worst[a.rows].min():
            continue
        if not a.children and not b.children:
            scores = exact[0][a.rows] @ exact[1][b.rows].T
            hit = (scores >= top.worst[a.rows][:, None]).astype(bool)
            for i in np.flatnonzero(hit.any(axis=1)).tolist():
                q = int(a.rows[i])
                at = np.flatnonzero(hit[i])
                if len(at) > 4 * k + 1 and most < 2 ** 62:  # the best of them by score keep every tie at the edge
                    edge = np.partition(scores[i, at], -(k + 1))[-(k + 1)]
                    at = at[scores[i, at] >= edge]
                if len(at) > 4 * k + 1 and most < 2 ** 62:  # many ties: the smallest ids
                    r = b.rows[at]
                    at = at[np.lexsort((rows[r], ids[r], -scores[i, at]))[:k + 1]]
                r = b.rows[at]
                top.offer(q, [(-int(s), int(x), int(y)) for s, x, y in zip(scores[i, at], ids[r], rows[r])
                              if y != own[q]])
            continue
        if a.children and (not b.children or a.radius >= b.radius):
            pairs = [(bound(c, b), c, b) for c in a.children]
        else:
            pairs = [(bound(a, c), a, c) for c in b.children]
        todo += sorted(pairs, key=lambda x: x[0])  # the most promising pair is taken first
    return top.best


def _largest(q: np.ndarray, p: np.ndarray) -> float:
    """What no inner product of the two sides exceeds."""
    biggest = lambda v: float(np.abs(v.astype(float)).max(initial=0))
    return biggest(q) * biggest(p) * max(1, q.shape[1])

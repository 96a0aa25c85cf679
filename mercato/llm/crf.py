"""Binary linear-chain conditional random field in numpy.

Many sequences are laid end to end with a start flag at the first element
of each.  A step of the forward (or backward) recursion is a 2 x 2 matrix;
at a start the matrix forgets the past.  The whole chain is cut into rows
whose prefix products are formed together, then carried from row to row,
so a batch of a million elements takes milliseconds, whatever the lengths
of its sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

CLIP = 30.0  # emission log-odds beyond this are certain


def _scan(m00: np.ndarray, m01: np.ndarray, m10: np.ndarray, m11: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """v_t = M_t v_(t-1), normalised, from v = (1/2, 1/2)."""
    n = len(m00)
    width = max(1, int((n / 16) ** 0.5))
    rows = -(-n // width)
    pad = rows * width - n

    def grid(m: np.ndarray, fill: float) -> np.ndarray:
        return np.ascontiguousarray(np.concatenate([m, np.full(pad, fill)]).reshape(rows, width).T)

    a, b, c, d = grid(m00, 1.0), grid(m01, 0.0), grid(m10, 0.0), grid(m11, 1.0)
    for j in range(width):  # prefix products of every row at once; column j becomes M_j ... M_0
        if j:
            a[j], b[j], c[j], d[j] = (a[j] * a[j - 1] + b[j] * c[j - 1], a[j] * b[j - 1] + b[j] * d[j - 1],
                                      c[j] * a[j - 1] + d[j] * c[j - 1], c[j] * b[j - 1] + d[j] * d[j - 1])
        s = 1.0 / (a[j] + b[j] + c[j] + d[j])
        a[j] *= s
        b[j] *= s
        c[j] *= s
        d[j] *= s
    first = np.empty(rows)
    x, last = 0.5, list(zip(a[-1].tolist(), b[-1].tolist(), c[-1].tolist(), d[-1].tolist()))
    for r in range(rows):
        first[r] = x
        p, q, u, v = last[r]
        y0, y1 = p * x + q * (1 - x), u * x + v * (1 - x)
        x = y0 / (y0 + y1)
    v0, v1 = a * first + b * (1 - first), c * first + d * (1 - first)
    s = 1.0 / (v0 + v1)
    return (v0 * s).T.reshape(-1)[:n], (v1 * s).T.reshape(-1)[:n]


def marginals(e: np.ndarray, starts: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(label 1) of each element, and expected counts of the four transitions.

    ``e``: log-odds of label 1 by emission; ``starts``: first elements;
    ``trans``: 2 x 2 log-potentials from the previous label to the next.
    """
    n = len(e)
    if not n:
        return np.empty(0), np.zeros((2, 2))
    eps, t = np.exp(np.clip(e, -CLIP, CLIP)), np.exp(trans)
    one = np.ones(n)
    f0, f1 = _scan(np.where(starts, one, t[0, 0]), np.where(starts, one, t[1, 0]),
                   eps * np.where(starts, one, t[0, 1]), eps * np.where(starts, one, t[1, 1]))
    # backward: element t sees the emission of t + 1, unless t ends its sequence
    nxt, ends = np.append(eps[1:], 1.0)[::-1], np.append(starts[1:], True)[::-1]
    b0, b1 = _scan(np.where(ends, one, t[0, 0]), np.where(ends, one, t[0, 1] * nxt),
                   np.where(ends, one, t[1, 0]), np.where(ends, one, t[1, 1] * nxt))
    b0, b1 = b0[::-1], b1[::-1]
    p = f1 * b1 / (f0 * b0 + f1 * b1)
    inner = np.flatnonzero(~starts)
    joint = np.empty((2, 2, len(inner)))
    for i, f in enumerate((f0, f1)):
        for j, (b, x) in enumerate(((b0, one), (b1, eps))):
            joint[i, j] = f[inner - 1] * t[i, j] * x[inner] * b[inner]
    return p, (joint / joint.sum(axis=(0, 1))).sum(axis=2)


def fit(score: Callable[[np.ndarray], np.ndarray], back: Callable[[np.ndarray], np.ndarray], size: int,
        y: np.ndarray, starts: np.ndarray, steps: int = 120, rate: float = 0.15, l2: float = 1e-4
        ) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions of maximal conditional likelihood, by Adam on the exact gradient.

    ``score(w)`` gives emission log-odds; ``back(r)`` its transposed map.
    """
    w = np.zeros(size + 4)
    m, v = np.zeros_like(w), np.zeros_like(w)
    inner = np.flatnonzero(~starts)
    seen = np.bincount(2 * y[inner - 1] + y[inner], minlength=4)[:4].astype(float)
    for k in range(1, steps + 1):
        p, pairs = marginals(score(w[:-4]), starts, w[-4:].reshape(2, 2))
        g = np.concatenate([back(p - y), pairs.ravel() - seen]) / len(y) + l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.999 ** k)) + 1e-10)
    return w[:-4], w[-4:].reshape(2, 2)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Weights of a ridge logistic regression (last one the intercept), by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w, keep = np.zeros(x.shape[1]), np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -CLIP, CLIP)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + len(y) * 1e-6 * np.eye(len(w)) + keep,
                               x.T @ (y - p) - keep @ w)
        w = w + np.clip(step, -5, 5)
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -CLIP, CLIP)))

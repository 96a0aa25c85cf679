"""Banded alignment of token sequences: is the edit similarity at least a threshold?

Edit similarity is 1 - edits / length of the longer sequence.  Pairs are
first tested against two lower bounds of the number of edits (difference of
lengths, tokens not shared); the rest are aligned many at a time inside a
band that widens until it proves or excludes the allowed number of edits.
"""

from __future__ import annotations

import numpy as np

CELLS = 1 << 16  # band cells of a group of pairs aligned together
FAR = 1 << 29


def allowed_edits(n: int, m: int, threshold: float) -> int:
    return int((1 - threshold) * max(n, m) + 1e-9)


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the multiset intersection."""
    x = np.sort(np.concatenate([np.unique_counts(v).values for v in (a, b)]))
    if len(x) < 2 or not (x[1:] == x[:-1]).any():
        return 0
    va, vb = np.unique_counts(a), np.unique_counts(b)
    _, i, j = np.intersect1d(va.values, vb.values, assume_unique=True, return_indices=True)
    return int(np.minimum(va.counts[i], vb.counts[j]).sum())


def _trim(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the common beginning and end, which cost no edits."""
    k = min(len(a), len(b))
    if k and len(d := np.flatnonzero(a[:k] != b[:k])):
        a, b = a[d[0]:], b[d[0]:]
    else:
        a, b = a[k:], b[k:]
    k = min(len(a), len(b))
    if k:
        d = np.flatnonzero(a[::-1][:k] != b[::-1][:k])
        cut = d[0] if len(d) else k
        a, b = a[:len(a) - cut], b[:len(b) - cut]
    return a, b


def band_distances(pairs: list[tuple[np.ndarray, np.ndarray]], band: int) -> np.ndarray:
    """Edit distance of each pair where it is at most ``band``; anything above ``band`` otherwise."""
    p, width = len(pairs), 2 * band + 1
    n, m = np.array([len(a) for a, _ in pairs]), np.array([len(b) for _, b in pairs])
    rows = int(n.max(initial=0))
    left = np.full((p, max(1, rows)), -1, np.int64)
    # column c of a row i stands for position j = i + c - band of the other sequence
    right = np.full((p, rows + 2 * width + int(m.max(initial=0))), -2, np.int64)
    for k, (a, b) in enumerate(pairs):
        left[k, :len(a)] = a
        right[k, band:band + len(b)] = b
    c = np.arange(width)
    d = np.where((c >= band) & (c - band <= m[:, None]), c - band, FAR)
    out = np.full(p, FAR)
    at = m - n + band
    inside = (at >= 0) & (at < width)
    done = inside & (n == 0)
    out[done] = d[done, at[done]]
    for i in range(1, rows + 1):
        j = i + c - band
        same = left[:, i - 1, None] == right[:, i - 1:i - 1 + width]
        new = d + ~same
        new[:, :-1] = np.minimum(new[:, :-1], d[:, 1:] + 1)
        new[:, j < 0] = FAR
        if (k := np.flatnonzero(j == 0)).size:
            new[:, k[0]] = i
        new = np.minimum.accumulate(new - c, axis=1) + c
        new[:, j < 0] = FAR
        d = new
        done = inside & (n == i)
        if done.any():
            out[done] = d[done, at[done]]
    return out


def similar(pairs: list[tuple[np.ndarray, np.ndarray]], threshold: float) -> np.ndarray:
    """Whether each pair's edit similarity is at least ``threshold``; two empty sequences are similar."""
    out = np.zeros(len(pairs), bool)
    open_: list[tuple[int, np.ndarray, np.ndarray, int, int]] = []
    for k, (a, b) in enumerate(pairs):
        most = allowed_edits(len(a), len(b), threshold)
        if abs(len(a) - len(b)) > most or max(len(a), len(b)) - _shared(a, b) > most:
            continue
        a, b = _trim(a, b)
        if not len(a) or not len(b):
            out[k] = max(len(a), len(b)) <= most
            continue
        open_.append((k, a, b, most, min(most, max(4, most // 6, abs(len(a) - len(b))))))
    while open_:
        open_.sort(key=lambda x: (x[4], len(x[1])))
        group = []
        while open_ and (not group or (len(group) + 1) * (2 * open_[0][4] + 1) <= CELLS and open_[0][4] <= 2 * group[0][4]
                         and len(open_[0][1]) <= 2 * len(group[0][1]) + 16):
            group.append(open_.pop(0))
        band = group[-1][4]
        for (k, a, b, most, _), dist in zip(group, band_distances([(x[1], x[2]) for x in group], band).tolist()):
            if dist <= band or band >= most:
                out[k] = dist <= most
            else:
                open_.append((k, a, b, most, min(most, 3 * band)))
    return out

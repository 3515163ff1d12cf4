"""Bounded local top-k for per-partition scorers."""

from __future__ import annotations

import numpy as np


def bounded_topk(scores: np.ndarray, ids: np.ndarray, k: int, places: int) -> np.ndarray:
    """Places of the rows that may be among the ``k`` best by (score rounded to
    ``places`` decimals, descending; id, ascending), whichever way a score at
    the edge of two decimals is rounded.

    Rows clearly above the k-th score stay. Around it, rows fall into cells of a
    quarter of the last decimal; all rows of a cell round alike, so its ``k``
    smallest ids are enough. However many rows tie, the result is a small
    multiple of ``k``.
    """
    n = len(scores)
    if n <= k:
        return np.arange(n)
    unit = 10.0**-places
    kth = np.partition(scores, n - k)[n - k]
    keep = np.flatnonzero(scores >= kth - 2 * unit)
    band = keep[scores[keep] <= kth + 2 * unit]
    if len(band) <= 4 * k:
        return keep
    above = keep[scores[keep] > kth + 2 * unit]
    x = scores[band] * (4 / unit)
    cell = np.floor(x)
    frac = x - cell
    edge = (frac < 1e-3) | (frac > 1 - 1e-3)  # may fall on either side: a cell by exact value
    order = np.lexsort((ids[band], np.where(edge, scores[band], 0.0), edge, np.where(edge, 0.0, cell)))
    e, c, s = edge[order], np.where(edge, 0.0, cell)[order], np.where(edge, scores[band], 0.0)[order]
    first = np.concatenate(([True], (e[1:] != e[:-1]) | (c[1:] != c[:-1]) | (s[1:] != s[:-1])))
    nth = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    return np.concatenate((above, band[order[nth < k]]))

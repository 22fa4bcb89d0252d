"""BagMinHash: signatures whose positions agree with the probability of the weighted Jaccard similarity.

A bag gives each element a whole weight, its count. Weights are discretised in steps of 1. For every
element the real line is cut into [0, 1), [1, 2), [2, 4), [4, 8) ..., and each piece carries a Poisson
process of its own, seeded by the element and the piece, with as many points per unit of time as the
piece is long. A point lies at a uniform place of its piece and belongs to a bag if that place is below
the element's weight: a piece wholly below it keeps all points, and one that the weight cuts is split
at the weight's step. So two bags share exactly the points below the smaller of their weights, and the
work grows with the logarithm of a weight. A point also names one signature position; a position keeps
the earliest point that names it. Points are drawn in time order only until the latest position is
filled, which takes about m ln m points for a bag however large it is.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.common import mix64

_PIECE, _TIME, _PLACE = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3)
# A first try draws points for so many times the mean needed; few bags need a second one.
_SLACK = 4.0


def _uniform(bits: np.ndarray) -> np.ndarray:
    """Strictly between 0 and 1."""
    return ((bits >> np.uint64(12)).astype(np.float64) + 0.5) / float(1 << 52)


def _pieces(bag: np.ndarray, element: np.ndarray, weight: np.ndarray):
    """For each (bag, element) all pieces that start below its weight: bag, seed, start, length, weight."""
    out = []
    start, length, level = 0, 1, 0
    while len(bag):
        out.append((bag, mix64(element + mix64(np.full(1, level, np.uint64) ^ _PIECE)), np.full(len(bag), start), np.full(len(bag), length), weight))
        start, length = (1, 1) if level == 0 else (start * 2, length * 2)
        level += 1
        more = weight > start
        bag, element, weight = bag[more], element[more], weight[more]
    return [np.concatenate(parts) for parts in zip(*out, strict=True)]


def signatures(bag: np.ndarray, element: np.ndarray, weight: np.ndarray, n_bags: int, m: int) -> np.ndarray:
    """Signatures of `m` 64-bit values for bags 0 to n_bags - 1, each with at least one element.

    The three arrays have an entry for each distinct element of each bag.
    """
    result = np.zeros((n_bags, m), np.uint64)
    total = np.bincount(bag, weights=weight, minlength=n_bags)
    factor, todo = 1.0, np.ones(n_bags, bool)
    while todo.any():
        limit = factor * (np.log(m) + _SLACK) * m / np.maximum(total, 1)
        use = todo[bag]
        filled = _draw(bag[use], element[use], weight[use], limit, n_bags, m, result)
        todo &= ~filled
        factor *= 2
    return result


def _draw(bag, element, weight, limit, n_bags: int, m: int, result: np.ndarray) -> np.ndarray:
    """Fills the rows of `result` whose positions all have a point before `limit`; says which."""
    bag, seed, start, length, weight = _pieces(bag, element, weight)
    time, cells, times, marks = np.zeros(len(bag)), [], [], []
    step = np.zeros(1, np.uint64)
    while len(bag):
        step += np.uint64(1)
        draw = mix64(seed ^ mix64(step ^ _TIME))
        time = time - np.log(_uniform(draw)) / length
        alive = time <= limit[bag]
        bag, seed, start, length, weight, time, draw = (x[alive] for x in (bag, seed, start, length, weight, time, draw))
        mark = mix64(draw ^ _PLACE)
        # The place within the piece, in whole steps; points at or above the weight are another bag's.
        inside = start + (_uniform(mix64(mark)) * length).astype(np.int64) < weight
        cells.append(bag[inside] * m + ((mark[inside] >> np.uint64(32)) % np.uint64(m)).astype(np.int64))
        times.append(time[inside])
        marks.append(mark[inside])
    cell, at, mark = np.concatenate(cells), np.concatenate(times), np.concatenate(marks)
    earliest = np.full(n_bags * m, np.inf)
    np.minimum.at(earliest, cell, at)
    first = at == earliest[cell]
    filled = np.isfinite(earliest).reshape(n_bags, m).all(axis=1)
    own = first & filled[cell // m]
    result.reshape(-1)[cell[own]] = mark[own]
    return filled


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key for each of `bands` equal parts of the signatures, as signed numbers."""
    parts = signature.reshape(len(signature), bands, -1)
    keys = np.tile(np.arange(bands, dtype=np.uint64), (len(signature), 1))
    for k in range(parts.shape[2]):
        keys = mix64(keys ^ parts[:, :, k])
    return keys.view(np.int64)

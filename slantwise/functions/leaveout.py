"""Array code for leaving tokens out of a text; it runs inside Python workers.

A text is looked up as term numbers, a fixed number per token: the n-grams that start at
the token, and those that bridge the gap it leaves, -1 where there is none or the
model does not know it. The module travels with the job.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from slantwise.functions.grams import TermIndex, lists_of, replaced, slices


# Tokens looked up at once; each has a number for every shape.
TRIED_TOKENS = 1 << 15


def layout(low: int, high: int) -> tuple[list[int], list[tuple[int, int]]]:
    """Sizes of the n-grams that start at a token, and (size, tokens before the gap) of the bridging ones."""
    sizes = list(range(low, high + 1))
    return sizes, [(n, before) for n in sizes for before in range(1, n)]


def softmax(z: np.ndarray) -> np.ndarray:
    mass = np.exp(z - z.max(axis=-1, keepdims=True))
    return mass / mass.sum(axis=-1, keepdims=True)


def _tf_weight(tf: np.ndarray, sublinear: bool) -> np.ndarray:
    return np.where(tf > 0, 1.0 + np.log(np.maximum(tf, 1)), 0.0) if sublinear else tf.astype(float)


def _net_changes(numbers: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row of ``numbers`` the sum of steps of each known number: ``(rows, numbers, sums)``."""
    order = np.argsort(numbers, axis=1, kind="stable")
    sorted_ = np.take_along_axis(numbers, order, axis=1)
    steps = steps[order].ravel()
    first = np.ones(sorted_.shape, bool)
    first[:, 1:] = sorted_[:, 1:] != sorted_[:, :-1]
    at = np.flatnonzero(first.ravel())
    sums = np.add.reduceat(steps, at)
    found = sorted_.ravel()[at]
    kept = (found >= 0) & (sums != 0)
    return (at // numbers.shape[1])[kept], found[kept], sums[kept]


def importances(cells: np.ndarray, low: int, high: int, idf: np.ndarray, coefs: np.ndarray, intercepts: np.ndarray, sublinear: bool) -> np.ndarray:
    """Fall of the predicted class's probability when each token is left out, for one text."""
    sizes, bridges = layout(low, high)
    table = np.asarray(cells, np.int64).reshape(-1, len(sizes) + len(bridges))
    count = len(table)
    whole = table[:, : len(sizes)]
    terms, tf = np.unique(whole[whole >= 0], return_counts=True)
    weight = _tf_weight(tf, sublinear) * idf[terms]
    squares, dots = float(weight @ weight), weight @ coefs[terms]
    taken = []
    for column, n in enumerate(sizes):
        for back in range(n):  # n-grams that start up to n - 1 tokens earlier cover this one
            moved = np.full(count, -1)
            moved[back:] = whole[: count - back, column]
            taken.append(moved)
    numbers = np.stack([*taken, *table[:, len(sizes) :].T], axis=1)
    steps = np.array([-1] * len(taken) + [1] * len(bridges))
    row, number, change = _net_changes(numbers, steps)
    place = np.minimum(np.searchsorted(terms, number), max(len(terms) - 1, 0))
    had = np.where(terms[place] == number, tf[place], 0) if len(terms) else np.zeros(len(number), np.int64)
    old, new = _tf_weight(had, sublinear) * idf[number], _tf_weight(had + change, sublinear) * idf[number]
    known = len(terms) + np.bincount(row, (had + change > 0).astype(float) - (had > 0), count)
    left = np.where(known > 0, squares + np.bincount(row, new * new - old * old, count), 0.0)
    dots_left = dots + np.stack([np.bincount(row, (new - old) * coefs[number, k], count) for k in range(coefs.shape[1])], axis=1)

    def decide(dot: np.ndarray, square: np.ndarray) -> np.ndarray:
        some = square > 0
        return intercepts + np.where(some, dot / np.sqrt(np.where(some, square, 1.0)), 0.0)

    before = decide(dots, np.array([squares]))
    chosen = int(np.argmax(np.round(before, 12)))
    return softmax(before)[chosen] - softmax(decide(dots_left, left[:, None]))[:, chosen]


def _leading(falls: np.ndarray, k: int, digits: int) -> np.ndarray:
    """Places of all falls that may be among the ``k`` largest once rounded, ties by place.

    A fall in the middle between two rounded values may go to either, so it is kept beside the ``k`` largest of the others.
    """
    scaled = np.abs(falls) * 10.0**digits
    unsure = np.abs(scaled - np.floor(scaled) - 0.5) < 1e-6
    sure = np.flatnonzero(~unsure)
    first = sure[np.argsort(-np.floor(scaled[sure] + 0.5), kind="stable")[:k]]
    return np.sort(np.concatenate([first, np.flatnonzero(unsure)]))


def with_falls(batches, parts_of_index: tuple, model: tuple, low: int, high: int, sublinear: bool, k: int, most: int | None, digits: int):
    """Batches whose last column, lists of tokens, gives way to ``falls``: ``(position, token, fall)`` of those that may be listed.

    Terms are looked up, and texts tried, a slice at a time, so what a worker holds does not grow with the rows of a batch.
    ``most`` is the number of tokens of a text that count. A text of one token has nothing left to score.
    """
    index = TermIndex(*parts_of_index)
    starts, bridges = layout(low, high)
    shapes = [tuple(range(n)) for n in starts] + [(*range(-before, 0), *range(1, n - before + 1)) for n, before in bridges]
    for batch in batches:
        at = 0
        for rows, count, tokens in slices(batch.column(batch.num_columns - 1), TRIED_TOKENS):
            find = index.finder(index.coded(tokens), rows)
            cells = np.stack([find(shape) for shape in shapes], axis=1)
            sizes = np.bincount(rows, minlength=count)
            bounds = np.concatenate([[0], np.cumsum(sizes)])
            found, listed = [], np.zeros(count, np.int64)
            for row in np.flatnonzero(sizes > 1):
                falls = importances(cells[bounds[row] : bounds[row + 1]], low, high, *model, sublinear)[:most]
                places = _leading(falls, k, digits)
                found.append((places, bounds[row] + places, falls[places]))
                listed[row] = len(places)
            position, place, fall = (np.concatenate([f[i] for f in found]) if found else np.zeros(0) for i in range(3))
            columns = [pa.array(position.astype(np.int32)), tokens.take(pa.array(place.astype(np.int64))), pa.array(fall)]
            yield replaced(batch, at, lists_of(listed, pa.StructArray.from_arrays(columns, ["position", "token", "fall"])), "falls")
            at += count


cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""N-grams of single texts, scored against the text they stand in; it runs inside Python workers.

The module travels with the job.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

from slantwise.functions.grams import slices


def _distinct(row: np.ndarray, term: np.ndarray, low: int, high: int):
    """``(n, first, members)`` per length: place of every distinct n-gram of a row, and its terms."""
    places, state, width = np.arange(len(term)), term, len(term) + 1
    for n in range(1, high + 1):
        if n > 1:
            inside = places + n - 1 < len(term)
            places, state = places[inside], state[inside]
            same = row[places] == row[places + n - 1]
            places, state = places[same], state[same] * width + term[places[same] + n - 1]
        _, first, state = np.unique(state, return_index=True, return_inverse=True)
        if n >= low:
            yield n, places[first], term[places[first][:, None] + np.arange(n)]


def _scored(rows: np.ndarray, codes: np.ndarray, content: np.ndarray, count: int, low: int, high: int):
    """``(row, raw, first, n)`` of the distinct n-grams of a slice; ``first`` is a place among the content tokens."""
    width = int(codes.max(initial=0)) + 1
    row = rows[content]
    key, term, tf = np.unique(row * width + codes[content], return_inverse=True, return_counts=True)
    owner, total = key // width, len(key)
    grams = list(_distinct(row, term, low, high))
    held, candidates = np.zeros(total, np.int64), np.zeros(count, np.int64)
    for n, first, members in grams:
        candidates += np.bincount(row[first], minlength=count)
        for k in range(n):
            new = np.all(members[:, :k] != members[:, k : k + 1], axis=1)
            held += np.bincount(members[new, k], minlength=total)
    idf = np.log((candidates[owner] + 2.0) / (held + 2.0)) + 1.0
    # The text's length: content terms, then terms that no candidate holds.
    stop_key, stop_tf = np.unique(rows[~content] * width + codes[~content], return_counts=True)
    rare = np.log((candidates + 2.0) / 2.0) + 1.0
    norm = np.bincount(owner, tf * idf * tf * idf, count) + np.bincount(stop_key // width, stop_tf * stop_tf, count) * rare * rare
    square = idf * idf
    dot = tf * square
    for n, first, members in grams:
        top, own = dot[members[:, 0]], square[members[:, 0]]
        for k in range(1, n):
            top, own = top + dot[members[:, k]], own + square[members[:, k]]
        for i in range(n):
            for j in range(i + 1, n):
                # A term used twice in a candidate has weight 2 there: its square counts 4 times.
                own = own + np.where(members[:, i] == members[:, j], square[members[:, i]] * 2, 0.0)
        yield row[first], top / np.sqrt(norm[row[first]] * own), first, n


def leading_grams(lists: pa.Array, stop: frozenset, low: int, high: int, top_k: int, slack: float) -> pa.ListArray:
    """Per row ``(raw, keyword)`` of the distinct n-grams that may be among the best ``top_k``, within ``slack``."""
    sizes, raws, words = [], [], []
    for rows, count, tokens in slices(lists):
        found = tokens.dictionary_encode()
        codes = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        content = ~np.array([name in stop for name in found.dictionary.to_pylist()], bool)[codes] if len(codes) else np.zeros(0, bool)
        scored = list(_scored(rows, codes, content, count, low, high))
        row, raw = (np.concatenate([part[k] for part in scored]) for k in (0, 1))
        order = np.lexsort((-raw, row))
        ends = np.cumsum(np.bincount(row, minlength=count))
        last = np.minimum(np.concatenate([[0], ends])[:-1] + top_k, ends) - 1
        floor = raw[order[np.maximum(last, 0)]] if len(row) else np.zeros(count)
        kept = raw >= floor[row] - slack
        names, at = [], 0
        for _, _, first, n in scored:
            own = codes[content][first[kept[at : at + len(first)]][:, None] + np.arange(n)]
            parts = [found.dictionary.take(pa.array(own[:, k])) for k in range(n)]
            names.append(pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0])
            at += len(first)
        by_row = np.argsort(row[kept], kind="stable")
        sizes.append(np.bincount(row[kept], minlength=count))
        raws.append(raw[kept][by_row])
        words.append(pa.concat_arrays(names).take(pa.array(by_row)))
    cells = pa.StructArray.from_arrays(
        [pa.array(np.concatenate(raws) if raws else np.zeros(0)), pa.concat_arrays(words) if words else pa.array([], pa.string())], ["raw", "keyword"]
    )
    bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if sizes else np.zeros(1)
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), cells)


cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Array code for character n-grams; it runs inside Python workers.

A gram of up to three characters is one number, 21 bits a character, so texts are
counted and scored without a Python object per gram. The module travels with the
job: executors need no copy of this package.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle

CHAR_BITS = 21
LONGEST = 63 // CHAR_BITS
TEXTS_AT_ONCE = 1 << 20  # characters of whole texts that are worked on together


def gram_keys(texts: list[str], sizes: tuple[int, ...]):
    """``(keys, text numbers)`` of all grams, one size after another; no gram spans two texts."""
    chars = np.frombuffer("\0".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    owner = np.cumsum(chars == 0)
    for size in sizes:
        count = len(chars) - size + 1
        if count <= 0:
            continue
        keys, inside = np.zeros(count, np.int64), np.ones(count, bool)
        for k in range(size):
            part = chars[k : k + count]
            keys |= part << (CHAR_BITS * k)
            inside &= part != 0
        yield keys[inside], owner[:count][inside]


def spelled(key: int) -> str:
    out = ""
    while key:
        out += chr(key & ((1 << CHAR_BITS) - 1))
        key >>= CHAR_BITS
    return out


def key_of(gram: str) -> int:
    return sum(ord(c) << (CHAR_BITS * k) for k, c in enumerate(gram))


def _chunks(texts: list[str]):
    first, size = 0, 0
    for k, text in enumerate(texts):
        if size and size + len(text) > TEXTS_AT_ONCE:
            yield first, k
            first, size = k, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def count_by_label(frames, sizes: tuple[int, ...]):
    """``(lang, gram, n)`` of each batch, its texts folded together per label."""
    for frame in frames:
        for label, own in frame.groupby("lang")["letters"]:
            texts = own.tolist()
            for first, last in _chunks(texts):
                for keys, _ in gram_keys(texts[first:last], sizes):
                    found, counts = np.unique(keys, return_counts=True)
                    yield pd.DataFrame({"lang": label, "gram": [spelled(k) for k in found.tolist()], "n": counts.astype(np.int64)})


def label_scores(texts: list[str], keys: np.ndarray, weights: np.ndarray, sizes: tuple[int, ...]) -> np.ndarray:
    """Sum of weights per text and label; ``weights`` has a row per key and a column per label."""
    out = np.zeros((len(texts), weights.shape[1]))
    if not len(keys):
        return out
    for first, last in _chunks(texts):
        for found, owner in gram_keys(texts[first:last], sizes):
            at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
            known = keys[at] == found
            at, owner = at[known], owner[known]
            for label in range(weights.shape[1]):
                out[first:last, label] += np.bincount(owner, weights[at, label], last - first)
    return out


cloudpickle.register_pickle_by_value(sys.modules[__name__])

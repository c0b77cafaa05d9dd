"""Sorted suffixes of one shard of texts and binary search of test suffixes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa

from slantwise.llm import kernels


def word_codes(hashes: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Position of each word in the sorted test vocabulary from 2 on; 1 elsewhere."""
    if not len(vocabulary):
        return np.ones(len(hashes), np.uint32)
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, at + 2, 1).astype(np.uint32)


class TestItems:
    """Benchmark items as code sequences; the suffixes that start a window."""

    def __init__(self, ids: list[str], texts: pa.Array, window: int):
        self.window, self.ids = window, ids
        sets, hashes = [], []
        for _, _, data, bounds in kernels.pieces(texts):
            words = kernels.Words(data, bounds, "alphanumeric", lower=True)
            for k in range(len(words.counts)):
                sets.append(words.hash[words.bounds[k] : words.bounds[k + 1]])
        self.vocabulary = np.unique(np.concatenate(sets)) if sets else np.zeros(0, np.uint64)
        codes = [word_codes(x, self.vocabulary) for x in sets]
        self.bounds = np.concatenate([[0], np.cumsum([len(x) for x in codes])]).astype(np.int64)
        self.codes = np.concatenate(codes) if codes else np.zeros(0, np.uint32)
        counts = np.diff(self.bounds)
        size = np.minimum(window, counts)
        starts = np.where(size > 0, counts - size + 1, 0)
        item = np.repeat(np.arange(len(counts)), starts)
        at = np.arange(len(item)) - np.repeat(np.cumsum(starts) - starts, starts)
        length = size[item]
        table = np.zeros((len(item), window), ">u4")
        for k in range(window):
            use = length > k
            table[use, k] = self.codes[(self.bounds[item] + at + k)[use]]
        order = np.argsort(_as_keys(table), kind="stable")
        self.item, self.at, self.length = (x[order].astype(np.int32) for x in (item, at, length))
        self.shortest = int(self.length.min()) if len(order) else window
        self.low = _as_keys(table[order])
        # Only items shorter than a window need an upper key of their own.
        self.short = np.flatnonzero(self.length < window)
        high = table[order][self.short]
        high[np.arange(window) >= self.length[self.short][:, None]] = 0xFFFFFFFF
        self.high = _as_keys(high)


def _as_keys(table: np.ndarray) -> np.ndarray:
    """Rows of big-endian codes as byte strings, which compare word by word."""
    table = np.ascontiguousarray(table)
    return table.view(f"S{table.shape[1] * 4}").reshape(-1) if len(table) else np.zeros(0, f"S{table.shape[1] * 4}")


def suffix_array(codes: np.ndarray, doc: np.ndarray, depth: int, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of a shard in lexicographic order of their first ``depth`` words.

    A suffix whose first ``shortest`` words are not all test words can match no
    test suffix long enough, so it is left out. Code 0 ends a text.
    """
    n = len(codes)
    known = codes > 1
    total = np.zeros(n + 1, np.int64)
    np.cumsum(known, out=total[1:])
    start = np.arange(max(0, n - shortest + 1))
    start = start[(total[start + shortest] - total[start] == shortest) & (doc[start] == doc[start + shortest - 1])]
    table = np.zeros((len(start), depth), ">u4")
    for k in range(depth):
        at = np.minimum(start + k, n - 1)
        inside = (start + k < n) & (doc[at] == doc[start])
        table[:, k] = np.where(inside, codes[at], 0)
    keys = _as_keys(table)
    order = np.argsort(keys, kind="stable")
    return start[order], keys[order]


class Matches:
    """Occurrences of test windows in one shard, a class of equal test suffixes at a time.

    Equal suffixes have one range of the suffix array, so an occurrence is held once
    per class, never once per pair of a test suffix and a place.
    """

    def __init__(self, items: TestItems, codes: np.ndarray, doc: np.ndarray):
        self.items, self.codes, self.doc = items, codes, doc
        self.place = self.size = self.rows = self.place_class = self.row_class = np.zeros(0, np.int64)
        if not len(items.low) or not len(codes):
            return
        start, keys = suffix_array(codes, doc, items.window, items.shortest)
        low = np.searchsorted(keys, items.low, "left")
        high = np.searchsorted(keys, items.low, "right")
        high[items.short] = np.searchsorted(keys, items.high, "right")
        self.rows = np.flatnonzero(high > low)
        width, length = len(start) + 1, items.length[self.rows].astype(np.int64)
        classes = (low[self.rows] * width + high[self.rows]) * (items.window + 1) + length
        _, one, self.row_class = np.unique(classes, return_index=True, return_inverse=True)
        low, high = low[self.rows][one], high[self.rows][one]
        self.place_class, at = _ranges(low, high)
        self.place = start[at].astype(np.int64)
        self.size = length[one][self.place_class]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Texts and items that share a window, each pair once."""
        kind, texts = _distinct_pairs(self.place_class, self.doc[self.place].astype(np.int64))
        of, items = _distinct_pairs(self.row_class, self.items.item[self.rows].astype(np.int64))
        mine, at = _ranges(np.searchsorted(of, kind, "left"), np.searchsorted(of, kind, "right"))
        return _distinct_pairs(texts[mine], items[at])

    def longest(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places where a window occurs, the longest match there, and a test suffix it is with.

        A match goes on while the next words of text and item begin equal windows.
        Runs of class numbers are sorted, texts and items together, by doubling; a
        place has its longest match with the item suffix next to it.
        """
        full = self.size == self.items.window
        whole = self.items.length[self.rows] == self.items.window
        found = self._runs(self.place[full], self.place_class[full], self.rows[whole], self.row_class[whole])
        first_row = np.zeros(len(self.rows), np.int64)
        first_row[self.row_class[::-1]] = self.rows[::-1]
        short = (self.place[~full], self.size[~full], first_row[self.place_class[~full]])
        place, size, row = (np.concatenate(x) for x in zip(found, short))
        order = np.lexsort((row, -size, place))
        best = order[np.append(True, place[order][1:] != place[order][:-1])] if len(order) else order
        return place[best], size[best], row[best]

    def _runs(self, place: np.ndarray, place_class: np.ndarray, rows: np.ndarray, row_class: np.ndarray):
        items, texts = self.items, len(place)
        if not texts:
            return place, place, place
        item = items.item[rows].astype(np.int64)
        at = np.concatenate([place, len(self.codes) + 1 + items.bounds[item] + items.at[rows]])
        owner = np.concatenate([self.doc[place].astype(np.int64), -1 - item])
        order = np.argsort(at, kind="stable")
        at, owner = at[order], owner[order]
        n, index = len(at), np.arange(len(at))
        last = np.append((at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1]), True)
        left = np.flatnonzero(last)[np.cumsum(last) - last] - index + 1  # windows to the end of the run
        levels = [np.concatenate([place_class, row_class])[order]]
        while (reach := 1 << (len(levels) - 1)) < left.max():
            after = np.where(left > reach, levels[-1][np.minimum(index + reach, n - 1)], -1)
            levels.append(np.unique(levels[-1] * (n + 1) + after + 1, return_inverse=True)[1])
        ranked = np.argsort(levels[-1], kind="stable")
        is_item = order[ranked] >= texts
        before = np.maximum.accumulate(np.where(is_item, index, -1))
        behind = np.minimum.accumulate(np.where(is_item, index, n)[::-1])[::-1]
        mine = ranked[~is_item]
        best, partner = np.zeros(texts, np.int64), np.zeros(texts, np.int64)
        for near in (before[~is_item], behind[~is_item]):
            known = (near >= 0) & (near < n)
            other = ranked[np.clip(near, 0, n - 1)]
            length = np.where(known, _common_run(mine, other, levels, left), 0)
            best, partner = np.maximum(best, length), np.where(length > best, other, partner)
        return at[mine], best + items.window - 1, rows[order[partner] - texts]


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and the range that each comes from."""
    counts = high - low
    which = np.repeat(np.arange(len(counts)), counts)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts - low, counts)


def _distinct_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs, sorted."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def _common_run(a: np.ndarray, b: np.ndarray, levels: list[np.ndarray], left: np.ndarray) -> np.ndarray:
    """Equal windows in a row from each of ``a`` and ``b``; a level's rank covers twice the windows of the one below."""
    total, going = np.zeros(len(a), np.int64), np.ones(len(a), bool)
    for power in reversed(range(len(levels))):
        reach = 1 << power
        equal = going & (levels[power][a] == levels[power][b])
        shared = np.minimum(np.minimum(left[a], left[b]), reach)
        total += np.where(equal, shared, 0)
        going &= ~equal | ((left[a] > reach) & (left[b] > reach))
        step = np.where(equal & going, reach, 0)
        a, b = a + step, b + step
    return total


def leak_columns(items: Iterable[TestItems], column: pa.Array, places: bool = True) -> pa.RecordBatch:
    """Words, hit words and items of each text; with ``places`` the longest matches too."""
    rows = len(column)
    n_words, n_hit, longest = (np.zeros(rows, np.int64) for _ in range(3))
    names: list[set[str]] = [set() for _ in range(rows)]
    spots: list[list[str]] = [[] for _ in range(rows)]
    shards, hits = list(kernels.pieces(column)), []
    for first, last, data, bounds in shards:
        words = kernels.Words(data, bounds, "alphanumeric", lower=True)
        n_words[first:last] = words.counts
        hits.append(np.zeros(len(words.hash), bool))
    for block in items:
        for (first, _, data, bounds), hit in zip(shards, hits):
            words = kernels.Words(data, bounds, "alphanumeric", lower=True)
            found = Matches(block, word_codes(words.hash, block.vocabulary), words.doc)
            if not len(found.place):
                continue
            hit |= kernels.covered(found.place, found.size, len(hit))
            for text, item in zip(*(x.tolist() for x in found.pairs())):
                names[first + text].add(block.ids[item])
            if places:
                place, size, row = found.longest()
                np.maximum.at(longest, first + words.doc[place], size)
                # A match that only goes on from the word before is part of that one.
                ongoing = np.zeros(len(place), bool)
                ongoing[1:] = (place[1:] == place[:-1] + 1) & (words.doc[place[1:]] == words.doc[place[:-1]]) & (size[1:] == size[:-1] - 1)
                for p, n, r in zip(place[~ongoing].tolist(), size[~ongoing].tolist(), row[~ongoing].tolist()):
                    text = int(words.doc[p])
                    spots[first + text].append(f"{p - int(words.bounds[text])}:{n}:{block.ids[block.item[r]]}:{block.at[r]}")
    ends = np.concatenate([[0], np.cumsum(n_words)])
    whole = np.concatenate(hits) if hits else np.zeros(0, bool)
    n_hit[:] = kernels.per_text(ends, whole)
    digest = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in names]
    arrays = [pa.array(n_words), pa.array(n_hit), pa.array([len(x) for x in names], pa.int64()), pa.array(digest, pa.string()), pa.array(n_hit > 0)]
    if places:
        arrays += [pa.array(longest), pa.array([sorted(set(x)) for x in spots], pa.list_(pa.string()))]
    return pa.RecordBatch.from_arrays(arrays, ["n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest_match", "matches"][: len(arrays)])

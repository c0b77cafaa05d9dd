"""Distinct n-grams of classes of texts, as rows of 64-bit token names; it runs inside Python workers.

Texts come as Arrow lists of token names. The module travels with the job.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

from slantwise.functions.grams import MIX, STEP, slices

# Content tokens whose n-grams are made distinct at once, and pairs of class and term kept before they are sent.
TOKENS, PAIRS = 1 << 20, 1 << 20


def _codes(column: pa.Array, places: dict) -> np.ndarray:
    """Number of every value, the same for all batches of a task."""
    found = column.dictionary_encode()
    own = np.array([places.setdefault(value, len(places)) for value in found.dictionary.to_pylist()], np.int64)
    return own[found.indices.to_numpy(zero_copy_only=False)]


def _starts(row: np.ndarray, n: int) -> np.ndarray:
    """Places from which ``n`` tokens stand in one row."""
    return np.flatnonzero(row[: len(row) - n + 1] == row[n - 1 :]) if len(row) >= n else np.zeros(0, np.int64)


def _first_rows(columns: list[np.ndarray]) -> np.ndarray:
    """Place of one of each distinct row of a table."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    order = np.lexsort(columns)
    new = np.zeros(len(order), bool)
    new[0] = True
    for column in columns:
        own = column[order]
        new[1:] |= own[1:] != own[:-1]
    return order[new]


def _distinct(group: np.ndarray, row: np.ndarray, name: np.ndarray, low: int, high: int):
    """``(n, group, members)`` of the distinct n-grams of every group."""
    names, term = np.unique(name, return_inverse=True)
    state = group * len(names) + term
    for n in range(1, high + 1):
        places = _starts(row, n)
        if n > 1:
            # The number of the n-gram's prefix, which stands at the same place.
            state = prefix[places] * len(names) + term[places + n - 1]
        _, first, number = np.unique(state, return_index=True, return_inverse=True)
        prefix = np.zeros(len(name), np.int64)
        prefix[places] = number
        if n >= low:
            at = places[first]
            yield n, group[at], name[at[:, None] + np.arange(n)]


def gram_parts(batches, stop: np.ndarray, low: int, high: int, bits: int):
    """``(bucket, class_name, n, data)``: distinct n-grams of class and tokens, packed per bucket of their hash.

    Length 0 stands for all tokens, each with the number of times it occurs.
    """
    places, waiting, every, held, texts = {}, [], [], 0, 0

    def tables(classes):
        group, name = (np.concatenate([part[k] for part in every]) for k in range(2))
        for k in range(len(classes)):
            terms, tf = np.unique(name[group == k], return_counts=True)
            yield 0, np.full(len(terms), k), np.stack([terms, tf], axis=1)
        group, row, name = (np.concatenate([part[k] for part in waiting]) for k in range(3))
        yield from _distinct(group, row, name, low, high)

    def packed():
        classes, rows = list(places), []
        for n, own, members in tables(classes):
            running = np.zeros(len(own), np.uint64)
            for k in range(max(n, 1)):
                running = running * STEP + members[:, k].astype(np.uint64)
            mixed = (running ^ (running >> np.uint64(32))) * MIX
            key = (mixed >> np.uint64(64 - bits)).astype(np.int64) * len(classes) + own
            order = np.argsort(key, kind="stable")
            members, key = members[order], key[order]
            edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else [0]
            for a, b in zip(edges[:-1], edges[1:]):
                rows.append((int(key[a]) // len(classes), classes[int(key[a]) % len(classes)], n, members[a:b].tobytes()))
        for at in range(0, len(rows), 512):
            columns = list(zip(*rows[at : at + 512]))
            types = [pa.int32(), pa.string(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["bucket", "class_name", "n", "data"])

    for batch in batches:
        classes, start = _codes(batch.column(0), places), 0
        for rows, count, tokens in slices(batch.column(1)):
            name = tokens.to_numpy(zero_copy_only=False)
            content = ~np.isin(name, stop)
            row = rows[content]
            every.append((classes[start + rows], name))
            waiting.append((classes[start + row], texts + row, name[content]))
            held, start, texts = held + len(name), start + count, texts + count
            if held > TOKENS:
                yield from packed()
                waiting, every, held = [], [], 0
    if held:
        yield from packed()


def term_counts(batches):
    """``(class_name, term, tf, held)``: places of a term, and distinct n-grams that hold it; all of a class as the null term.

    All parts of a bucket come to one task, in order of bucket, class and length. A pair may have several rows.
    """
    sums, totals, size = {}, {}, 0

    def closed(kind, parts):
        _, name, n = kind
        members = np.frombuffer(b"".join(parts), np.int64).reshape(-1, n or 2)
        if n == 0:
            terms, tf = members.T
            counts = np.zeros(len(terms), np.int64)
        else:
            members = members[_first_rows([members[:, k] for k in range(n)])]
            totals[name] = totals.get(name, 0) + len(members)
            new = [np.all(members[:, :k] != members[:, k : k + 1], axis=1) for k in range(n)]
            terms, counts = np.unique(np.concatenate([members[new[k], k] for k in range(n)]), return_counts=True)
            tf = np.zeros(len(terms), np.int64)
        sums.setdefault(name, []).append((terms, tf, counts))
        return len(terms)

    def merged():
        for name, parts in sums.items():
            terms, inverse = np.unique(np.concatenate([part[0] for part in parts]), return_inverse=True)
            added = [np.bincount(inverse, np.concatenate([part[k] for part in parts]), len(terms)).astype(np.int64) for k in (1, 2)]
            columns = [pa.array([name] * len(terms), pa.string()), pa.array(terms, pa.int64()), *(pa.array(x) for x in added)]
            yield pa.RecordBatch.from_arrays(columns, ["class_name", "term", "tf", "held"])

    now, parts = None, []
    for batch in batches:
        kinds = zip(*(batch.column(k).to_pylist() for k in range(3)))
        for kind, data in zip(kinds, batch.column(3)):
            if kind != now:
                size += closed(now, parts) if parts else 0
                now, parts = kind, []
                if size > PAIRS:
                    yield from merged()
                    sums, size = {}, 0
            parts.append(data.as_buffer())
    if parts:
        closed(now, parts)
    yield from merged()
    none = pa.nulls(len(totals), pa.int64())
    columns = [pa.array(list(totals), pa.string()), none, none, pa.array(list(totals.values()), pa.int64())]
    yield pa.RecordBatch.from_arrays(columns, ["class_name", "term", "tf", "held"])


def reaching(batches, stop: np.ndarray, low: int, high: int, top_k: int, known: dict, rest: float, least: dict, floors: dict, slack: dict):
    """``(class_name, keyword)`` of the n-grams whose product with their class may reach its floor.

    ``known`` has ``(terms, totals, idfs)`` of a class, by term; other terms weigh ``rest`` at
    most and have an idf of ``least`` at least. Where u of the terms are not known, the product is at most
    (dot + rest * sqrt(u) * x) / sqrt(square + x * x), with the length x of the part they have in the n-gram.
    It is greatest at rest * sqrt(u) * square / dot, and falls after that.

    The floors rise: where ``top_k`` different n-grams of known terms have a product, one that is
    less by more than the ``slack`` of its class is not among the best.
    """
    floors = dict(floors)
    for batch in batches:
        places: dict = {}
        classes, start = _codes(batch.column(0), places), 0
        labels = list(places)
        for (rows, count, tokens), (_, _, words) in zip(slices(batch.column(1)), slices(batch.column(2))):
            name = tokens.to_numpy(zero_copy_only=False)
            content = np.flatnonzero(~np.isin(name, stop))
            row, name = rows[content], name[content]
            group = classes[start + row]
            start += count
            total, idf, other = np.zeros(len(name)), np.zeros(len(name)), np.ones(len(name), bool)
            for k, label in enumerate(labels):
                terms, totals, idfs = known[label]
                own = np.flatnonzero(group == k)
                if len(terms) and len(own):
                    at = np.minimum(np.searchsorted(terms, name[own]), len(terms) - 1)
                    hit = terms[at] == name[own]
                    total[own[hit]], idf[own[hit]], other[own[hit]] = totals[at[hit]], idfs[at[hit]], False
            floor, lowest = (np.array([values[label] for label in labels]) for values in (floors, least))
            dot, square, found = idf * total, idf * idf, []
            for n in range(low, high + 1):
                first = _starts(row, n)
                top, own, outside = (sum(values[first + i] for i in range(n)) for values in (dot, square, other.astype(np.int64)))
                for i in range(n):
                    for j in range(i + 1, n):
                        # A term used twice has weight 2 there: its square counts 4 times.
                        own = own + np.where(name[first + i] == name[first + j], square[first + i] * 2, 0.0)
                side = np.sqrt(outside)
                length = np.maximum(side * lowest[group[first]], rest * side * own / np.where(top > 0, top, 1.0))
                norm = np.sqrt(own + length * length)
                most = (top + rest * side * length) / np.where(norm > 0, norm, 1.0)
                kept = np.flatnonzero(most >= floor[group[first]])
                kept = kept[_first_rows([group[first[kept]], *(name[first[kept] + i] for i in range(n))])]
                found.append((n, first[kept], most[kept], outside[kept] == 0))
            owner, most, exact = (np.concatenate(x) for x in ([group[first] for _, first, _, _ in found], *zip(*((m, e) for _, _, m, e in found))))
            for k, label in enumerate(labels):
                sure = most[exact & (owner == k)]
                if len(sure) >= top_k:
                    floors[label] = max(floors[label], np.partition(sure, -top_k)[-top_k] - slack[label])
            floor = np.array([floors[label] for label in labels])
            for n, first, most, _ in found:
                first = first[most >= floor[group[first]]]
                if len(first):
                    parts = [words.take(pa.array(content[first + i])) for i in range(n)]
                    keyword = pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0]
                    label = pa.array(labels, pa.string()).take(pa.array(group[first]))
                    yield pa.RecordBatch.from_arrays([label, keyword], ["class_name", "keyword"])


cloudpickle.register_pickle_by_value(sys.modules[__name__])

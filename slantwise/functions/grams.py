"""N-grams of token arrays as numbers; it runs inside Python workers.

Tokens come as Arrow lists, one per row. They are coded once per batch, and n-grams
are found for all positions of a slice at once. The module travels with the job.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Tokens handled at once; a longer row is a slice of its own.
SLICE_TOKENS = 1 << 18

# Buckets in a row of counts, and rows sent at once.
PART, PARTS = 1 << 13, 64


def slices(lists: pa.Array, most: int | None = None):
    """Parts of a list array as ``(row of each token, number of rows, tokens)``; null rows are empty."""
    most = min(most or SLICE_TOKENS, SLICE_TOKENS)
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = lists.flatten()
    ends = np.cumsum(lengths)
    start = 0
    while start < len(lengths):
        before = ends[start] - lengths[start]
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        rows = np.repeat(np.arange(stop - start), lengths[start:stop])
        yield rows, stop - start, values.slice(before, ends[stop - 1] - before)
        start = stop


def index_of(terms: list[str]) -> tuple[list[str], list[np.ndarray], list[np.ndarray]]:
    """What a ``TermIndex`` of these terms is made of; the number of a term is its place."""
    split = [term.split(" ") for term in terms]
    tokens = sorted({token for parts in split for token in parts})
    codes = {token: i for i, token in enumerate(tokens)}
    keys, numbers = [np.arange(len(codes))], []
    # Terms as long as the level or longer, with the state of their prefix.
    live = [(codes[parts[0]], number, parts) for number, parts in enumerate(split)]
    while live:
        here = np.full(len(keys[-1]), -1, np.int64)
        for state, number, parts in live:
            if len(parts) == len(keys):
                here[state] = number
        numbers.append(here)
        longer = [(state * len(codes) + codes[parts[len(keys)]], number, parts) for state, number, parts in live if len(parts) > len(keys)]
        level, states = np.unique(np.array([key for key, _, _ in longer], np.int64), return_inverse=True)
        live = [(int(state), number, parts) for state, (_, number, parts) in zip(states, longer)]
        keys.append(level)
    return tokens, keys, numbers


class TermIndex:
    """Numbers of a bounded list of terms, found token by token.

    A term of n tokens is reached through its n - 1 prefixes: the state of a prefix
    and the code of the next token make a key, whose place among the keys of that
    length is the next state.
    """

    def __init__(self, tokens: list[str], keys: list[np.ndarray], numbers: list[np.ndarray]):
        self.codes = {token: i for i, token in enumerate(tokens)}
        self.width = max(len(tokens), 1)
        self.keys, self.numbers = keys, numbers
        self.size = 1 + max((int(x.max(initial=-1)) for x in numbers), default=-1)

    def coded(self, tokens: pa.Array) -> np.ndarray:
        """Code of every token, -1 when no term holds it."""
        if not len(tokens):
            return np.zeros(0, np.int64)
        found = tokens.dictionary_encode()
        known = np.array([self.codes.get(token, -1) for token in found.dictionary.to_pylist()], np.int64)
        return known[found.indices.to_numpy(zero_copy_only=False)]

    def finder(self, codes: np.ndarray, rows: np.ndarray):
        """Function from offsets to the term number that the tokens at these offsets make, for every position."""
        count, states = len(codes), {}

        def at(offset: int) -> np.ndarray:
            moved = np.full(count, -1, np.int64)
            low, high = max(0, -offset), min(count, count - offset)
            if low < high:
                same = rows[low:high] == rows[low + offset : high + offset]
                moved[low:high] = np.where(same, codes[low + offset : high + offset], -1)
            return moved

        def state(offsets: tuple[int, ...]) -> np.ndarray:
            if offsets not in states:
                if len(offsets) == 1:
                    states[offsets] = at(offsets[0])
                else:
                    states[offsets] = self._extended(state(offsets[:-1]), at(offsets[-1]), len(offsets))
            return states[offsets]

        def numbers(offsets: tuple[int, ...]) -> np.ndarray:
            if len(offsets) > len(self.numbers):
                return np.full(count, -1, np.int64)
            reached = state(tuple(offsets))
            named = self.numbers[len(offsets) - 1]
            return np.where(reached >= 0, named[reached], -1) if len(named) else np.full(count, -1, np.int64)

        return numbers

    def _extended(self, prefix: np.ndarray, token: np.ndarray, length: int) -> np.ndarray:
        out = np.full(len(prefix), -1, np.int64)
        keys = self.keys[length - 1]
        able = np.flatnonzero((prefix >= 0) & (token >= 0))
        if len(able) and len(keys):
            wanted = prefix[able] * self.width + token[able]
            place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            hit = keys[place] == wanted
            out[able[hit]] = place[hit]
        return out

    def counted(self, rows: np.ndarray, tokens: pa.Array, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(row, number, tf)`` of the known n-grams of a slice, by row and number."""
        find = self.finder(self.coded(tokens), rows)
        total, keys = max(self.size, 1), []
        for n in range(low, high + 1):
            numbers = find(tuple(range(n)))
            at = np.flatnonzero(numbers >= 0)
            keys.append(rows[at] * total + numbers[at])
        found, tf = np.unique(np.concatenate(keys), return_counts=True)
        return found // total, found % total, tf


def lists_of(sizes: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), values)


def _weighed(index: TermIndex, rows: np.ndarray, count: int, tokens: pa.Array, idf: np.ndarray, low: int, high: int, sublinear: bool) -> tuple:
    """``(row, number, tf, weight)`` of the known n-grams of a slice, and the length of every row's weights, 1 for none."""
    row, number, tf = index.counted(rows, tokens, low, high)
    weight = ((1.0 + np.log(tf)) if sublinear else tf.astype(float)) * idf[number]
    norm = np.sqrt(np.bincount(row, weight * weight, count))
    return row, number, tf, weight, np.where(norm > 0, norm, 1.0)


def _cells(number: np.ndarray, tf: np.ndarray, value: np.ndarray) -> pa.StructArray:
    columns = [pa.array(number.astype(np.int32)), pa.array(tf.astype(np.int32)), pa.array(value.astype(float))]
    return pa.StructArray.from_arrays(columns, ["number", "tf", "tfidf"])


def replaced(batch: pa.RecordBatch, at: int, column: pa.Array, name: str) -> pa.RecordBatch:
    """The rows from ``at`` on that ``column`` is made for, with it instead of the last column."""
    kept = [x.slice(at, len(column)) for x in batch.columns[:-1]]
    fields = [batch.schema.field(k) for k in range(len(kept))]
    return pa.RecordBatch.from_arrays([*kept, column], schema=pa.schema([*fields, pa.field(name, column.type)]))


def with_terms(batches, parts_of_index: tuple, idf: np.ndarray, low: int, high: int, sublinear: bool):
    """Batches whose last column, lists of tokens, gives way to ``terms`` as ``vectors`` has them.

    A slice goes on as soon as it is done, so what a worker holds does not grow with the rows of a batch.
    """
    index = TermIndex(*parts_of_index)
    for batch in batches:
        at = 0
        for rows, count, tokens in slices(batch.column(batch.num_columns - 1)):
            row, number, tf, weight, safe = _weighed(index, rows, count, tokens, idf, low, high, sublinear)
            yield replaced(batch, at, lists_of(np.bincount(row, minlength=count), _cells(number, tf, weight / safe[row])), "terms")
            at += count


def vectors(lists: pa.Array, parts_of_index: tuple, idf: np.ndarray, coefs: np.ndarray, low: int, high: int, sublinear: bool, top: tuple | None = None, cells: bool = True) -> pa.StructArray:
    """Per row ``terms`` as ``(number, tf, tfidf)``, and ``dots``, the products with the columns of ``coefs``.

    The weights have length one; a row without a known term has no terms and zero
    products. ``top`` as ``(intercepts, k, slack)`` keeps the terms that may be among the ``k`` with the
    largest part in the class chosen, within ``slack``, with that part for tf-idf. Without ``cells``
    there are only products. ``chosen`` is the class, null without ``top`` or classes.
    """
    index = TermIndex(*parts_of_index)
    sizes, parts, products, classes = [], [], [], []
    for rows, count, tokens in slices(lists):
        row, number, tf, weight, safe = _weighed(index, rows, count, tokens, idf, low, high, sublinear)
        dots = [np.bincount(row, weight * coefs[number, k], count) / safe for k in range(coefs.shape[1])]
        products.append(np.stack(dots, axis=1) if dots else np.zeros((count, 0)))
        value = weight / safe[row]
        if top is not None:
            intercepts, k, slack = top
            if dots:
                chosen = np.argmax(np.round(products[-1] + intercepts, 12), axis=1)
                classes.append(chosen)
                value = coefs[number, chosen[row]] * value
            order = np.lexsort((-np.abs(value), row))
            starts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=count))])[:-1]
            last = np.minimum(starts + k, np.append(starts[1:], len(row))) - 1
            floor = np.abs(value)[order[np.maximum(last, 0)]] if len(row) else np.zeros(count)
            kept = np.abs(value) >= floor[row] - slack
            row, number, tf, value = row[kept], number[kept], tf[kept], value[kept]
        sizes.append(np.bincount(row, minlength=count) if cells else np.zeros(count, np.int64))
        if cells:
            parts.append((number, tf, value))
    joined = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0) for i in range(3)]
    table = np.concatenate(products) if products else np.zeros((0, coefs.shape[1]))
    dots = lists_of(np.full(len(table), coefs.shape[1]), pa.array(table.ravel()))
    chosen = pa.array(np.concatenate(classes).astype(np.int32)) if classes else pa.nulls(len(table), pa.int32())
    terms = lists_of(np.concatenate(sizes) if sizes else np.zeros(0, np.int64), _cells(*joined))
    return pa.StructArray.from_arrays([terms, dots, chosen], ["terms", "dots", "chosen"])


def _reduced(parts: list[tuple]) -> tuple:
    """Sums, counts and maxima of ``(key, w, n, top)`` parts by key."""
    key, w, n, top = (np.concatenate([p[i] for p in parts]) for i in range(4))
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    if not len(at):
        return key, w, n, top
    return key[at], np.add.reduceat(w[order], at), np.add.reduceat(n[order], at), np.maximum.reduceat(top[order], at)


def group_sums(batches, parts_of_index: tuple, idf: np.ndarray, low: int, high: int, sublinear: bool, most: int = 1 << 20):
    """``(group, number, w, n, top)``: sum, count and maximum of tf-idf per group and term, from columns group and tokens.

    A pair of group and term may have several rows, to be put together.
    """
    index = TermIndex(*parts_of_index)
    width = max(index.size, 1)
    places: dict = {}
    waiting, size, kind = [], 0, pa.null()

    def rows(parts):
        key, w, n, top = parts
        values = pa.array(list(places), kind)
        for at in range(0, len(key), SLICE_TOKENS):
            cut = slice(at, at + SLICE_TOKENS)
            group = values.take(pa.array(key[cut] // width))
            columns = [group, pa.array((key[cut] % width).astype(np.int32)), pa.array(w[cut]), pa.array(n[cut]), pa.array(top[cut])]
            yield pa.RecordBatch.from_arrays(columns, ["group", "number", "w", "n", "top"])

    for batch in batches:
        kind = batch.schema.field(0).type
        coded = batch.column(0).dictionary_encode(null_encoding="encode")
        codes = np.array([places.setdefault(value, len(places)) for value in coded.dictionary.to_pylist()], np.int64)
        groups, start = codes[coded.indices.to_numpy(zero_copy_only=False)], 0
        for row_of, count, tokens in slices(batch.column(1)):
            row, number, tf = index.counted(row_of, tokens, low, high)
            weight = ((1.0 + np.log(tf)) if sublinear else tf.astype(float)) * idf[number]
            value = weight / np.sqrt(np.bincount(row, weight * weight, count))[row]
            waiting.append((groups[start + row] * width + number, value, np.ones(len(row), np.int64), value))
            start, size = start + count, size + len(row)
            if size > most:
                waiting = [_reduced(waiting)]
                # Twice what is kept at least, so that a value is seldom moved.
                size = len(waiting[0][0]) // 2
                if len(waiting[0][0]) > most:
                    yield from rows(waiting[0])
                    waiting, size, places = [], 0, {}
                    codes = np.array([places.setdefault(value, len(places)) for value in coded.dictionary.to_pylist()], np.int64)
                    groups = codes[coded.indices.to_numpy(zero_copy_only=False)]
    if waiting:
        yield from rows(_reduced(waiting))


# Multipliers of the token and the final mix of a hash.
STEP, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _Hashes:
    """64-bit hashes of tokens, the same in every task."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def of(self, tokens: list[str]) -> np.ndarray:
        if len(self.known) > SLICE_TOKENS:
            self.known = {}
        for token in tokens:
            if token not in self.known:
                self.known[token] = int.from_bytes(hashlib.blake2b(token.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return np.array([self.known[token] for token in tokens], np.uint64)


def _hashed(rows: np.ndarray, tokens: pa.Array, low: int, high: int, bits: int, hashes: _Hashes):
    """``(n, places, buckets)`` of the n-grams of a slice, with the tokens' codes and names on the way."""
    found = tokens.dictionary_encode()
    names = found.dictionary.to_pylist()
    codes = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    own = hashes.of(names)[codes]
    grams, running, places = [], own, np.arange(len(codes))
    for n in range(1, high + 1):
        if n > 1:
            inside = places + n - 1 < len(codes)
            places, running = places[inside], running[inside]
            same = rows[places] == rows[places + n - 1]
            places, running = places[same], running[same]
            running = running * STEP + own[places + n - 1]
        if n >= low:
            mixed = (running ^ (running >> np.uint64(32))) * MIX
            grams.append((n, places, (mixed >> np.uint64(64 - bits)).astype(np.int64)))
    return codes, names, grams


def bucket_counts(batches, low: int, high: int, bits: int):
    """``(part, counts)``: n-grams of the lists in the first column, counted by hash; a part is a run of ``PART`` buckets."""
    counts, hashes = np.zeros(1 << bits, np.int64), _Hashes()
    for batch in batches:
        for rows, _, tokens in slices(batch.column(0)):
            if len(tokens):
                for _, _, buckets in _hashed(rows, tokens, low, high, bits, hashes)[2]:
                    counts += np.bincount(buckets, minlength=1 << bits)
    # Fewer buckets than a part holds are one part.
    parts = counts.reshape(-1, min(PART, len(counts)))
    filled = np.flatnonzero(parts.any(axis=1))
    for at in range(0, len(filled), PARTS):
        some = filled[at : at + PARTS]
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([parts[k].tobytes() for k in some], pa.binary())], ["part", "counts"])


def bucket_sums(batches):
    """``(bucket, n)`` of the filled buckets, from the parts of all tasks; every part is in one task."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = np.frombuffer(counts.as_buffer(), np.int64)
            sums[part] = sums[part] + own if part in sums else own
    for part, counts in sums.items():
        filled = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array((part * PART + filled).astype(np.int32)), pa.array(counts[filled])], ["bucket", "n"])


def _counted_rows(counts: dict):
    items = list(counts.items())
    for at in range(0, len(items), SLICE_TOKENS):
        part = items[at : at + SLICE_TOKENS]
        columns = [pa.array([t for t, _ in part], pa.string()), pa.array([c[0] for _, c in part], pa.int64()), pa.array([c[1] for _, c in part], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["term", "df", "cf"])


def term_stats(batches, low: int, high: int, bits: int, live: np.ndarray, most: int = 1 << 19):
    """``(term, df, cf)`` of the n-grams whose bucket is ``live``; a term may have several rows to be summed."""
    hashes, counts = _Hashes(), {}
    for batch in batches:
        for rows, count, tokens in slices(batch.column(0)):
            if not len(tokens):
                continue
            codes, names, grams = _hashed(rows, tokens, low, high, bits, hashes)
            for n, places, buckets in grams:
                at = places[live[buckets]]
                if not len(at):
                    continue
                key = codes[at]
                for k in range(1, n):
                    # Numbered anew, so that a key of any length fits.
                    key = np.unique(key, return_inverse=True)[1] * len(names) + codes[at + k]
                _, first, gram = np.unique(key, return_index=True, return_inverse=True)
                pair, tf = np.unique(gram * count + rows[at], return_counts=True)
                df = np.bincount(pair // count, minlength=len(first))
                cf = np.bincount(pair // count, tf, len(first)).astype(np.int64)
                heads = codes[at[first][:, None] + np.arange(n)].tolist()
                for parts, d, c in zip(heads, df.tolist(), cf.tolist()):
                    term = " ".join([names[p] for p in parts])
                    sums = counts.get(term)
                    if sums is None:
                        counts[term] = [d, c]
                    else:
                        sums[0] += d
                        sums[1] += c
            if len(counts) > most:
                yield from _counted_rows(counts)
                counts = {}
    yield from _counted_rows(counts)


cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Set signatures for a similarity join, and exact links inside a candidate group.

Two sets of sizes ``s <= t`` reach a Jaccard similarity of ``p`` percent when they
share ``need(s, t)`` elements. Small sets are listed under all subsets of that
fixed size. Large sets are cut into blocks by element hash, more blocks than they
may differ in elements, and stand in the inverted list of every block's content:
at least one block that is not empty is then equal in both.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa

from slantwise.llm import kernels

SPARE = 2  # blocks beyond the needed ones, so that equal empty blocks never count
BUFFER = 1 << 20  # signatures held before they are passed on
_SECOND = np.uint64(0x5851F42D4C957F2D)


def need(s, t, percent: int):
    """Common elements that sets of these sizes must have."""
    return -(-percent * (s + t) // (100 + percent))


def largest_partner(s, percent: int):
    return 100 * s // percent


def subset_sizes(n: int, small: int, percent: int) -> list[int]:
    """Sizes of the subsets under which a set of ``n`` is listed."""
    partners = range(-(-percent * n // 100), largest_partner(n, percent) + 1)
    return sorted({need(n, t, percent) for t in partners if min(n, t) <= small and need(n, t, percent) <= min(n, t)})


def subset_rows(n: int, percent: int) -> int:
    return sum(comb(n, size) for size in subset_sizes(n, n, percent))


class Classes:
    """Size classes of the large sets; a set also joins the class below its own."""

    def __init__(self, small: int, largest: int, percent: int):
        self.low = [small + 1]
        while self.low[-1] <= largest:
            self.low.append(largest_partner(self.low[-1], percent) + 1)
        self.blocks = []
        for low, after in zip(self.low, self.low[1:]):
            self.blocks.append(_most(low, after - 1, percent) + 1 + SPARE)
        self.low, self.blocks = np.array(self.low), np.array(self.blocks, np.int64)

    def of(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, n, "right") - 1


def _most(low: int, top: int, percent: int) -> int:
    """Most elements in which a linked pair with its smaller set in the class differs."""
    s = np.arange(max(low, top - 400), top + 1)
    best = 0
    for slack in range(0, 40):
        t = np.maximum(s, largest_partner(s, percent) - slack)
        ok = need(s, t, percent) <= s
        if ok.any():
            best = max(best, int((s + t - 2 * need(s, t, percent))[ok].max()))
    return best


def list_rows(n: int, percent: int) -> float:
    """Entries of a large set, dearer where a block has so few elements that others share it."""
    blocks = max(1.0, 2 * n * (100 - percent) / (100 + percent) * 1.05) + SPARE
    return 2 * blocks * max(1.0, 2.0 ** (6 - n / blocks))


def boundary(histogram: dict[int, int], percent: int, limit: int = 40) -> int:
    """Small size of least cost, between listing subsets and listing blocks.

    Larger sets that may be linked with small ones are listed by subsets too, so the
    histogram reaches up to ``largest_partner(limit)``; sizes no set has never count
    as a gain.
    """
    best, cost, saved = 1, 0.0, 0.0
    for n in range(1, limit + 1):
        saved += histogram.get(n, 0) * (subset_rows(n, percent) - list_rows(n, percent))
        partners = range(n + 1, largest_partner(n, percent) + 1)
        extra = sum(histogram.get(m, 0) * sum(comb(m, size) for size in subset_sizes(m, n, percent)) for m in partners)
        if saved + extra < cost:
            best, cost = n, saved + extra
    return best


def digests(value: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over the mixed elements of each set."""
    out = []
    for salt in (np.uint64(0), _SECOND):
        total = np.zeros(len(value) + 1, np.uint64)
        np.cumsum(kernels.mix(value ^ salt), out=total[1:])
        out.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
    return out[0], out[1]


def head_columns(column: pa.Array, size: int) -> pa.RecordBatch:
    """Number of shingles, digest and sketch of each text's set."""
    parts, drawn = [], []
    for _, _, data, bounds in kernels.pieces(column):
        value, at = kernels.shingle_sets(kernels.Words(data, bounds, "space", lower=True), size)
        parts.append((np.diff(at), *digests(value, at)))
        drawn += sketches(value, at)
    joined = [np.concatenate(x).astype(np.int64) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 3
    return pa.RecordBatch.from_arrays([*map(pa.array, joined), pa.array(drawn, pa.binary())], ["n", "d1", "d2", "sketch"])


def set_columns(column: pa.Array, size: int) -> pa.RecordBatch:
    """Digest and elements (eight bytes each) of each text's set."""
    heads, sets = [], []
    for _, _, data, bounds in kernels.pieces(column):
        value, at = kernels.shingle_sets(kernels.Words(data, bounds, "space", lower=True), size)
        heads.append(digests(value, at))
        sets += [value[a:b].tobytes() for a, b in zip(at, at[1:])]
    d1, d2 = [np.concatenate(x) for x in zip(*heads)] if heads else (np.zeros(0, np.int64),) * 2
    return pa.RecordBatch.from_arrays([pa.array(d1), pa.array(d2), pa.array(sets, pa.binary())], ["d1", "d2", "elements"])


def _subset_entries(value, at, node, small, percent):
    n = np.diff(at)
    for size in np.unique(n[(n > 0) & (n <= largest_partner(small, percent))]).tolist():
        rows = np.flatnonzero(n == size)
        table = kernels.mix(value[at[rows][:, None] + np.arange(size)])
        total = table.sum(axis=1, dtype=np.uint64)
        for kept in subset_sizes(size, small, percent):
            tag = kernels.mix(np.array([kept], np.uint64))
            if kept == size:
                yield kernels.mix(total + tag), node[rows]
                continue
            dropped = np.array(list(combinations(range(size), size - kept)))
            for part in np.array_split(rows, max(1, len(rows) * len(dropped) // BUFFER)):
                chosen = table[np.searchsorted(rows, part)]
                left = total[np.searchsorted(rows, part)][:, None] - chosen[:, dropped].sum(axis=2, dtype=np.uint64)
                yield kernels.mix(left + tag).ravel(), np.repeat(node[part], len(dropped))


def _block_entries(value, at, node, small, percent):
    n = np.diff(at)
    large = np.flatnonzero(n > small)
    if not len(large):
        return
    classes = Classes(small, int(n.max()), percent)
    item = np.repeat(np.arange(len(large)), n[large])
    offset = np.repeat(at[large] - np.concatenate([[0], np.cumsum(n[large])[:-1]]), n[large])
    element = kernels.mix(value[np.arange(len(item)) + offset])
    own = classes.of(n[large])
    for lower in (0, 1):
        use = own >= lower
        group = np.maximum(own - lower, 0)
        blocks = np.where(use, classes.blocks[group], 0)
        base = np.concatenate([[0], np.cumsum(blocks)])
        mine = use[item]
        part = ((element[mine] >> np.uint64(20)) % blocks[item[mine]].astype(np.uint64)).astype(np.int64)
        slot = base[item[mine]] + part
        content = np.zeros(base[-1], np.uint64)
        np.add.at(content, slot, element[mine])
        filled = np.bincount(slot, minlength=base[-1]) > 0
        who = np.repeat(np.arange(len(large)), blocks)
        number = np.arange(base[-1]) - base[who]
        empty = np.bincount(who[~filled], minlength=len(large))
        listed = filled | (empty[who] > SPARE)
        tag = kernels.mix((group[who].astype(np.uint64) << np.uint64(32)) + number.astype(np.uint64) + np.uint64(1 << 63))
        yield kernels.mix(content + tag)[listed], node[large][who][listed]


def _distinct(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries in the order of their lists, each node once per list."""
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    return key[new], node[new]


PACKED = ["bucket", "keys", "nodes", "picks"]


def _pack(key: np.ndarray, node: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row per bucket of list keys: six key bytes and a node number per entry."""
    key, node = _distinct(key, node)
    bucket = (key >> np.uint64(48)).astype(np.int64) % buckets
    order = np.argsort(bucket, kind="stable")
    used = np.unique(bucket)
    cuts = np.searchsorted(bucket[order], np.stack([used, used + 1]))
    rows = []
    for number, first, last in zip(used.tolist(), *cuts):
        mine = order[first:last]
        nodes, pick = np.unique(node[mine], return_inverse=True)
        kind = np.uint16 if len(nodes) < 65536 else np.uint32
        low = np.ascontiguousarray(key[mine]).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
        rows.append((number, low, nodes.tobytes(), pick.astype(kind).tobytes()))
    columns = list(zip(*rows)) if rows else [[]] * 4
    types = [pa.int32(), *[pa.binary()] * 3]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], PACKED)


def entries(batches, at_column: int, size: int, small: int, percent: int, buckets: int):
    """List entries of all texts of a task, equal ones of a buffer once."""
    keys, nodes, held = [], [], 0
    for batch in batches:
        for _, _, data, bounds in kernels.pieces(batch.column(at_column)):
            value, at = kernels.shingle_sets(kernels.Words(data, bounds, "space", lower=True), size)
            node = digests(value, at)[0]
            for source in (_subset_entries, _block_entries):
                for key, owner in source(value, at, node, small, percent):
                    keys.append(key)
                    nodes.append(owner)
                    held += len(key)
            if held >= BUFFER:
                yield _pack(np.concatenate(keys), np.concatenate(nodes), buckets)
                keys, nodes, held = [], [], 0
    if held:
        yield _pack(np.concatenate(keys), np.concatenate(nodes), buckets)


def join_lists(batches):
    """Members of the lists that hold several sets; rows come ordered by bucket.

    A list is named by its members, so lists of the same sets are one.
    """

    def close(rows: list):
        key, node = [], []
        for low, nodes, pick in rows:
            wide = np.zeros((len(low) // 6, 8), np.uint8)
            wide[:, :6] = np.frombuffer(low, np.uint8).reshape(-1, 6)
            nodes = np.frombuffer(nodes, np.int64)
            key.append(wide.view(np.uint64).reshape(-1))
            node.append(nodes[np.frombuffer(pick, np.uint16 if len(nodes) < 65536 else np.uint32)])
        key, node = _distinct(np.concatenate(key), np.concatenate(node))
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        count = np.diff(np.r_[start, len(key)])
        name = np.add.reduceat(kernels.mix(node.view(np.uint64) ^ _SECOND), start)
        start, count, name = (x[count > 1] for x in (start, count, name))
        name, at = np.unique(name, return_index=True)
        start, count = start[at], count[at]
        where = np.repeat(start - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum()) if len(at) else start
        arrays = [np.repeat(name.view(np.int64), count), node[where], np.repeat(count, count)]
        return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in arrays], ["list", "node", "k"])

    bucket, rows = None, []
    for batch in batches:
        for number, *row in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if number != bucket and rows:
                yield close(rows)
                rows = []
            bucket = number
            rows.append(row)
    if rows:
        yield close(rows)


def sketches(value: np.ndarray, at: np.ndarray) -> list[bytes]:
    """Parities of the element counts in as many cells as elements, or up to twice as many.

    Two sets differ in at least as many elements as their sketches differ in bits.
    """
    n = np.diff(at)
    cells = 1 << np.maximum(6, np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))
    base = np.concatenate([[0], np.cumsum(cells)])
    cell = (kernels.mix(value + _SECOND) & np.repeat(cells - 1, n).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(np.repeat(base[:-1], n) + cell, minlength=base[-1]) & 1
    packed = np.packbits(odd.astype(np.uint8), bitorder="little")
    return [packed[a:b].tobytes() for a, b in zip(base[:-1] // 8, base[1:] // 8)]


def _halved(words: np.ndarray) -> np.ndarray:
    """Sketches with half the cells."""
    half = words.shape[-1] // 2
    return words[..., :half] ^ words[..., half:]


def plausible_groups(n: np.ndarray, words: list[np.ndarray], percent: int) -> np.ndarray:
    """Label of each set: the first set of its group of sets that may be linked.

    A pair that sizes and sketches rule out is no link. Sets that have been reached
    are not looked at again.
    """
    label = np.full(len(n), -1)
    width = np.array([len(w) for w in words])
    left = {w: np.flatnonzero(width == w) for w in np.unique(width).tolist()}
    whole = {w: np.stack([words[k] for k in rows]) for w, rows in left.items()}
    for seed in range(len(n)):
        if label[seed] >= 0:
            continue
        label[seed], frontier = seed, [seed]
        while frontier and left:
            one = frontier.pop()
            own = int(width[one])
            for w in (own // 2, own, 2 * own):
                if w not in left:
                    continue
                rows = left[w]
                common = need(n[one], n[rows], percent)
                mine = _halved(words[one]) if w < own else words[one]
                theirs = _halved(whole[w]) if w > own else whole[w]
                apart = np.bitwise_count(theirs ^ mine).sum(axis=1, dtype=np.int64)
                hit = (common <= np.minimum(n[one], n[rows])) & (apart <= n[one] + n[rows] - 2 * common)
                found = rows[hit & (label[rows] < 0)]
                label[found] = seed
                frontier.extend(found.tolist())
                if hit.any():
                    left[w], whole[w] = rows[~hit], whole[w][~hit]
                    if not len(left[w]):
                        del left[w]
    return label


def plausible(batches, percent: int):
    """Stars of the sets of each list that may be linked; rows come ordered by list."""

    def close(rows: list) -> list:
        node, n, data = zip(*rows)
        label = plausible_groups(np.array(n), [np.frombuffer(x, np.uint64) for x in data], percent)
        return [(node[k], node[j]) for k, j in enumerate(label) if k != j]

    task, rows, out = None, [], []
    for batch in batches:
        for name, *row in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if name != task:
                out += close(rows) if len(rows) > 1 else []
                task, rows = name, []
            rows.append(row)
        if len(out) > 20_000:
            yield _links(out, pa.int64())
            out = []
    out += close(rows) if len(rows) > 1 else []
    yield _links(out, pa.int64())


def linked_groups(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Label of each set: the index of the first set of its group of linked sets.

    One set after another scans the inverted lists of its elements and counts what
    it shares with every set not reached yet; those it links with are scanned next.
    Sets that have been reached leave the lists, so a group of near copies costs
    little more than one scan.
    """
    total, sizes = len(sets), np.array([len(x) for x in sets])
    label = np.full(total, -1)
    element = np.unique(np.concatenate(sets), return_inverse=True)[1] if total else np.zeros(0, int)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    owner = np.repeat(np.arange(total), sizes)

    def lists(open_sets: np.ndarray):
        use = open_sets[owner]
        order = np.argsort(element[use], kind="stable")
        return owner[use][order], np.concatenate([[0], np.cumsum(np.bincount(element[use], minlength=element.max() + 1 if len(element) else 0))])

    posting, at = lists(np.ones(total, bool))
    common = np.add.reduceat(np.diff(at)[element], bounds[:-1]) if total and len(element) else sizes
    held = total
    for seed in np.argsort(-common, kind="stable"):
        if label[seed] >= 0:
            continue
        label[seed], frontier = seed, [seed]
        while frontier:
            one = frontier.pop()
            mine = element[bounds[one] : bounds[one + 1]]
            count = at[mine + 1] - at[mine]
            where = np.repeat(at[mine] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
            shared = np.bincount(posting[where], minlength=total)
            hit = np.flatnonzero((label < 0) & (100 * shared >= percent * (sizes[one] + sizes - shared)))
            label[hit] = seed
            frontier.extend(hit.tolist())
            rest = int((label < 0).sum())
            if rest < held // 2 and held > 64:
                held = rest
                posting, at = lists(label < 0)
    return label


def verify(batches, percent: int):
    """Links between the classes of each candidate group; rows come ordered by group."""

    def close(rows: dict):
        names = sorted(rows)
        label = linked_groups([np.frombuffer(rows[x], np.uint64) for x in names], percent)
        return [(names[k], names[j]) for k, j in enumerate(label) if k != j]

    group, rows, out = None, {}, []
    for batch in batches:
        for g, name, data in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if g != group:
                out += close(rows) if len(rows) > 1 else []
                group, rows = g, {}
            rows[name] = data
        if len(out) > 20_000:
            yield _links(out)
            out = []
    out += close(rows) if len(rows) > 1 else []
    yield _links(out)


def _links(rows: list[tuple], kind: pa.DataType = pa.string()) -> pa.RecordBatch:
    a, b = zip(*rows) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind)], ["a", "b"])

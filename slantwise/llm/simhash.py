"""Array code for 64-bit fingerprints: made from texts, listed by their bytes, compared."""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash

from slantwise.llm import kernels

SHINGLES_AT_ONCE = 1 << 14
BYTES = 8
_SEVEN = np.uint64(0x7F7F7F7F7F7F7F7F)

# Lists up to this size are compared by shifts, several lists at a time.
SHORT_LIST = 16

# Cost of an index entry against one comparison of two fingerprints.
ENTRY_COST = 100


def fingerprint(text: bytes, size: int, seed: int) -> int:
    """Bits set in over half the hashes of a text's shingles; 0 without words."""
    words = text.lower().split()  # both know ASCII only
    if not words:
        return 0
    line = b" ".join(words)
    starts = np.zeros(len(words), np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    np.cumsum(lengths[:-1] + 1, out=starts[1:])
    ends = (starts + lengths)[min(size, len(words)) - 1 :]
    total = len(ends)
    counts = np.zeros(64, np.int64)
    for low in range(0, total, SHINGLES_AT_ONCE):
        high = min(total, low + SHINGLES_AT_ONCE)
        spans = zip(starts[low:high].tolist(), ends[low:high].tolist())
        values = np.fromiter((xxhash.xxh64_intdigest(line[a:b], seed) for a, b in spans), np.uint64, high - low)
        counts += np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprint_column(column: pa.Array, size: int, seed: int) -> pa.RecordBatch:
    """Signed fingerprints of a text column; a copy within the batch is read once."""
    raw, bounds = kernels.text_buffers(column)
    known: dict[bytes, int] = {}
    out = np.zeros(len(bounds) - 1, np.uint64)
    for row, (low, high) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        text = raw[low:high].tobytes()
        key = xxhash.xxh128_digest(text) if len(text) > 64 else text
        if key not in known:
            known[key] = fingerprint(text, size, seed)
        out[row] = known[key]
    return pa.RecordBatch.from_arrays([pa.array(out.view(np.int64))], ["fp"])


def byte_sets(max_bits: int, depth: int) -> list[int]:
    """Masks of the byte positions that key the lists.

    Fingerprints that differ in ``max_bits`` bits share ``8 - max_bits`` bytes at
    least, so ``depth`` of the first ``max_bits + depth``.
    """
    return [sum(0xFF << (8 * p) for p in chosen) for chosen in combinations(range(max_bits + depth), depth)]


def list_depth(prints: int, max_bits: int) -> int:
    """Bytes in a list's key at the least cost of entries and comparisons."""

    def cost(depth: int) -> float:
        lists = comb(max_bits + depth, depth)
        return lists * prints * (ENTRY_COST + prints / 256**depth / 2)

    return min(range(1, BYTES - max_bits + 1), key=cost)


def shared_bytes(x: np.ndarray) -> np.ndarray:
    """Byte positions that agree, from the exclusive or of two fingerprints."""
    return np.bitwise_count(~(((x & _SEVEN) + _SEVEN) | x | _SEVEN))


def close(x: np.ndarray, max_bits: int) -> np.ndarray:
    """Whether pairs link, from their exclusive or: the byte tally first, then the bits."""
    out = shared_bytes(x) >= BYTES - max_bits
    at = np.flatnonzero(out)
    out[at] = np.bitwise_count(x[at]) <= max_bits
    return out


def stars(prints: np.ndarray, max_bits: int):
    """Links that join what is connected within one list: ``(root, members)``.

    Every fingerprint is compared with those not reached yet, so a list of near
    copies shrinks at once.
    """
    rest = prints
    while len(rest):
        root, frontier, rest = rest[0], [rest[0]], rest[1:]
        while frontier and len(rest):
            near = close(rest ^ frontier.pop(), max_bits)
            if near.any():
                found = rest[near]
                rest = rest[~near]
                frontier.extend(found)
                yield root, found


def _short_links(names: np.ndarray, prints: np.ndarray, max_bits: int):
    for shift in range(1, len(names)):
        same = np.flatnonzero(names[shift:] == names[:-shift])
        if not len(same):
            return
        kept = same[close(prints[same] ^ prints[same + shift], max_bits)]
        yield prints[kept], prints[kept + shift]


def _pairs(found) -> pa.RecordBatch:
    a, b = (np.concatenate([x[k] for x in found]) if found else np.zeros(0, np.uint64) for k in (0, 1))
    both = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1) if len(a) else np.zeros((2, 0), np.uint64)
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.uint64).view(np.int64), pa.int64()) for x in both], ["a", "b"])


def _members(prints: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(prints.view(np.int64)), pa.nulls(len(prints), pa.int64())], ["a", "b"])


def _lists_linked(names: np.ndarray, prints: np.ndarray, max_bits: int) -> pa.RecordBatch:
    edges = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1], [True]]))
    sizes = np.diff(edges)
    short = np.repeat(sizes <= SHORT_LIST, sizes)
    found = list(_short_links(names[short], prints[short], max_bits))
    for k in np.flatnonzero(sizes > SHORT_LIST):
        for root, members in stars(prints[edges[k] : edges[k + 1]], max_bits):
            found.append((np.full(len(members), root), members))
    return _pairs(found)


def linked(batches, max_bits: int, hot_list: int):
    """Links within lists, from rows ``(list, fp)`` sorted by list.

    Of a list with more than ``hot_list`` rows only the members are told, with a
    null partner. So no more than that, and a batch, is held at a time.
    """
    names, prints, hot = np.zeros(0, np.int64), np.zeros(0, np.uint64), None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = np.concatenate([names, batch.column(0).to_numpy()])
        prints = np.concatenate([prints, batch.column(1).to_numpy().view(np.uint64)])
        begin = int(np.searchsorted(names == names[-1], True))  # where the last list, perhaps unfinished, begins
        ready = _split_hot(names[:begin], prints[:begin], hot, hot_list)
        yield from _answers(ready, max_bits)
        hot = hot if hot == names[-1] else None
        names, prints = names[begin:], prints[begin:]
        if hot is not None or len(names) > hot_list:
            hot = names[-1]
            yield _members(prints)
            names, prints = names[:0], prints[:0]
    yield from _answers(_split_hot(names, prints, hot, hot_list), max_bits)


def _split_hot(names: np.ndarray, prints: np.ndarray, hot, hot_list: int):
    """Rows of lists to compare, and members of those that are too long."""
    if not len(names):
        return names, prints, prints
    _, first, sizes = np.unique(names, return_index=True, return_counts=True)
    order = np.argsort(first)
    long = np.repeat(sizes[order] > hot_list, sizes[order])
    if hot is not None:
        long |= names == hot
    return names[~long], prints[~long], prints[long]


def _answers(ready, max_bits: int):
    names, prints, long = ready
    if len(names):
        yield _lists_linked(names, prints, max_bits)
    if len(long):
        yield _members(long)


def ball(max_bits: int) -> np.ndarray:
    """Masks of all changes of up to half of ``max_bits`` bits."""
    bits = [1 << k for k in range(64)]
    return np.array([sum(c) for r in range(max_bits // 2 + 1) for c in combinations(bits, r)], np.uint64)


def points(batches, max_bits: int):
    """``(point, fp)`` for all points that half of ``max_bits`` changes reach."""
    masks = ball(max_bits)
    for batch in batches:
        prints = batch.column(0).to_numpy().view(np.uint64)
        for low in range(0, len(prints), 512):
            some = prints[low : low + 512]
            grid = (some[:, None] ^ masks[None, :]).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(grid.view(np.int64)), pa.array(np.repeat(some, len(masks)).view(np.int64))], ["point", "fp"])


def neighbours(batches):
    """Links of rows that follow each other in one point, from rows sorted by point."""
    point, last = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        at, prints = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
        same = np.flatnonzero(at[1:] == at[:-1])
        found = [(prints[same], prints[same + 1])]
        if point == at[0]:
            found.append((last, prints[:1]))
        point, last = at[-1], prints[-1:]
        yield _pairs(found)

"""Array code on whole Arrow text columns: words, lines and their hashes.

A batch is cut into pieces of whole texts, so the arrays stay near
``PIECE_BYTES`` times a constant, or near the longest single text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 18
FOLD = 1 << 16  # pieces of texts that are folded together

# Separator sets of the word definitions.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_NOT_WORD = np.zeros(256, bool)
_NOT_WORD[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
SEPARATORS = {"space": _SPACE, "alphanumeric": _NOT_WORD}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_BYTE_CODES = np.random.default_rng(20240607).integers(1, 2**64, 256, dtype=np.uint64)
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE**i`` and ``BASE**-i`` modulo 2**64 for ``i`` up to ``n``."""
    if len(_POWERS.get("up", ())) <= n:
        size = max(n + 1, PIECE_BYTES + 2)
        inverse = np.uint64(pow(int(_BASE), -1, 2**64))
        for name, base in (("up", _BASE), ("down", inverse)):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            _POWERS[name] = np.multiply.accumulate(row)
    return _POWERS["up"], _POWERS["down"]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running sums from which ``range_hash`` takes the hash of any byte range."""
    up, _ = _powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * up[: len(data)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal for equal bytes, wherever they stand."""
    _, down = _powers(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null reads as empty."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, bounds


def pieces(column: pa.Array, limit: int = PIECE_BYTES):
    """``(first row, last row, bytes, bounds)`` of runs of whole texts."""
    raw, bounds = text_buffers(column)
    first, rows = 0, len(bounds) - 1
    while first < rows:
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(rows, max(first + 1, last))
        low, high = bounds[first], bounds[last]
        yield first, last, raw[low:high], bounds[first : last + 1] - low
        first = last


def distinct_rows(batches):
    """Batches without rows that repeat an earlier row's first column in the batch.

    Hot texts are worked on rarely that way. It runs in front of a kernel, in the
    same worker: a step of its own would keep a second worker per task.
    """
    for batch in batches:
        seen: dict = {}
        for at, key in enumerate(batch.column(0).to_pylist()):
            seen.setdefault(key, at)
        yield batch.take(pa.array(list(seen.values()), pa.int64()))


def split_runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``inside`` within the texts: starts, ends, run bounds per text."""
    n = len(inside)
    edges = bounds[:-1][bounds[:-1] < n]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    begin[edges] = inside[edges]
    final = inside.copy()
    final[:-1] &= ~inside[1:]
    tails = bounds[1:][bounds[1:] > 0] - 1
    final[tails] = inside[tails]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(final) + 1
    return starts, ends, np.searchsorted(starts, bounds)


class Words:
    """Words of one piece and their hashes."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, separators: str = "space", lower: bool = False):
        self.data = LOWER[data] if lower else data
        self.starts, self.ends, self.bounds = split_runs(~SEPARATORS[separators][self.data], bounds)
        self.counts = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)
        self.prefix = prefix_hash(self.data)
        self.hash = range_hash(self.prefix, self.starts, self.ends)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all runs of ``size`` words within one text."""
        m = len(self.hash) - size + 1
        if m <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        first = np.flatnonzero(self.doc[:m] == self.doc[size - 1 :])
        value = np.zeros(len(first), np.uint64)
        for k in range(size):
            value = value * _STEP + self.hash[first + k]
        return first, mix(value)


def covered(first: np.ndarray, size, total: int) -> np.ndarray:
    """Mask of the positions inside any of the runs ``[first, first + size)``."""
    change = np.zeros(total + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + size, -1)
    return np.cumsum(change[:-1]) > 0


def repeated(doc: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Mask of the entries whose value occurs more than once in their text."""
    key = mix(value + mix(doc.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    out = np.zeros(len(key), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def piece_batch(key, content, node, pos, size) -> pa.RecordBatch:
    """Pieces of a task, folded: of equal contents only the first stays in its list.

    ``state`` is 1 for a piece met again in the task and 2 for the others of its
    content, which are known to repeat and get a key of their own.
    """
    order = np.lexsort((pos, node, content, key))
    key, content, node, pos, size = (x[order] for x in (key, content, node, pos, size))
    follows = np.zeros(len(key), bool)
    follows[1:] = (key[1:] == key[:-1]) & (content[1:] == content[:-1])
    again = np.zeros(len(key), bool)
    again[:-1] = follows[1:]
    state = np.where(follows, 2, again.astype(np.int32)).astype(np.int32)
    key = np.where(follows, mix(mix(node.view(np.uint64)) + pos.astype(np.uint64)), key)
    arrays = [key.view(np.int64), content.view(np.int64), node, pos.astype(np.int64), size.astype(np.int64), state]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["key", "content", "node", "pos", "size", "state"])


def per_text(bounds: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each text."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and their bounds per text.

    A text of fewer words has its whole sequence as one shingle; a text without
    words has none.
    """
    first, value = words.windows(size)
    doc = words.doc[first]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            has = words.counts[short] > k
            at = np.minimum(words.bounds[short] + k, len(words.hash) - 1)
            whole = np.where(has, whole * _STEP + words.hash[at] + np.uint64(1), whole)
        doc, value = np.concatenate([doc, short]), np.concatenate([value, mix(whole ^ np.uint64(0xA5A5A5A5))])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    keep = np.ones(len(value), bool)
    keep[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    doc, value = doc[keep], value[keep]
    return value, np.searchsorted(doc, np.arange(len(words.counts) + 1))


def quality_counts(column: pa.Array, window: int = 8) -> pa.RecordBatch:
    """Word, symbol, repeated-line and repeated-window counts of each text."""
    symbols = np.zeros(256, bool)
    symbols[list(b"#*$%&|<>")] = True
    parts = []
    for _, _, data, bounds in pieces(column):
        words = Words(data, bounds)
        head = (data & 0xC0) != 0x80
        chars = per_text(bounds, head & ~_SPACE[data])
        marks = per_text(bounds, symbols[data])
        starts, ends, line_bounds = split_runs(data != 0x0A, bounds)
        holds = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
        line_doc = np.repeat(np.arange(len(bounds) - 1), np.diff(line_bounds))[holds]
        key = mix(range_hash(words.prefix, starts[holds], ends[holds]) + mix(line_doc.astype(np.uint64) + np.uint64(1)))
        _, at = np.unique(key, return_index=True)
        lines = np.bincount(line_doc, minlength=len(bounds) - 1)
        distinct = np.bincount(line_doc[at], minlength=len(bounds) - 1)
        first, value = words.windows(window)
        hit = first[repeated(words.doc[first], value)]
        again = per_text(words.bounds, covered(hit, window, len(words.hash)))
        parts.append((words.counts, chars, marks, lines - distinct, again))
    joined = [np.concatenate(x).astype(np.int64) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 5
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in joined], names)

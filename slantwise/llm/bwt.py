"""Collection Burrows-Wheeler transform built column by column, and window anchors.

The strings of a collection grow from the right by one symbol per round. Round
``j`` inserts every suffix of length ``j`` into the sorted order at once: the
transform of the round before tells each new suffix its place. Whether two
neighbours share a common prefix of the wanted length is kept up to date on the
way. The state between rounds is a few columns of the order, each read and written
in one sequential sweep.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

from slantwise.llm import kernels

BLOCK = 1 << 22
_PLACE = np.uint64((1 << 24) - 1)


def repeated_suffixes(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string, a mask over its bytes: the ``length`` bytes from here start
    at another place of the collection too.

    A symbol is a word of up to eight bytes that divides ``length``; a string enters
    once for each alignment of its words, so every byte starts one suffix. A row of
    the order is a suffix; the transform holds the symbol in front of it. The rank
    of a symbol above a row, which is the place of the suffix one symbol longer, is
    read from the sorted pairs (symbol, row) of the occurrences inserted before.
    """
    word = next(w for w in (8, 4, 2, 1) if length % w == 0)
    need = length // word
    sizes = np.array([len(s) for s in strings], np.int64)
    gap = bytes(word)
    text = np.frombuffer(gap.join(strings) + gap, np.uint8)
    first = np.concatenate([[0], np.cumsum(sizes + word)[:-1]]).astype(np.int64)
    mask = np.zeros(len(text) + 1, bool)
    value = np.zeros(len(text) - word + 1, np.uint64)
    for k in range(word):
        value |= text[k : len(value) + k].astype(np.uint64) << np.uint64(8 * k)
    code = np.unique(value, return_inverse=True)[1].astype(np.int64)
    shift = np.arange(word)
    count = ((sizes[:, None] - shift) // word).ravel()
    start = (first[:, None] + shift).ravel()
    start, count = start[count >= need], count[count >= need]
    end, total = start + count * word, len(start)
    prefix = kernels.prefix_hash(text)
    enough = np.zeros(len(text) + 1, bool)
    for a, z in zip(first, sizes):
        enough[a : max(a, a + z - length + 1)] = True

    place = end.copy()  # what each row stands for; the first rows are empty suffixes
    head = np.full(total, -1, np.int64)  # first symbol of the row
    rest = np.arange(total)  # row of the suffix without it
    same = np.zeros(total, bool)  # the common prefix with the row above is long enough
    row = np.arange(total)  # of the suffix inserted last, by sequence
    for j in range(1, int(count.max(initial=0)) + 1):
        growing = np.flatnonzero(count >= j)
        at = end[growing] - j * word
        pair = (code[at] << 32) | row[growing]
        order = np.argsort(pair)
        growing, at, pair = growing[order], at[order], pair[order]
        above = total + np.searchsorted((head[total:] << 32) | rest[total:], pair)
        new = above + np.arange(len(above))
        size = len(head) + len(new)
        old = np.ones(size, bool)
        old[new] = False
        moved = np.flatnonzero(old)
        inserted = (at, code[at], moved[row[growing]], False)
        grown = []
        for values, fresh in zip((place, head, moved[rest], same), inserted):
            out = np.empty(size, values.dtype)
            out[moved] = values
            out[new] = fresh
            grown.append(out)
        place, head, rest, same = grown
        row = moved[row]
        row[growing] = new
        look = np.concatenate([new, new[new + 1 < size] + 1])
        same[look] = False
        if j >= need:
            look = look[enough[place[look]] & enough[place[look - 1]]]
            up, here = place[look - 1], place[look]
            same[look] = kernels.range_hash(prefix, up, up + length) == kernels.range_hash(prefix, here, here + length)
    hit = np.flatnonzero(same)
    mask[place[hit]] = True
    mask[place[hit - 1]] = True
    return [mask[a : a + z] for a, z in zip(first, sizes)]


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, from running minima of fixed blocks."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchored_runs(data: np.ndarray, bounds: np.ndarray, length: int, gram: int):
    """Runs of neighbouring windows of ``length`` bytes that have one anchor.

    The anchor of a window is the gram with the least hash in it, the first of
    equals. It depends on the window alone, so equal windows stand at equal places
    of runs with equal anchors. Yields text number, first window, number of
    windows, anchor key and the hash of the bytes the run covers.
    """
    prefix = kernels.prefix_hash(data)
    last = bounds[1:] - length  # last window start of each text
    for low in range(0, max(1, len(data) - length + 1), BLOCK):
        high = min(len(data), low + BLOCK + length - 1)
        if high - low < length:
            return
        starts = np.arange(low, high - gram + 1)
        hashes = kernels.range_hash(prefix, starts, starts + gram)
        packed = (hashes & ~_PLACE) | (starts - low).astype(np.uint64)
        anchor = (_sliding_least(packed, length - gram + 1) & _PLACE).astype(np.int64)
        window = np.arange(low, low + len(anchor))
        text = np.searchsorted(bounds, window, "right") - 1
        valid = window <= last[text]
        head = valid.copy()
        head[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        begin = np.flatnonzero(head)
        if not len(begin):
            continue
        total = np.concatenate([[0], np.cumsum(valid)])
        count = total[np.concatenate([begin[1:], [len(valid)]])] - total[begin]
        begin_at = window[begin]
        content = kernels.range_hash(prefix, begin_at, begin_at + count + length - 1)
        content = kernels.mix(content + (anchor[begin] + low - begin_at).astype(np.uint64))
        yield text[begin], begin_at - bounds[text[begin]], count, hashes[anchor[begin]], content


def run_rows(batches, length: int, gram: int):
    """``(key, content, node, pos, size, state)`` of every run of each text (node, text)."""
    for batch in batches:
        nodes = batch.column(0).to_numpy()
        parts, held = [], 0
        for first, _, data, bounds in kernels.pieces(batch.column(1)):
            for text, pos, count, key, content in anchored_runs(data, bounds, length, gram):
                parts.append((key, content, nodes[first + text], pos, count))
                held += len(key)
            if held > kernels.FOLD:
                yield kernels.piece_batch(*(np.concatenate(x) for x in zip(*parts)))
                parts, held = [], 0
        if parts:
            yield kernels.piece_batch(*(np.concatenate(x) for x in zip(*parts)))


def cut_strings(batches, length: int):
    """Bytes of the chosen runs: rows of text, keys, contents, positions, sizes."""
    for batch in batches:
        for first, last, data, bounds in kernels.pieces(batch.column(0)):
            rows = []
            for text, runs in enumerate(batch.column(1).slice(first, last - first).to_pylist()):
                for run in runs:
                    a = int(bounds[text]) + run["pos"]
                    rows.append((run["bucket"], run["key"], run["content"], data[a : a + run["size"] - 1 + length].tobytes()))
            yield _strings(rows)


def _strings(rows) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 4
    types = [pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["bucket", "key", "content", "string"])


def window_marks(batches, length: int):
    """One row per window of the chosen runs: two hashes, key, content and offset."""
    for batch in cut_strings(batches, length):
        for key, content, string in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
            data = np.frombuffer(string, np.uint8)
            start = np.arange(len(data) - length + 1)
            one = kernels.range_hash(kernels.prefix_hash(data), start, start + length)
            two = kernels.range_hash(kernels.prefix_hash(data ^ 0x5B), start, start + length)
            n = len(start)
            arrays = [one.view(np.int64), two.view(np.int64), np.full(n, key), np.full(n, content), start]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["h1", "h2", "key", "content", "offset"])


def repeated_runs(batches, length: int):
    """``(key, content, skip, size)``: windows of each run that the transform of its
    bucket finds elsewhere too; rows come ordered by bucket."""

    def close(rows: dict) -> pa.RecordBatch:
        names = list(rows)
        found = []
        for (key, content), mask in zip(names, repeated_suffixes([rows[x] for x in names], length)):
            edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
            found += [(key, content, int(a), int(b - a)) for a, b in zip(edge[::2], edge[1::2])]
        columns = list(zip(*found)) if found else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["key", "content", "skip", "size"])

    bucket, rows = None, {}
    for batch in batches:
        for number, key, content, string in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if number != bucket and rows:
                yield close(rows)
                rows = {}
            bucket = number
            rows[key, content] = string
    if rows:
        yield close(rows)


def cut_out(batches, length: int):
    """Node, removed bytes, spans and digest of what stays of each text."""
    for batch in batches:
        removed, spans, digest = [], [], []
        for first, last, data, bounds in kernels.pieces(batch.column(1)):
            for text, runs in enumerate(batch.column(2).slice(first, last - first).to_pylist()):
                own = data[bounds[text] : bounds[text + 1]]
                if runs:
                    start = np.array([r["start"] for r in runs])
                    drop = kernels.covered(start, np.array([r["size"] for r in runs]) + length - 1, len(own))
                else:
                    drop = np.ones(len(own), bool)
                removed.append(int(drop.sum()))
                spans.append(int(np.count_nonzero(drop[1:] & ~drop[:-1])) + int(len(drop) > 0 and drop[0]))
                digest.append(hashlib.sha256(own[~drop].tobytes()).hexdigest())
        arrays = [batch.column(0), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, ["node", "n_removed", "n_spans", "kept_sha256"])

"""Token counts of whole texts with a public tokenizer file."""

from __future__ import annotations

import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from slantwise.llm import kernels
from slantwise.llm.arrow import append_columns
from slantwise.llm.columns import apart

FIELDS = [("n_bytes", T.LongType()), ("n_tokens", T.LongType()), ("over_limit", T.BooleanType())]

#: White space that the byte-level pattern and Python agree on.
SURE_SPACE = " \t\n\r"
# From one stable boundary to the next.
UNIT = re.compile(r"\s*+(?:\S++(?:[^\S \t\n\r]\s*+)?)++|\s++")
MEMO_UNITS = 200_000
MEMO_CHARS = 48


def stable_boundaries(text: str) -> np.ndarray:
    """Positions where a visible character is followed by plain white space.

    The byte-level pattern never joins the two: no piece holds white space after a
    visible character, and what follows a position does not depend on what stood
    before the visible character. Special strings hold no white space, so the
    position never lies inside one. Encoding the two sides apart therefore gives
    the tokens of the whole.
    """
    return np.array([m.start() for m in re.finditer(r"(?<=\S)[ \t\n\r]", text)], np.int64)


def splice_count(text: str, token_starts, chunk: int, overlap: int) -> int:
    """Tokens of a huge text from overlapping chunks.

    ``token_starts(part)`` gives the character where each token of ``part`` begins.
    Two neighbouring chunks are joined at the first stable boundary of their overlap
    at which both begin a token. Where there is none the left chunk and the overlap
    grow, in the worst case up to the whole text.
    """
    edges = stable_boundaries(text)
    total, good, begin, size, lap = 0, 0, 0, chunk, overlap
    while True:
        end = min(len(text), begin + size)
        left = token_starts(text[begin:end]) + begin
        if end == len(text):
            return total + int((left >= good).sum())
        right_begin = max(begin, end - lap)
        right = token_starts(text[right_begin : min(len(text), right_begin + chunk)]) + right_begin
        inside = edges[(edges > max(right_begin, good)) & (edges < min(end, right_begin + chunk))]
        common = inside[np.isin(inside, left) & np.isin(inside, right)]
        if not len(common):
            size, lap = size + lap, 2 * lap
            continue
        cut = int(common[0])
        total += int(((left >= good) & (left < cut)).sum())
        good, begin, size, lap = cut, right_begin, chunk, overlap


class Counter:
    """Counts tokens with the library that the file's ending calls for."""

    def __init__(self, path: str, chunk: int, overlap: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.chunk, self.overlap, self.memo = chunk, overlap, {}
        self.splits = False
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.lengths = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            return
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.lengths = lambda texts: [len(x) for x in self.model.encode_batch_fast(texts, add_special_tokens=False)]
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        first = spec.get("pre_tokenizer") or {}
        plain = first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first.get("add_prefix_space")
        special = [x for x in spec.get("added_tokens", ()) if re.search(r"\s", x["content"]) or x["lstrip"] or x["rstrip"] or x["single_word"]]
        self.splits = plain and not spec.get("normalizer") and not special

    def token_starts(self, part: str) -> np.ndarray:
        return np.array([a for a, _ in self.model.encode(part, add_special_tokens=False).offsets], np.int64)

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text. Where boundaries are proven, units between them are
        encoded once and remembered; other tokenizers get every text whole."""
        if not self.splits:
            return self.lengths(texts)
        out = [0] * len(texts)
        normal = [k for k, t in enumerate(texts) if len(t) <= self.chunk]
        for k in set(range(len(texts))) - set(normal):
            out[k] = splice_count(texts[k], self.token_starts, self.chunk, self.overlap)
        units = [UNIT.findall(texts[k]) for k in normal]
        if len(self.memo) > MEMO_UNITS:
            self.memo = {}
        new = [u for u in set(chain.from_iterable(units)) if u not in self.memo]
        found = dict(zip(new, self.lengths(new))) if new else {}
        self.memo.update((u, n) for u, n in found.items() if len(u) <= MEMO_CHARS)
        for k, own in zip(normal, units):
            out[k] = sum(found[u] if u in found else self.memo[u] for u in own)
        return out


@apart(("n_bytes", "n_tokens", "over_limit"), ("text_col",))
def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    text_col: str = "text",
    limit: int = 512,
    chunk: int = 1 << 15,
    overlap: int = 512,
) -> DataFrame:
    """Documents with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit``).

    ``tokenizer`` is the path of a ``.json`` or ``.model`` file that every worker can
    open. No begin or end tokens are added; special strings inside a text are
    handled as the library does by default. Texts of more than ``chunk`` characters
    are encoded in chunks that overlap by ``overlap``. Null text counts as empty:
    no bytes, no tokens. Rows are independent, so repeats and empty tables need no
    care. Columns named like a result are replaced.
    """

    def kernel(column: pa.Array, made: list = []) -> pa.RecordBatch:
        if not made:
            made.append(Counter(tokenizer, chunk, overlap))
        bounds = kernels.text_buffers(column)[1]
        tokens = []
        for first, last, _, _ in kernels.pieces(column):
            texts = [x or "" for x in column.slice(first, last - first).to_pylist()]
            tokens += made[0].count(texts)
        size, counts = np.diff(bounds), np.array(tokens, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(size), pa.array(counts), pa.array(counts > limit)], [n for n, _ in FIELDS])

    return append_columns(docs, text_col, kernel, FIELDS)

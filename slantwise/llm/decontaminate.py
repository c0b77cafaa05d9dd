"""Benchmark passages in training documents, found through suffix arrays."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slantwise.llm.arrow import append_columns
from slantwise.llm.columns import apart
from slantwise.llm.suffixes import TestItems, leak_columns

FIELDS = [
    ("n_words", T.LongType()),
    ("n_hit", T.LongType()),
    ("n_items", T.LongType()),
    ("items_sha256", T.StringType()),
    ("contaminated", T.BooleanType()),
    ("longest_match", T.LongType()),
    ("matches", T.ArrayType(T.StringType())),
]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[tuple[list[str], list[str]]]:
    """Ids and texts of the test items in blocks of bounded bytes, one at a time."""
    ids, texts, size = [], [], 0
    rows = benchmark.where(F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t"))
    for row in rows.toLocalIterator():
        if size and size + len(row.t.encode()) > block_bytes:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append("" if row.i is None else row.i)
        texts.append(row.t)
        size += len(row.t.encode())
    if ids:
        yield ids, texts


def _loaded(passes: list[Broadcast]) -> Iterator[TestItems]:
    """The test suffixes of one pass after another; a pass leaves memory with the next."""
    for block in passes:
        yield block.value
        if block.__dict__.get("_path"):
            block.__dict__.pop("_value", None)


@apart(tuple(name for name, _ in FIELDS), ("text_col",))
def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    block_bytes: int = 4 << 20,
    pass_bytes: int | None = None,
    places: bool = True,
) -> DataFrame:
    """Documents with the benchmark items they hold verbatim.

    Every shard of documents is turned into a suffix array of word codes; all
    suffixes of the test set that start a window are binary-searched in it. New
    columns: ``n_words``, ``n_hit`` (words inside an occurrence), ``n_items``,
    ``items_sha256``, ``contaminated`` and, with ``places``, ``longest_match`` (words)
    and ``matches`` (``first word:words:item:item word``: where a longest match begins,
    with one item that has it). Work and memory follow the words of a shard and
    the classes of equal test windows, however often a text repeats itself.

    The test set travels to the tasks as suffix tables of ``block_bytes`` of text
    (or one longer item). The driver and each task hold one table at a time: every
    batch of documents is scanned once per table, so a test set of any size gives a
    whole result. A caller who wants a bound sets ``pass_bytes``; a larger test set
    is then an error. Null text has no words; a null item text is no item, a null
    item id reads as an empty one; items that share an id count once. Empty tables
    give empty or clean results. Columns named like a result are replaced.
    """
    if pass_bytes is not None:
        size = benchmark.agg(F.sum(F.octet_length(F.col(item_text_col)))).first()[0] or 0
        if size > pass_bytes:
            raise ValueError(f"the test set holds {size} bytes, more than the {pass_bytes} asked for")
    context = docs.sparkSession.sparkContext
    passes = []
    for ids, texts in _blocks(benchmark, item_id_col, item_text_col, block_bytes):
        passes.append(context.broadcast(TestItems(ids, pa.array(texts, pa.string()), window)))
        if passes[-1].__dict__.get("_path"):
            passes[-1].__dict__.pop("_value", None)

    def kernel(column: pa.Array) -> pa.RecordBatch:
        return leak_columns([passes[0].value] if len(passes) == 1 else _loaded(passes), column, places)

    return append_columns(docs, text_col, kernel, FIELDS if places else FIELDS[:5])


@apart((), ("text_col",))
def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window."""
    clean = find_leaks(docs, benchmark, text_col, places=False, **options).where(~F.col("contaminated"))
    return clean.select(*docs.columns)

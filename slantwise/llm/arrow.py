"""Run an array kernel over a DataFrame without losing or renaming its columns."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def append_columns(df: DataFrame, text_col: str, kernel: Callable[[pa.Array], pa.RecordBatch], fields: list[tuple[str, T.DataType]]) -> DataFrame:
    """``df`` with the columns that ``kernel`` computes from ``text_col``.

    A column of ``df`` that has the name of a new one is replaced. Rows keep
    their partition and their order; nothing is shuffled.
    """
    names = [name for name, _ in fields]
    kept = [c for c in df.columns if c not in names or c == text_col]
    source = df.select(*[f"`{c}`" for c in kept])
    drop_text = text_col in names
    schema = T.StructType([f for f in source.schema.fields if not (drop_text and f.name == text_col)] + [T.StructField(n, t) for n, t in fields])
    at = kept.index(text_col)

    def run(batches):
        for batch in batches:
            new = kernel(batch.column(at))
            columns = [batch.column(i) for i in range(len(kept)) if not (drop_text and i == at)]
            yield pa.RecordBatch.from_arrays([*columns, *new.columns], schema.names)

    return source.mapInArrow(run, schema)

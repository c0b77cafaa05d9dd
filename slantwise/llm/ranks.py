"""Places of rows in a sorted order, without sorting a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slantwise.session import materialize


def ordered_index(rows: DataFrame, group: str, order: list[str | Column], name: str) -> DataFrame:
    """``rows`` with ``idx``, the place in its ``group`` counted from 0, and ``n``, the group's rows.

    The order is ``order``, nulls first; rows that agree in all of it stand in any
    order. Rows are dealt by ranges of (group, order), so a group of any size, or one
    value that fills it, is spread over tasks. A place is the row's place in its
    sorted range plus the rows of the group in the ranges before: a table with one
    row per range and group. ``group`` must not be null. ``rows`` must be a stored
    table, so that a task that runs again meets the same rows; it is written once
    more, so pass it narrow. Columns ``_tie``, ``_at``, ``_part``, ``_first`` and
    ``_before`` are in use.
    """
    marked = rows.withColumn("_tie", F.monotonically_increasing_id())
    keys = [F.col(group), *order, F.col("_tie")]
    placed = marked.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    placed = placed.withColumn("_at", F.monotonically_increasing_id())
    placed = materialize(placed.withColumn("_part", F.shiftright("_at", 33)), f"{name}-sorted")
    spans = placed.groupBy("_part", group).agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(group).orderBy("_part")
    running = F.sum("_rows").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumns({"_before": F.coalesce(running, F.lit(0)), "n": F.sum("_rows").over(Window.partitionBy(group))})
    spans = materialize(spans.drop("_rows"), f"{name}-spans")
    out = placed.join(spans, ["_part", group])
    return out.withColumn("idx", F.col("_before") + F.col("_at") - F.col("_first")).drop("_at", "_part", "_first", "_before")

"""Lists of equal keys over the pieces of many texts, and texts fetched by name.

A piece is a row ``(key, content, node, pos, size, state)``: ``node`` names its text,
``content`` exactly what it holds, ``state`` whether a task has met it before. Equal contents in two places need
no comparison; lists with several contents are compared once per content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slantwise.llm import kernels
from slantwise.llm.repeats import in_filter
from slantwise.session import materialize

PIECE = "key long, content long, node long, pos long, size long, state int"


def text_node(text_col: str) -> Column:
    """64-bit name of a text; null reads as empty."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def shared_pieces(rows: DataFrame) -> DataFrame:
    """Pieces that share their key with another place.

    Adds ``exact`` (the same content stands elsewhere too), ``several`` (the list
    holds other contents) and ``leads`` (first place of its content). Sorted runs of
    a key pass through without being gathered.
    """
    place = F.struct("node", "pos")
    by_key = Window.partitionBy("key")
    by_content = Window.partitionBy("key", "content")
    marked = rows.withColumns(
        {
            "first": F.min(place).over(by_content),
            "last": F.max(place).over(by_content),
            "met": F.max("state").over(by_content),
            "least": F.min("content").over(by_key),
            "most": F.max("content").over(by_key),
        }
    )
    found = marked.withColumns(
        {"exact": (F.col("first") != F.col("last")) | (F.col("met") > 0), "several": F.col("least") != F.col("most"), "leads": place == F.col("first")}
    ).where("exact or several")
    return materialize(found.drop("first", "last", "least", "most", "met", "state"), "shared-pieces")


def with_texts(texts: DataFrame, chosen: DataFrame) -> DataFrame:
    """``chosen`` (one row per ``node``) with the text ``t`` of each node, once."""
    texts = in_filter(texts.select("node", "t"), "node", chosen, "node")
    wanted = texts.mapInArrow(kernels.distinct_rows, texts.schema)
    return chosen.join(wanted.dropDuplicates(["node"]), "node")

"""Near copies by SimHash fingerprints, found through lists of equal bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slantwise.llm import simhash
from slantwise.llm.arrow import append_columns
from slantwise.llm.components import connected_components
from slantwise.session import materialize

HOT_LIST = 1 << 14


def as_hex(print_: Column) -> Column:
    return F.lower(F.lpad(F.hex(print_), 16, "0"))


def listed(prints: DataFrame, max_bits: int, depth: int) -> DataFrame:
    """``(list, fp)``: each fingerprint in one list per choice of byte positions.

    A list is named by a hash of the positions and their bytes; two lists that
    meet by chance only cost comparisons.
    """
    masks = [mask - 2**64 if mask >= 2**63 else mask for mask in simhash.byte_sets(max_bits, depth)]
    names = [F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(mask))) for k, mask in enumerate(masks)]
    return prints.select(F.explode(F.array(*names)).alias("list"), "fp")


def fingerprint_links(prints: DataFrame, max_bits: int, depth: int, hot_list: int = HOT_LIST) -> DataFrame:
    """Links ``(a, b)`` that join all distinct fingerprints within ``max_bits`` bits.

    Lists are compared by task. A list of more than ``hot_list`` members is told, not
    compared: its members meet in the points that half of ``max_bits`` changes reach,
    where any two are within ``max_bits`` of each other and any pair so near meets.
    """
    rows = listed(prints, max_bits, depth).repartition("list").sortWithinPartitions("list")
    found = rows.mapInArrow(lambda batches: simhash.linked(batches, max_bits, hot_list), "a long, b long")
    found = materialize(found, "print-links")
    links = found.where("b is not null")
    hot = found.where("b is null").select("a")
    if not hot.take(1):
        return links
    reached = hot.distinct().mapInArrow(lambda batches: simhash.points(batches, max_bits), "point long, fp long")
    # A point holds no more than the distinct fingerprints around it, 2,081 for four bits.
    met = reached.repartition("point").sortWithinPartitions("point")
    return links.unionByName(materialize(met.mapInArrow(simhash.neighbours, "a long, b long").distinct(), "point-links"))


def similar_fingerprints(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    size: int = 4,
    max_bits: int = 4,
    seed: int = 42,
    hot_list: int = HOT_LIST,
) -> DataFrame:
    """``id_col``, ``fingerprint`` and ``component_id`` of every document.

    A bit of the fingerprint is set if over half of the hashes (XXH64) of the text's
    ``size``-word shingles have it, repeats included; A-Z are read in lower case.
    Fewer words make one shingle, and no words (null or empty text) the fingerprint
    zero, which links like any other. Fingerprints link when at most ``max_bits``
    bits differ, an even number up to 6. ``component_id`` is the least id reachable by links.

    Near fingerprints share at least ``8 - max_bits`` bytes in place. They meet in
    lists of some of these bytes (how many, the cost of entries and comparisons
    says); there the shared bytes are tallied, and pairs that reach the minimum are
    verified by their bits. Copies and rows that repeat are one fingerprint. A null
    id is never the least; a component of null ids only has a null id. Other columns
    are not read. An empty table gives an empty result.
    """
    if max_bits % 2 or not 0 <= max_bits <= 6:
        raise ValueError("max_bits must be 0, 2, 4 or 6")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("t"))
    rows = append_columns(texts, "t", lambda column: simhash.fingerprint_column(column, size, seed), [("fp", T.LongType())])
    rows = materialize(rows.select("id", "fp"), "prints")
    prints = materialize(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct-prints")
    depth = simhash.list_depth(prints.count(), max_bits)
    roots = connected_components(fingerprint_links(prints, max_bits, depth, hot_list)).withColumnRenamed("node", "fp")
    named = prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = materialize(named.select("fp", "root").join(lowest, "root").select("fp", "component_id"), "print-labels")
    out = rows.join(labels, "fp")
    return out.select(F.col("id").alias(id_col), as_hex(F.col("fp")).alias("fingerprint"), "component_id")

"""Removal of long byte strings that start at more than one place of a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slantwise.llm import bwt, kernels
from slantwise.llm.columns import apart
from slantwise.llm.lists import PIECE, shared_pieces, text_node, with_texts
from slantwise.session import materialize, small_side

COLLECTION_BYTES = 1 << 19
HOT_LIST = 8192


@apart(("n_bytes", "n_removed", "n_spans", "kept_sha256"), ("text_col",))
def remove_repeats(
    docs: DataFrame,
    text_col: str = "text",
    length: int = 400,
    gram: int = 256,
    hot_list: int = HOT_LIST,
    collection_bytes: int = COLLECTION_BYTES,
) -> DataFrame:
    """Every document with what is left without the strings that occur elsewhere too.

    A byte goes when a string of ``length`` bytes that covers it starts at another
    place of the corpus too, in the same document or another; all is judged on the
    input. New columns: ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed
    runs) and ``kept_sha256`` of the bytes left.

    Neighbouring windows with one anchor gram form a run. Equal windows lie in runs
    of one anchor, so anchors deal the runs into lists, and a run whose anchor
    occurs once holds no repeat. Runs equal as a whole repeat without a comparison;
    the different runs of a list go to a collection of about ``collection_bytes``,
    whose transform is built column by column. A list of more than ``hot_list``
    different runs is dealt anew by the hash of each single window instead, so no
    task gets an unbounded list. Texts that occur more than once and have ``length``
    bytes go whole.

    Null text reads as empty: no bytes, nothing removed. Texts are named by a 64-bit
    hash. Rows are judged as they are, repeats included; an empty table gives an
    empty result. Columns named like a result are replaced.
    """
    results = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    base = docs.drop(*[c for c in results if c in docs.columns])
    texts = docs.select(text_node(text_col).alias("node"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    texts = texts.where(F.octet_length("t") >= length)
    rows = texts.mapInArrow(lambda b: bwt.run_rows(kernels.distinct_rows(b), length, gram), PIECE)
    shared = shared_pieces(rows)
    matched = _matched(texts, shared, length, hot_list, collection_bytes)
    whole = shared.where("exact").select("node", F.col("pos").alias("start"), "size")
    part = shared.where("several and not exact").join(matched.withColumnRenamed("size", "windows"), ["key", "content"])
    part = part.select("node", (F.col("pos") + F.col("skip")).alias("start"), F.col("windows").alias("size"))
    runs = whole.unionByName(part).distinct().groupBy("node").agg(F.collect_list(F.struct("start", "size")).alias("runs"))
    copies = texts.groupBy("node").agg(F.count("*").alias("c")).where("c > 1").select("node")
    # A text with copies goes whole; an empty list of runs says so.
    none = F.array().cast("array<struct<start:bigint,size:bigint>>")
    runs = runs.join(copies, "node", "left_anti").unionByName(copies.select("node", none.alias("runs")))
    runs = materialize(runs, "removed-runs")
    cut = with_texts(texts, runs).select("node", "t", "runs")
    cut = cut.mapInArrow(lambda b: bwt.cut_out(b, length), "node long, n_removed long, n_spans long, kept_sha256 string")
    cut = materialize(cut, "removed")
    out = base.withColumns({"n_bytes": F.octet_length(raw).cast("long"), "_node": text_node(text_col), "_whole": F.sha2(raw, 256)})
    out = out.join(cut.withColumnRenamed("node", "_n"), (F.col("_node") == F.col("_n")) & (F.col("n_bytes") >= length), "left")
    return out.withColumns(
        {
            "n_removed": F.coalesce("n_removed", F.lit(0)).cast("long"),
            "n_spans": F.coalesce("n_spans", F.lit(0)).cast("long"),
            "kept_sha256": F.coalesce("kept_sha256", "_whole"),
        }
    ).drop("_node", "_n", "_whole")


def _matched(texts: DataFrame, shared: DataFrame, length: int, hot_list: int, collection_bytes: int) -> DataFrame:
    """``(key, content, skip, size)``: windows found elsewhere, for one run per content."""
    leading = shared.where("several and leads").select("key", "content", "node", "pos", "size")
    leading = leading.dropDuplicates(["key", "content"])
    hot = materialize(leading.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") > hot_list).select("key"), "hot-lists")
    hot_side = small_side(hot)
    total = leading.agg(F.sum(F.col("size") + length)).first()[0] or 0
    buckets = max(1, -(-total // collection_bytes))
    # A hot list is cut by window, all others by collection.
    normal = leading.join(hot_side, "key", "left_anti").withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))
    strings = _strings(texts, normal).mapInArrow(lambda b: bwt.cut_strings(b, length), "bucket int, key long, content long, string binary")
    strings = strings.repartition("bucket").sortWithinPartitions("bucket")
    found = strings.mapInArrow(lambda b: bwt.repeated_runs(b, length), "key long, content long, skip long, size long")
    found = materialize(found, "repeated-runs")
    if not hot.limit(1).count():
        return found
    crowded = leading.join(hot_side, "key", "left_semi").withColumn("bucket", F.lit(0))
    marks = _strings(texts, crowded).mapInArrow(lambda b: bwt.window_marks(b, length), "h1 long, h2 long, key long, content long, offset long")
    marks = materialize(marks, "window-marks")
    twice = marks.groupBy("h1", "h2").agg(F.count("*").alias("c")).where("c > 1").drop("c")
    single = marks.join(twice, ["h1", "h2"]).select("key", "content", F.col("offset").alias("skip"), F.lit(1).cast("long").alias("size"))
    return found.unionByName(materialize(single, "repeated-windows"))


def _strings(texts: DataFrame, runs: DataFrame) -> DataFrame:
    by_text = runs.groupBy("node").agg(F.collect_list(F.struct("bucket", "key", "content", "pos", "size")).alias("runs"))
    return with_texts(texts, by_text).select("t", "runs")
